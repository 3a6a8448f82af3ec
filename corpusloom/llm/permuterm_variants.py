"""Spelling variants: words one insertion, deletion or replacement apart, found by sorting rotations.

A word marked with a terminator, ``word$``, has one rotation for each of its places. A rotation that begins
after the character c of ``p c s`` is ``s $ p c``. All words that differ from it by that one character share the
prefix ``s $ p``, and the word without the character has ``s $ p`` as a whole rotation. So each word is entered
once for each of its characters under the rotation that skips it, and once for each of its own rotations; the
entries of one prefix stand together in sorted order, and a scan of such a group sees every neighbour.

A group has one word per possible character and at most one word without it, so its size is bounded by
the alphabet, however many words there are, and no pairs are written: each member gets the number of its
neighbours and the most frequent of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.rows import array_rows
from corpusloom.operators.ordering import global_position
from corpusloom.session import materialize

# Letters of a word, beside which every character separates words.
LETTERS = "A-Za-zÀ-ÿ"
TERMINATOR = "$"
LEAST_LENGTH, LEAST_COUNT = 7, 2
# How many times as frequent as a word its form must be.
TIMES = 10
# Keys of up to so many characters are written out.
SPELLED = 64

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _runs(text: Column, least: int) -> Column:
    """Maximal runs of at least ``least`` letters; possessive, so that a short run costs one pass."""
    return F.regexp_extract_all(text, F.lit(f"[{LETTERS}]{{{least},}}+"), F.lit(0))


def damaged(docs: DataFrame, out_of: int = 31, least: int = LEAST_LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word) of every run of letters, A-Z lower-cased; one in ``out_of`` loses a character.

    Which one is settled by h, the CRC-32 of ``<doc_id>:<run>``: where ``out_of`` divides h, the character at h modulo the run's length
    goes. A NULL id counts as empty text. Words shorter than ``least`` are left out.
    """
    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("doc"), _runs(F.col(text), least).alias("_runs"))
    run = array_rows(rows, ("doc",), "_runs", "_at", "run")
    folded = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", _UPPER, _LOWER)).otherwise(F.col("run"))
    hashed = run.select("doc", folded.alias("run")).withColumn("h", F.crc32(F.concat_ws(":", "doc", "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return hashed.select(F.when(F.col("h") % out_of == 0, cut).otherwise(F.col("run")).alias("word")).filter(F.length("word") >= least)


def count_words(words: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words that occur at least ``least`` times, summed up before the shuffle."""
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def rotations(placed: DataFrame) -> DataFrame:
    """(key, pos, n, skips, first): every word under its rotations, and under those without one character.

    ``first`` marks, of several equal characters in a row, the one whose removal stands for all of theirs.
    Keys of more than ``SPELLED`` characters are hashed, since a word of that length has as many of them.
    """
    size = F.length("word")
    at = placed.filter(size <= SPELLED).select("word", "n", "pos", F.explode_outer(F.sequence(F.lit(0), size)).alias("i"))
    before, after = F.substring("word", F.lit(1), F.col("i")), F.substring("word", F.col("i") + 1, size)
    rest = F.substring("word", F.col("i") + 2, size)
    mine, previous = F.substring("word", F.col("i") + 1, F.lit(1)), F.substring("word", F.col("i"), F.lit(1))

    def entry(tail: Column, skips: bool, first: Column) -> Column:
        return F.struct(
            F.concat(tail, F.lit(TERMINATOR), before).cast("binary").alias("key"), F.lit(skips).alias("skips"), first.alias("first"),
        )

    whole, skipped = entry(after, False, F.lit(False)), entry(rest, True, (F.col("i") == 0) | (mine != previous))
    entries = F.filter(
        F.array(F.when(size < SPELLED, whole), F.when(F.col("i") < size, skipped)), lambda e: e.isNotNull(),
    )
    spelled = at.select("pos", "n", F.explode_outer(entries).alias("_e")).filter("_e IS NOT NULL").select("_e.key", "pos", "n", "_e.skips", "_e.first")
    long = placed.filter(size >= SPELLED).select("word", "n", "pos").mapInArrow(
        _hashed_rotations, "key binary, pos bigint, n bigint, skips boolean, first boolean",
    )
    return spelled.unionByName(long)


def rotation_hashes(word: np.ndarray, skip: bool) -> np.ndarray:
    """Keys of all rotations of a word (as code points), with or without the character before each: 24 bytes of hash and the length.

    A text's hash is the sum of its characters times powers of a base, so those of all rotations follow from running sums.
    """
    n = len(word)
    i = np.arange(n if skip else n + 1)
    tail = i + 1 if skip else i
    parts = []
    for prime, base in _FIELDS:
        inverse = pow(base, prime - 2, prime)
        power, back = _powers(base, n + 1, prime), _powers(inverse, n + 1, prime)
        upto = np.append(0, np.cumsum(word * power[:n] % prime)) % prime
        ending = (upto[n] - upto[tail]) % prime * back[tail] % prime
        parts.append((ending + (ord(TERMINATOR) + upto[i] * base) % prime * power[n - tail]) % prime)
    return np.stack([*parts, np.full(len(i), n + (not skip), np.int64)], axis=1)


# Three primes below 2^31 and a base for each.
_FIELDS = ((2147483647, 1103515245), (2147483629, 1220703125), (2147483587, 1664525))


def _powers(base: int, n: int, prime: int) -> np.ndarray:
    out = np.ones(n, np.int64)
    done, step = 1, base
    while done < n:  # the first ``done`` powers times base ** done are the next ones
        out[done:2 * done] = out[:min(done, n - done)] * step % prime
        done, step = 2 * done, step * step % prime
    return out


def _hashed_rotations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for word, n, pos in zip(batch["word"].to_pylist(), batch["n"].to_pylist(), batch["pos"].to_pylist()):
            points = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.int64)
            for skip in (False, True):
                if len(points) + (not skip) <= SPELLED:
                    continue
                keys = rotation_hashes(points, skip)
                # The terminator in front keeps them apart from spelled keys, which hold it once and are valid text.
                raw = np.concatenate([np.full((len(keys), 2), ord(TERMINATOR), np.uint8), keys.view(np.uint8).reshape(len(keys), -1)], axis=1)
                first = np.append(True, points[1:] != points[:-1]) if skip else np.zeros(len(keys), bool)
                yield pa.RecordBatch.from_arrays([
                    pa.array([r.tobytes() for r in raw], pa.binary()), pa.array(np.full(len(keys), pos)), pa.array(np.full(len(keys), n)),
                    pa.array(np.full(len(keys), skip)), pa.array(first),
                ], ["key", "pos", "n", "skips", "first"])


def near_words(placed: DataFrame) -> DataFrame:
    """(pos, n_near, best_pos, best_n): number of near words and the most frequent one (ties: the first)."""
    groups = (
        rotations(placed).groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("rank"), "pos", "skips", "first"))).alias("members"))
        .filter(F.size("members") > 1)
    )

    # Replacements: others that skip a character. Insertion or deletion: the whole rotation with those that skip.
    def neighbours(x: Column) -> Column:
        return F.filter("members", lambda y: (x["pos"] != y["pos"]) & F.when(x["skips"], y["skips"] | x["first"]).otherwise(y["first"]))

    def member(x: Column) -> Column:
        near = neighbours(x)
        return F.struct(x["pos"].alias("pos"), F.size(near).alias("n_near"), F.get(near, F.lit(0)).alias("best"))

    # The outer form, because the plain one would work out all members once more to filter empty lists.
    seen = groups.select(F.explode_outer(F.transform("members", member)).alias("_m")).select("_m.*")
    found = seen.filter("n_near > 0").withColumn("best", F.struct("best.rank", "best.pos"))
    per_word = found.groupBy("pos").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("_best"))
    return per_word.select("pos", "n_near", F.col("_best.pos").alias("best_pos"), (-F.col("_best.rank")).alias("best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(pos, root) for words with a ``form``: the last word reached from form to form.

    Frequencies grow along a chain, so it has an end, and every round doubles the steps taken.
    """
    reached = materialize(forms.select("pos", F.col("form").alias("root")), "roots")
    while True:
        further = reached.select(F.col("pos").alias("root"), F.col("root").alias("_next"))
        ends = reached.select("root").distinct().join(further, "root")
        if not ends.take(1):
            return reached
        moved = reached.join(ends, "root", "left").select("pos", F.coalesce("_next", "root").alias("root"))
        reached = materialize(moved, "roots")


def spelling_variants(words: DataFrame, least_count: int = LEAST_COUNT, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the distinct ``words`` (column word) with at least ``least_count`` occurrences.

    Two words are near if one code point inserted, deleted or replaced makes one the other. A word's form is its most frequent near
    word, if that is at least ``times`` as frequent as the word itself; ties go to the first in code-point order. ``root`` follows
    forms to the last one and is the word itself if it has none; ``n_near`` is 0 for a word without near words.
    Words must not hold the terminator; NULLs and empty words have no neighbours and are left out. Words of more than ``SPELLED`` characters are
    compared by hashes of 93 bits and their length. An empty table gives no rows.
    """
    counted = count_words(words.filter(F.length("word") > 0), least_count)
    # Places in code-point order stand for the words from here on; they settle ties and are short, however long a word is.
    placed = materialize(global_position(counted, ["word"], "pos"), "words")
    form = F.col("best_n") >= F.col("n") * times
    rows = materialize(placed.select("pos", "n").join(near_words(placed), "pos", "left").select(
        "pos", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(form, F.col("best_pos")).alias("form"),
        F.when(form, F.col("best_n")).alias("form_n"),
    ), "variants")
    forms = rows.filter("form IS NOT NULL").select("pos", "form")
    texts = placed.select(F.col("pos").alias("_p"), F.col("word").alias("_text"))
    spelled = (
        forms.join(roots(forms), "pos")
        .join(texts, F.col("form") == F.col("_p")).select("pos", "root", F.col("_text").alias("form"))
        .join(texts, F.col("root") == F.col("_p")).select("pos", "form", F.col("_text").alias("root"))
    )
    return placed.join(rows.drop("form"), "pos").join(spelled, "pos", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n",
    )


def document_variants(docs: DataFrame, out_of: int = 31, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
                      times: int = TIMES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Spelling variants over the (damaged) words of whole documents; see ``damaged`` and ``spelling_variants``.

    NULL, empty and blank texts have no words; repeated rows count as often as they occur; very long texts are read whole;
    other columns do not matter.
    """
    return spelling_variants(damaged(docs, out_of, least_length, doc_id, text), least_count, times)
