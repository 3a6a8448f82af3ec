"""Language by cross-parsing entropy (Ziv and Merhav, 1993) over suffix automata.

Per language a suffix automaton of its labelled text recognises every substring of that text. A
document is parsed greedily into the longest phrases a language's automaton knows; the fewer phrases per
byte, the closer the language. The automata are tables of bounded size, and the bytes of very many
blocks of documents are parsed side by side, one numpy step per byte of a block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.byte_words import text_buffer
from corpusloom.llm.labelled import held_out, remainder

# Bounds of the learned text: bytes per language, and documents they are taken from in equal shares.
LANGUAGE_BYTES, LANGUAGE_DOCS = 20_000, 100
FOLDS, FOLD = 3, 1
# Texts are parsed in blocks of this many bytes; a phrase ends with its block.
BLOCK = 512
LANES = 1 << 13

# Symbols: 0 for everything that is neither letter nor beyond ASCII, 1-26 letters, then bytes beyond ASCII.
_SYMBOL = np.zeros(256, np.int16)
_SYMBOL[97:123] = _SYMBOL[65:91] = np.arange(1, 27)
_SYMBOL[128:] = 27 + np.arange(128)
SYMBOLS = 27 + 128


def symbols(raw: np.ndarray) -> np.ndarray:
    return _SYMBOL[raw]


def suffix_automaton(text: np.ndarray) -> np.ndarray:
    """Transitions [state, symbol] of the suffix automaton of ``text``, -1 where there is none; state 0 is the start."""
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text.tolist():
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:  # q also ends longer substrings, which part from those of its copy here
                copy = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    table = np.full((len(step), SYMBOLS), -1, np.int32)
    for s, out in enumerate(step):
        if out:
            table[s, list(out)] = list(out.values())
    return table


def compact(table: np.ndarray, used: np.ndarray) -> np.ndarray:
    """Columns of the used symbols, and one of -1 for all others at the end."""
    return np.ascontiguousarray(np.column_stack([table[:, used], np.full(len(table), -1, np.int32)]))


def count_phrases(table: np.ndarray, text: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Phrases of each block text[start:start+size]; ``size`` must not grow from block to block."""
    n = len(start)
    width = table.shape[1]
    flat = table.ravel()
    phrases = (size > 0).astype(np.int64)
    state = np.zeros(n, np.int32)
    alive = n
    for i in range(int(size[0]) if n else 0):
        while size[alive - 1] <= i:  # shorter blocks are at the end
            alive -= 1
        s = text[start[:alive] + i]
        to = flat[state[:alive] * width + s]
        if i:  # after a symbol that the language never has, which is a phrase of its own
            phrases[:alive] += state[:alive] == 0
        stop = np.flatnonzero(to < 0)
        phrases[stop] += state[stop] != 0
        to[stop] = np.maximum(flat[s[stop]], 0)
        state[:alive] = to
    return phrases


def learn_languages(docs: DataFrame, folds: int = FOLDS, fold: int = FOLD, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang") -> dict:
    """{"languages": names, "used": symbols, "tables": automata}, from rows with a language that are not held out.

    Per language at most ``LANGUAGE_DOCS`` texts are chosen by a hash of the id, and an equal share of
    ``LANGUAGE_BYTES`` is learned from the start of each. Rows with a NULL id, text or language teach nothing.
    """
    pool = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"),
    ).filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder("doc_id", folds) != fold) & (F.length("text") > 0))
    share = LANGUAGE_BYTES // LANGUAGE_DOCS * 4
    counts = pool.groupBy("lang").agg(F.count("*").alias("rows")).toArrow().to_pydict()  # one row per language
    if not counts["lang"]:
        return {"languages": [], "used": np.zeros(0, np.int64), "tables": []}
    # Rows whose hash is below the language's bound, about four times as many as are taken, then the smallest.
    bounds = F.create_map(*[F.lit(v) for name, rows in zip(counts["lang"], counts["rows"]) for v in (name, min(1.0, 4 * LANGUAGE_DOCS / rows))])
    near = pool.withColumn("_h", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) / float(1 << 32)).filter(F.col("_h") <= bounds[F.col("lang")])
    first = Window.partitionBy("lang").orderBy("_h", "doc_id", "text")
    rows = (
        near.select("lang", "_h", "doc_id", F.substring("text", 1, share).alias("text"))
        .withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= LANGUAGE_DOCS).orderBy("lang", "_n").toArrow()
    )
    names, langs, found = sorted(counts["lang"]), rows["lang"].to_pylist(), rows["text"].to_pylist()
    texts = {}
    for name in names:
        mine = [t.encode() for l, t in zip(langs, found) if l == name]
        texts[name] = symbols(np.frombuffer(b"".join(t[:max(1, LANGUAGE_BYTES // len(mine))] for t in mine), np.uint8))
    used = np.unique(np.concatenate([*texts.values(), np.zeros(1, np.int16)])).astype(np.int64)
    return {"languages": names, "used": used, "tables": [compact(suffix_automaton(texts[n]), used) for n in names]}


def parse_lengths(model: dict, at: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Phrases per byte of every text in every language, [text, language]; 0 for empty texts."""
    n = len(at) - 1
    place = np.full(SYMBOLS, len(model["used"]), np.int32)
    place[model["used"]] = np.arange(len(model["used"]))
    size = np.diff(at)
    blocks = -(-size // BLOCK)
    owner = np.repeat(np.arange(n), blocks)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    start = at[owner] + number * BLOCK
    length = np.minimum(BLOCK, at[owner + 1] - start)
    order = np.argsort(-length, kind="stable")
    owner, start, length = owner[order], start[order], length[order]
    out = np.zeros((n, len(model["tables"])))
    code = place[_SYMBOL]
    for a in range(0, len(owner), LANES):
        # The bytes of these blocks as symbols, gathered block by block.
        own, first, many = owner[a:a + LANES], start[a:a + LANES], length[a:a + LANES]
        begin = np.cumsum(many) - many
        text = code[raw[np.arange(int(many.sum())) + np.repeat(first - begin, many)]]
        for j, table in enumerate(model["tables"]):
            out[:, j] += np.bincount(own, weights=count_phrases(table, text, begin, many), minlength=n)
    return out / np.maximum(1, size)[:, None]


def identify_language(docs: DataFrame, model: dict, folds: int = FOLDS, fold: int = FOLD, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row, from its whole text alone.

    The score is the second-fewest phrases over the sum of fewest and second-fewest, so 0.5 is a tie;
    a tie goes to the language first in alphabetical order. With one language its score is 1.

    - A text that is NULL, empty or without a letter is ``und`` with score 0; so is every text if no
      language was learned.
    - NULL and repeated ids are kept; equal texts get equal results. An empty table gives no rows.
    - Other columns, whatever their names, are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        languages = sent.value["languages"]
        for batch in batches:
            at, raw = text_buffer(batch.column("text"))
            n = batch.num_rows
            best, score = np.zeros(n, np.int64), np.zeros(n)
            if languages and n:
                rate = parse_lengths(sent.value, at, raw)
                best = rate.argmin(1)
                ranked = np.sort(rate, 1)
                score = ranked[:, 1] / np.maximum(ranked[:, 0] + ranked[:, 1], 1e-12) if len(languages) > 1 else np.ones(n)
            known = batch.column("_letters").to_numpy(zero_copy_only=False) & bool(languages)
            names = np.array([*languages, "und"], object)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names[np.where(known, best, len(languages))], pa.string()), pa.array(np.where(known, score, 0.0))],
                ["doc_id", "lang_pred", "score"],
            )

    slim = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"),
        F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("_letters"),
    )
    return slim.mapInArrow(run, "doc_id bigint, lang_pred string, score double").select(
        "doc_id", held_out("doc_id", folds, fold).alias("held_out"), "lang_pred", "score",
    )
