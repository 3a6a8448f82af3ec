"""Filtered full-text search over an index table for a table of questions."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.rows import array_rows
from corpusloom.functions.text import empty_strings, is_blank, stem, words
from corpusloom.operators.ordering import (
    DEFAULT_HOT_ROWS, global_position, group_lag, group_position, group_running_sum, parts_by_position,
)
from corpusloom.session import BROADCAST_ROWS, BROADCAST_TEXTS, local_path, materialize, scratch_path, small_enough
from corpusloom.sources.pieces import pack_places, read_pieces, write_pieces

# Columns a query text is matched against, and the answer to a question without hits.
SEARCHABLE = ("text", "file_name", "description", "additional_metadata", "external_source_name", "custom_field")
NO_MATCH_MESSAGE = "Sorry, but I did not find a match based on your query."

# Okapi BM25 constants.
K1, B = 1.2, 0.75

HITS_PER_PART = 16


def searchable_text(index: DataFrame) -> Column:
    return F.concat_ws(" ", *[F.col(c) for c in SEARCHABLE if c in index.columns])


def searchable_words(index: DataFrame) -> Column:
    return words(searchable_text(index))


def match_any_field(index: DataFrame, value: str) -> DataFrame:
    """Rows holding exactly ``value`` among their custom fields; a blank value filters nothing."""
    if not value or not value.strip():
        return index
    return index.filter(F.array_contains("custom_field", value))


def match_fields(index: DataFrame, wanted: DataFrame, key: str = "question_id") -> DataFrame:
    """(key, id) for every row holding the value asked for: an equi join on the field value."""
    held = index.select("id", F.explode(F.array_distinct("custom_field")).alias("custom_field"))
    asked = wanted.filter(~is_blank(F.col("custom_field"))).select(key, "custom_field")
    return held.join(small_enough(asked), "custom_field").select(key, "id")


def name_words(c: Column) -> Column:
    return words(stem(c))


def match_file_name(index: DataFrame, name: str) -> DataFrame:
    """Rows whose file name shares a word with ``name``; an empty name filters nothing."""
    if not name:
        return index
    return index.filter(F.arrays_overlap(name_words(F.col("file_name")), name_words(F.lit(name))))


def match_names(index: DataFrame, wanted: DataFrame, key: str = "question_id") -> DataFrame:
    """(key, id) for every row whose file name shares a word with the name asked for."""
    held = index.select("id", F.explode(F.array_distinct(name_words(F.col("file_name")))).alias("_w"))
    asked = wanted.select(key, F.explode(F.array_distinct(name_words(F.col("file_name")))).alias("_w"))
    return held.join(small_enough(asked), "_w").select(key, "id").distinct()


def question_terms(questions: DataFrame) -> DataFrame:
    """(question_id, term, qtf) of the questions that hold any word."""
    return (
        questions.select("question_id", F.explode(words(F.col("question"))).alias("term"))
        .groupBy("question_id", "term").agg(F.count("*").alias("qtf"))
    )


def asked_terms(questions: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(question_id, term, code, qtf) of the questions that hold any word, (term, code) of these words, and how many rows the first has.

    A word's code is its place among the words asked for: what is stored and moved for each word of a document is a number.
    """
    terms = materialize(question_terms(questions), "terms")
    n_terms = terms.count()
    vocabulary = materialize(global_position(terms.select("term").distinct(), ["term"], "code"), "vocabulary")
    return materialize(terms.join(small_enough(vocabulary, n_terms), "term"), "terms"), vocabulary, n_terms


def postings(index: DataFrame, vocabulary: DataFrame, n_words: int) -> DataFrame:
    """(id, dl, code, tf) for the words of ``vocabulary`` (term, code), counted in tasks that hold whole documents.

    Texts are shuffled by their id instead of a row with the id for every word: what moves is no more than the texts.
    ``n_words`` is an upper bound of the vocabulary's size.
    """
    docs = _whole_texts(index).withColumn("_w", words(F.col("_text"))).drop("_text")
    # The length is taken below the explode, else every word would carry the whole list.
    spread = array_rows(docs.withColumn("dl", F.size("_w")), ("id", "dl"), "_w", "_at", "term").drop("_at")
    if n_words <= BROADCAST_ROWS:
        spread = spread.join(F.broadcast(vocabulary), "term")
        return spread.groupBy("id", "dl", "code").agg(F.count("*").alias("tf"))
    counted = spread.groupBy("id", "dl", "term").agg(F.count("*").alias("tf"))
    return counted.join(vocabulary, "term").drop("term")


def _whole_texts(index: DataFrame, keep: tuple[str, ...] = ("id",)) -> DataFrame:
    """``keep`` (with the id) and the searchable text of every row, rows of one id in one task."""
    return index.select(*keep, searchable_text(index).alias("_text")).repartition("id")


def packed(found: DataFrame, keys: tuple[str, ...] = ("id", "dl")) -> DataFrame:
    """Postings (id, dl, code, tf) as one row per document, with its words as a list: a document's id is stored and moved once.

    A word is one number, its code in the upper half and ``tf`` in the lower.
    """
    return found.groupBy(*keys).agg(F.collect_list(F.shiftleft("code", 32) + F.col("tf")).alias("words"))


def _asked_filters(questions: DataFrame) -> DataFrame:
    """question_id with the file name and field value it is restricted to, NULL where it is not."""
    def given(c: str) -> Column:
        return F.col(c) if c in questions.columns else F.lit(None).cast("string")

    return questions.select(
        "question_id",
        F.when(given("file_name") != "", given("file_name")).alias("file_name"),
        F.when(~is_blank(given("custom_field")), given("custom_field")).alias("custom_field"),
    )


def allowed_pairs(index: DataFrame, asked: DataFrame, kinds: set[tuple[bool, bool]]) -> DataFrame | None:
    """(question_id, id) that the filters of the restricted questions let through.

    ``kinds`` says which combinations of (file filter, field filter) occur.
    """
    name, field = F.col("file_name").isNotNull(), F.col("custom_field").isNotNull()
    if "custom_field" not in index.columns:
        index = index.withColumn("custom_field", empty_strings())
    pairs = []
    if (True, False) in kinds:
        pairs.append(match_names(index, asked.filter(name & ~field)))
    if (False, True) in kinds:
        pairs.append(match_fields(index, asked.filter(~name & field)))
    if (True, True) in kinds:
        both = asked.filter(name & field)
        pairs.append(match_names(index, both).join(match_fields(index, both), ["question_id", "id"]))
    return reduce(DataFrame.unionByName, pairs) if pairs else None


class Matches(NamedTuple):
    """What a table of questions asks of a collection, ready to be summed up.

    ``weights`` (question_id, term, code, df, top, w) of all questions, where ``top`` is the term's greatest damping; ``documents``
    (id, words) holds for each document and term what the term adds to the score per unit of weight, and ``gathered`` the same in tasks
    that hold whole documents, for sums per document without a further shuffle; ``allowed`` (question_id, id) the documents of
    restricted questions, None if there are none; ``free`` the ids of the other questions.
    """

    weights: DataFrame
    documents: DataFrame
    gathered: DataFrame
    n_weights: int
    allowed: DataFrame | None
    free: DataFrame


def _damped(documents: DataFrame, *keep: str) -> DataFrame:
    """(id, code, t) of every word of the documents, and the columns ``keep``."""
    return array_rows(documents, ("id", *keep), "words", "_at", "_word").select("id", *keep, "_word.code", "_word.t")


def match(found: DataFrame, terms: DataFrame, n_terms: int, docs: DataFrame, length: Column, questions: DataFrame) -> Matches:
    """Weights and dampings from the packed postings ``found`` (id, dl, words) of the words asked for, ``terms`` (question_id, term, code, qtf).

    ``docs`` is the whole collection (id, file_name, custom_field); word statistics always come from all of it.
    """
    # Two numbers, worked out once; a subquery would count the words of all texts again in every later step.
    stats = docs.select(length.alias("dl")).agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl")).first()
    whole = {"n": F.lit(stats["n"]), "avgdl": F.lit(stats["avgdl"] or 1.0)}
    least = F.lit(K1) * (F.lit(1 - B) + F.lit(B) * F.col("dl") / whole["avgdl"])

    def count(word: Column) -> Column:
        return word.bitwiseAND(F.lit((1 << 32) - 1))

    def damped(rows: DataFrame) -> DataFrame:
        return rows.select("id", F.transform("words", lambda x: F.struct(
            F.shiftright(x, 32).alias("code"), (count(x) * F.lit(K1 + 1) / (count(x) + least)).alias("t"),
        )).alias("words"))

    # Counts move, not the dampings worked out from them, which are twice as long.
    documents, gathered = damped(found), damped(found.repartition("id"))
    frequency = _damped(documents).groupBy("code").agg(F.count("*").alias("df"), F.max("t").alias("top"))
    idf = F.log(1 + (whole["n"] - F.col("df") + 0.5) / (F.col("df") + 0.5))
    # One row per word of a question; every later step reads it.
    weights = materialize(
        terms.join(frequency, "code").select("question_id", "term", "code", "df", "top", (F.col("qtf") * idf).alias("w")), "weights",
    )

    asked = _asked_filters(questions)
    named, valued = F.col("file_name").isNotNull(), F.col("custom_field").isNotNull()
    # At most four rows.
    kinds = {tuple(r) for r in asked.select(named, valued).distinct().collect()}
    free = asked.filter(~(named | valued)).select("question_id")
    allowed = allowed_pairs(docs, asked, kinds)
    return Matches(weights, documents, gathered, n_terms, None if allowed is None else materialize(allowed, "allowed"), free)


def _summed(parts: DataFrame, *keep: str) -> DataFrame:
    return parts.groupBy("question_id", "id", *keep).agg(F.round(F.sum(F.col("w") * F.col("t")), 6).alias("score"))


def free_weights(m: Matches) -> DataFrame:
    return m.weights if m.allowed is None else m.weights.join(m.free, "question_id", "left_semi")


def restricted_scores(m: Matches, *keep: str) -> DataFrame:
    """Restricted questions meet their allowed documents first and only the words of those are scored."""
    met = _damped(m.gathered.join(m.allowed, "id"), "question_id", *keep)
    return _summed(met.join(small_enough(m.weights, m.n_weights), ["question_id", "code"]), *keep)


def all_scores(m: Matches, *keep: str) -> DataFrame:
    """(question_id, id, score) of every document that shares a word with a question and is allowed to it, and columns ``keep`` of the documents."""
    scored = _summed(_damped(m.gathered, *keep).join(small_enough(free_weights(m), m.n_weights), "code"), *keep)
    return scored if m.allowed is None else scored.unionByName(restricted_scores(m, *keep))


def index_matches(index: DataFrame, questions: DataFrame, numbers: DataFrame | None = None) -> Matches:
    """Matches against index rows, whose texts are split into words here.

    With ``numbers`` (id, number) documents go by their number instead of the id, which is shorter where there are very many hits.
    """
    terms, vocabulary, n_terms = asked_terms(questions)
    found = packed(postings(index, vocabulary, n_terms))
    length = F.col("n_terms") if "n_terms" in index.columns else F.size(searchable_words(index))
    if numbers is not None:
        found = _numbered(found, numbers)
        index = _numbered(index.withColumn("n_terms", length), numbers)
        length = F.col("n_terms")
    # The matched postings are read for the document frequencies and again for the scores.
    return match(materialize(found, "postings"), terms, n_terms, index, length, questions)


def _numbered(rows: DataFrame, numbers: DataFrame) -> DataFrame:
    return rows.join(numbers, "id").drop("id").withColumnRenamed("number", "id")


def score_text(index: DataFrame, questions: DataFrame) -> DataFrame:
    """(question_id, id, score): BM25 of every document that shares a word with a question.

    Questions restricted to a file or a field value keep only the documents allowed to
    them; word statistics always come from the whole index.
    """
    return all_scores(index_matches(index, questions))


def total_count(hits: DataFrame) -> DataFrame:
    return hits.groupBy("question_id").agg(F.count("*").alias("total_count"))


def top_k(scored: DataFrame, k: int | None, by: tuple[str, ...] = ("question_id",), score: str = "score",
          tie: str = "id", hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Hits in ranked order per question: the best ``k``, or all of them.

    With ``k`` every task keeps only k rows per question before the shuffle.
    """
    order = [F.desc(score), F.col(tie)]
    if k is None:
        return group_position(scored, list(by), order, "rank", hot_rows)
    ranked = Window.partitionBy(*by).orderBy(*order)
    return scored.withColumn("rank", F.row_number().over(ranked).cast("bigint")).filter(F.col("rank") <= k)


# The strongest words of a question are looked at first, until they have this many documents for each hit wanted.
FIRST_LOOK = 20
# Rows that a task holds before it sorts out the best.
LOCAL_ROWS = 1 << 19
# Scores are rounded to six places; bounds are compared with room for that.
ROOM = 2e-6


def bounded_weights(m: Matches, k: int) -> DataFrame:
    """Free weights with ``floor``, ``needed`` and ``rest``, from which documents that cannot be among the best are told.

    What a word can add to any score is bounded by its weight times its greatest damping. The documents with the
    largest sums over a question's strongest words are scored in full, and the k-th of these scores is a ``floor``
    for the k-th best. Words whose bounds together stay below it are not ``needed``: a document that has none of
    the others cannot get there. ``rest`` is the sum of the bounds of the words that are not needed.
    """
    weights = free_weights(m).withColumn("bound", F.col("w") * F.col("top"))
    strongest = Window.partitionBy("question_id").orderBy(F.desc("bound"), "term")
    seen = F.coalesce(F.sum("df").over(strongest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lead = weights.withColumn("_seen", seen).filter(F.col("_seen") < FIRST_LOOK * k).select("question_id", "code", "w")
    first = top_k(_summed(_damped(m.gathered).join(small_enough(lead, m.n_weights), "code")), k).select("question_id", "id")
    # At most k documents for each question, of which there are not more than there are weights.
    met = _damped(m.documents.join(small_enough(first, k * m.n_weights), "id"), "question_id")
    whole = _summed(met.join(small_enough(weights, m.n_weights), ["question_id", "code"]))
    floors = whole.groupBy("question_id").agg(
        F.when(F.count("*") >= k, F.min("score") - ROOM).otherwise(0.0).alias("floor"),
    )
    weakest = Window.partitionBy("question_id").orderBy("bound", "term").rowsBetween(Window.unboundedPreceding, 0)
    ranked = weights.join(floors, "question_id").withColumn("_upto", F.sum("bound").over(weakest))
    ranked = ranked.withColumn("needed", F.col("_upto") >= F.col("floor"))
    rest = F.max(F.when(~F.col("needed"), F.col("_upto"))).over(Window.partitionBy("question_id"))
    return materialize(ranked.withColumn("rest", F.coalesce(rest, F.lit(0.0))).drop("_upto"), "bounds")


def best_scores(m: Matches, k: int) -> DataFrame:
    """(question_id, id, score) of the free questions, with at least every document that is among a question's ``k`` best.

    Only needed words are summed up for all documents; the others are added for documents that can still pass the floor.
    """
    weights = bounded_weights(m, k)
    needed = weights.filter("needed").select("question_id", "code", "w", "floor", "rest")
    documents = m.gathered  # neither the sums per document nor the join to its words need a further shuffle
    passing = (
        _damped(documents).join(small_enough(needed, m.n_weights), "code").groupBy("question_id", "id", "floor", "rest")
        .agg(F.sum(F.col("w") * F.col("t")).alias("_sum")).filter(F.col("_sum") + F.col("rest") >= F.col("floor"))
    )
    others = weights.filter(~F.col("needed")).select("question_id", "code", "w")
    listed = others.groupBy("question_id").agg(F.collect_list("code").alias("_others"))
    open_ = passing.join(small_enough(listed, m.n_weights), "question_id", "left").join(documents, "id", "left")
    asked = F.filter("words", lambda x: F.coalesce(F.array_contains("_others", x["code"]), F.lit(False)))
    rows = open_.select("question_id", "id", "_sum", F.explode_outer(asked).alias("_word")).select(
        "question_id", "id", "_sum", F.col("_word.code").alias("code"), F.col("_word.t").alias("t"),
    )
    added = rows.join(small_enough(others, m.n_weights), ["question_id", "code"], "left").groupBy("question_id", "id", "_sum").agg(
        F.coalesce(F.sum(F.col("w") * F.col("t")), F.lit(0.0)).alias("_more"),
    )
    return added.select("question_id", "id", F.round(F.col("_sum") + F.col("_more"), 6).alias("score"))


def local_best(scored: DataFrame, k: int, hold: int = LOCAL_ROWS) -> DataFrame:
    """(question_id, id, score, n): each task's ``k`` best rows per question, and a row with the number of all of them.

    Rows go through in one pass and only ``k`` + 1 per question leave a task.
    """
    order = [("question_id", "ascending"), ("score", "descending"), ("id", "ascending")]

    def best(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by(order).combine_chunks()
        if not len(rows):
            return rows
        asked = rows["question_id"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        first = np.flatnonzero(np.diff(asked, prepend=-1))
        place = np.arange(len(asked)) - np.repeat(first, np.diff(np.append(first, len(asked))))
        return rows.filter(pa.array(place < k))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, held, n, counts = None, [], 0, []

        def settle():
            rows = pa.Table.from_batches(held)
            counts.append(rows.group_by("question_id").aggregate([("id", "count")]))
            if len(counts) > 16:
                counts[:] = [pa.concat_tables(counts).group_by("question_id").aggregate([("id_count", "sum")]).rename_columns(counts[0].column_names)]
            return best(rows if kept is None else pa.concat_tables([kept, rows]))

        for batch in batches:
            held.append(batch)
            n += len(batch)
            if n >= hold:
                kept, held, n = settle(), [], 0
        if held:
            kept = settle()
        if kept is None:
            return
        total = pa.concat_tables(counts).group_by("question_id").aggregate([("id_count", "sum")]).combine_chunks()
        form = pa.schema([(c, kept[c].type) for c in ("question_id", "id", "score")] + [("n", pa.int64())])
        none = lambda n, c: pa.nulls(n, form.field(c).type)
        found = [kept["question_id"], kept["id"], kept["score"], none(len(kept), "n")]
        counted = [total["question_id"], none(len(total), "id"), none(len(total), "score"), total["id_count_sum"]]
        for columns in (found, counted):
            yield from pa.Table.from_arrays(columns, schema=form).to_batches()

    kinds = dict(scored.dtypes)
    return scored.select("question_id", "id", "score").mapInArrow(
        scan, f"question_id {kinds['question_id']}, id {kinds['id']}, score double, n bigint",
    )


def counted_hits(m: Matches, k: int) -> DataFrame:
    """(question_id, id, score, rank, total_count) of each question's ``k`` best documents.

    Counting looks at every matching document, so all are summed up, in tasks that hold whole documents: no row per
    question and document is written or shuffled, only ``k`` rows and a count per question and task.
    """
    best = materialize(local_best(all_scores(m), k), "best")
    counts = best.filter("n IS NOT NULL").groupBy("question_id").agg(F.sum("n").alias("total_count"))
    ranked = top_k(best.filter("n IS NULL").drop("n"), k)
    return ranked.join(counts, "question_id").select("question_id", "id", "score", "rank", "total_count")


def best_hits(m: Matches, k: int) -> DataFrame:
    """(question_id, id, score, rank) of each question's ``k`` best documents, summed up only where they can be among them."""
    scored = best_scores(m, k)
    if m.allowed is not None:
        scored = scored.unionByName(restricted_scores(m))
    return top_k(scored, k).select("question_id", "id", "score", "rank")


def all_hits(m: Matches, questions: DataFrame, hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """(question_id, id, score, rank, total_count) of all matching documents, best first."""
    scored = materialize(all_scores(m), "scores")
    ranked = top_k(scored, None, hot_rows=hot_rows)
    return ranked.join(small_enough(total_count(scored), questions.count()), "question_id").select(
        "question_id", "id", "score", "rank", "total_count",
    )


def hits(m: Matches, questions: DataFrame, k: int | None = None, counts: bool = True,
         hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    if k is None:
        return all_hits(m, questions, hot_rows)
    return counted_hits(m, k) if counts else best_hits(m, k)


def search_text(index: DataFrame, questions: DataFrame, k: int | None = None,
                hot_rows: int = DEFAULT_HOT_ROWS, counts: bool = True) -> DataFrame:
    """(question_id, id, score, rank, total_count) of the matching documents, best first.

    ``index`` has id, file_name and any of the searchable columns; ``questions`` has
    question_id, question and optionally file_name and custom_field. With ``k`` and without ``counts``
    there is no total_count, and documents that cannot be among the ``k`` best are left out early.
    """
    return hits(index_matches(index, questions), questions, k, counts, hot_rows)


def attach_hit_text(ranked: DataFrame, index: DataFrame, text: str = "text") -> DataFrame:
    """Text of the ranked hits; joined last, so that only their bodies move on.

    Short lists of hits go to the stored texts instead of the other way round.
    """
    return index.select("id", F.col(text).alias("text")).join(small_enough(ranked), "id")


def _sized(rows: DataFrame, part_bytes: int, sep: str, *keep: str) -> DataFrame:
    """``keep``, the bytes that each text takes and the pieces that it is cut into."""
    piece = max(1, part_bytes // 4)
    size = (F.octet_length("text") + len(sep.encode())).cast("bigint")
    pieces = F.when(size > part_bytes, F.ceil(F.length("text") / F.lit(piece))).otherwise(1).cast("int")
    return rows.select(*keep, size.alias("_size"), F.greatest(pieces, F.lit(1)).alias("_pieces"))


def _cut(part_bytes: int) -> Column:
    """The piece ``_piece`` of a text."""
    piece = max(1, part_bytes // 4)
    return F.when(F.col("_size") > part_bytes, F.substring("text", F.col("_piece") * piece + 1, F.lit(piece))).otherwise(F.col("text"))


def _placed(sized: DataFrame, part_bytes: int, hot_rows: int) -> DataFrame:
    """Rows of ``sized`` by piece, with the ``_part`` they fall into; parts of a question are ordered as its hits are."""
    half = max(1, part_bytes // 2)
    placed = group_running_sum(sized, ["question_id"], ["rank"], "_size", "_before", hot_rows)
    at = F.struct(
        F.floor(F.col("_before") / half).alias("_at"), (F.col("_size") > half).alias("_large"),
        F.when(F.col("_size") > half, F.col("rank")).otherwise(0).alias("rank"), F.col("_piece"),
    )
    cut = placed.withColumn("_piece", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1)))
    return cut.withColumn("_part", at).drop("_before", "_pieces")


def _numbered_parts(placed: DataFrame, hot_rows: int) -> DataFrame:
    """(question_id, _part, part): the parts counted from 0."""
    parts = placed.select("question_id", "_part").distinct()
    return group_position(parts, ["question_id"], ["_part"], "_n", hot_rows).select("question_id", "_part", (F.col("_n") - 1).cast("int").alias("part"))


def _joined_parts(rows: DataFrame, part_bytes: int, sep: str, *by: str) -> DataFrame:
    lists = rows.select(*by, "rank", _cut(part_bytes).alias("text")).groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("rank", "text"))).alias("_list"))
    return lists.select("question_id", "part", F.array_join(F.transform("_list", lambda x: x["text"]), sep).alias("context"))


def parts_by_bytes(hits: DataFrame, part_bytes: int, sep: str = "", hot_rows: int = DEFAULT_HOT_ROWS,
                   texts: DataFrame | None = None) -> DataFrame:
    """(question_id, part, context): hit texts in rank order, in parts of at most ``part_bytes`` UTF-8 bytes.

    A part takes the hits that begin within half of ``part_bytes``; a text longer than that half is a part of its own, and
    one longer than ``part_bytes`` several, cut between characters. Hits have their text, or an id of ``texts`` (id, text): then
    parts are found from sizes alone, and each text moves once, to its part.
    """
    if texts is None:
        sized = _sized(hits, part_bytes, sep, "question_id", "rank", "text")
        placed = _placed(sized, part_bytes, hot_rows)
        rows = placed.join(_numbered_parts(placed, hot_rows), ["question_id", "_part"])
        return _joined_parts(rows, part_bytes, sep, "question_id", "_part", "part")
    # Texts with one id are told apart by their place among them.
    held = texts.select("id", F.struct("text").alias("_t")).groupBy("id").agg(F.array_sort(F.collect_list("_t")).alias("_texts"))
    each = held.select("id", F.posexplode("_texts").alias("_copy", "_t")).select("id", "_copy", "_t.text")
    sizes = _sized(each, part_bytes, sep, "id", "_copy")
    placed = materialize(_placed(sizes.join(small_enough(hits.select("question_id", "id", "rank")), "id"), part_bytes, hot_rows), "places")
    numbered = placed.join(_numbered_parts(placed, hot_rows), ["question_id", "_part"]).drop("_part")
    rows = held.join(numbered, "id").withColumn("text", F.col("_texts")[F.col("_copy")]["text"]).drop("_texts")
    return _joined_parts(rows, part_bytes, sep, "question_id", "part")


def assemble_context(hits: DataFrame, questions: DataFrame, sep: str = "",
                     part_size: int = HITS_PER_PART, part_bytes: int | None = None, texts: DataFrame | None = None) -> DataFrame:
    """Hit texts in rank order per question, ``part_size`` hits to a row, or as many as ``part_bytes`` hold.

    With ``part_bytes``, hits may come without their text and with an id of ``texts`` (id, text). A question without hits keeps one row with status 204 and the fixed message.
    """
    at = F.col("rank")
    if part_bytes is None:
        parts = parts_by_position(hits, ["question_id"], at - 1, [at], F.col("text"), "_texts", part_size)
        joined = parts.select("question_id", "part", F.array_join("_texts", sep).alias("context"))
    else:
        joined = parts_by_bytes(hits, part_bytes, sep, texts=texts)
    return answered_parts(joined, hits.select("question_id").distinct(), questions)


def answered_parts(joined: DataFrame, with_hits: DataFrame, questions: DataFrame) -> DataFrame:
    """Parts (question_id, part, context) with their questions and a status; questions that are not among ``with_hits`` have a row of their own."""
    n = questions.count()
    # Two joins rather than one outer join, which would gather all parts of a question in one task.
    found = joined.join(small_enough(questions, n, BROADCAST_TEXTS), "question_id")
    without = questions.join(with_hits, "question_id", "left_anti")
    return found.unionByName(without, allowMissingColumns=True).withColumn(
        "status", F.when(F.coalesce(F.length("context"), F.lit(0)) > 0, 200).otherwise(204),
    ).withColumn("message", F.when(F.col("status") == 204, NO_MATCH_MESSAGE))


def whole_context(index: DataFrame, questions: DataFrame, part_bytes: int, sep: str = "", hot_rows: int = DEFAULT_HOT_ROWS) -> tuple[DataFrame, DataFrame] | None:
    """The texts of all matching documents, best first, and how many there are: (question_id, part, context) and (question_id, n_matches).

    The same parts as ``parts_by_bytes`` makes of the hits of ``search_text``. A text that very many questions match is stored once, in
    files that all tasks can read; hits carry its place, and each part reads its texts there. What moves is one short row per hit.
    None where that is not possible: without a folder that tasks open as a local path, or with rows that lack an id or a text.
    """
    spark = index.sparkSession
    root = local_path(spark, scratch_path(spark, "pieces"))
    if root is None or index.filter("id IS NULL OR text IS NULL").take(1):
        return None
    # Numbers in the order of the ids, so that ties are settled as by id.
    numbers = materialize(global_position(index.select("id").distinct(), ["id"], "number").select("id", "number"), "numbers")
    sized = _sized(index, part_bytes, sep, "id", "text").withColumn("_piece", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1)))
    written = materialize(write_pieces(sized.select("id", "_size", "_piece", _cut(part_bytes).alias("text")), root), "pieces")
    first = Window.partitionBy("id").orderBy("at")
    # A text counts with its whole size at its first piece.
    pieces = materialize(_numbered(written, numbers).select(
        "id", "at", "bytes", F.when(F.col("_piece") == 0, F.col("_size")).otherwise(0).alias("_size"),
        (F.col("_size") > max(1, part_bytes // 2)).cast("int").alias("_large"), (F.row_number().over(first) == 1).cast("int").alias("n"),
    ), "pieces")
    m = index_matches(index, questions, numbers)
    scored = all_scores(m._replace(gathered=m.gathered.join(pieces, "id")), *PLACE)
    if pieces.count() <= hot_rows:
        hot_rows = None
    else:
        scored = materialize(scored, "scores")
    placed = _packed_parts(scored, max(1, part_bytes // 2), hot_rows)
    return read_pieces(placed, root, sep, ("question_id", "part"), "context"), placed.groupBy("question_id").agg(F.sum("n").alias("n_matches"))


# What a hit carries of a text: where it is, what it counts, whether it is a part of its own and whether it is the first with its id.
PLACE = ("at", "bytes", "_size", "_large", "n")


def _packed_parts(scored: DataFrame, half: int, hot_rows: int | None) -> DataFrame:
    """(question_id, part, n, at, bytes): one row per part, with the places of its texts in order.

    Parts follow the order of the hits: a text that begins in another half of ``part_bytes`` than the one before it opens a
    part, and so do a large text and the text after it.
    """
    by, order = ["question_id"], [F.desc("score"), F.col("id"), F.col("at")]
    rows = group_running_sum(scored, by, order, "_size", "_before", hot_rows)
    rows = rows.withColumn("_slot", F.when(F.col("_large") == 1, -1).otherwise(F.floor(F.col("_before") / half))).drop("_before", "_size")
    rows = group_lag(rows, by, order, "_slot", "_last", hot_rows)
    opens = (F.col("_large") == 1) | F.col("_last").isNull() | (F.col("_last") != F.col("_slot"))
    rows = rows.withColumn("_opens", opens.cast("int")).drop("_slot", "_last", "_large")
    rows = group_running_sum(rows, by, order, "_opens", "_earlier", hot_rows)
    rows = rows.withColumn("part", (F.col("_earlier") + F.col("_opens") - 1).cast("int")).drop("_earlier", "_opens")
    if hot_rows is not None:  # a hot question's parts lie in several tasks
        rows = rows.repartition("question_id", "part")
    rows = rows.sortWithinPartitions("question_id", "part", *order)
    return materialize(pack_places(rows, ("question_id", "part"), "n"), "places")
