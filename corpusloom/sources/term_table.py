"""The words of an index as a plain table: (term, number, tf), stored by a hash of the term, extended by uploads.

A search reads the folders of the words that are asked for and no text. Beside the postings lies one narrow row per index
row with what filters and word statistics need, and the number by which postings name its id, file and length.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.rows import array_rows
from corpusloom.functions.text import empty_strings, words
from corpusloom.operators.search import Matches, asked_terms, hits, match, packed, searchable_text, searchable_words
from corpusloom.operators.ordering import DEFAULT_HOT_ROWS
from corpusloom.session import materialize, small_enough
from corpusloom.sources import versions as V

POSTINGS, DOCS = "postings", "docs"
N_PARTS = 64


def part_of(term: Column, n_parts: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(n_parts)).cast("int")


# What is a document of its own among the postings.
DOCUMENT = ("id", "file_name", "dl")


def _number(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *[x for c in DOCUMENT for x in (F.col(c), F.col(c).isNull())])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(number, term, tf) of rows with a number and a list of words."""
    for batch in batches:
        lists = batch.column("_w")
        coded = lists.flatten().dictionary_encode()
        if not len(coded):
            continue
        n = len(coded.dictionary)
        row = np.repeat(np.arange(len(batch)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        found, times = np.unique(row * n + coded.indices.to_numpy(), return_counts=True)
        columns = [batch.column("number").take(pa.array(found // n)), coded.dictionary.take(pa.array(found % n)), pa.array(times)]
        yield pa.RecordBatch.from_arrays(columns, names=["number", "term", "tf"])


def append_terms(index: DataFrame, path: str, version: int | None = None, n_parts: int = N_PARTS,
                 files: DataFrame | None = None) -> int:
    """Add the words of index rows (id, file_name and searchable columns) as a new version, replacing their files' words.

    Words are counted in the tasks that read the rows; where rows share an id, file and length, texts are shuffled so that these lie together.
    So a word that every row has is spread over all tasks. Postings name a document by a number, a hash for which no two documents of the upload have the same. A table that exists keeps its number of parts, which is stored with the rows.
    ``files`` (file_name) may name the files, also ones without rows, as in ``append_index``. Returns the version.
    """
    spark = index.sparkSession
    version = V.next_upload(spark, path) if version is None else version
    held = V.stored(spark, f"{path}/{DOCS}")
    known = held.select("n_parts").first() if held is not None else None
    n_parts = known["n_parts"] if known else n_parts
    field = F.col("custom_field") if "custom_field" in index.columns else empty_strings()
    for seed in count():
        docs = index.select("id", "file_name", field.alias("custom_field"), F.size(searchable_words(index)).alias("dl"), F.lit(n_parts).alias("n_parts"))
        V.write_version(docs.withColumn("number", _number(seed)), path, DOCS, version)
        each = spark.read.parquet(f"{path}/{DOCS}/version={version}").groupBy("number", *DOCUMENT).agg(F.count("*").alias("rows"))
        by_number = each.groupBy("number").agg(F.count("*").alias("documents"), F.max("rows").alias("rows"))
        most = by_number.agg(F.max("documents").alias("documents"), F.max("rows").alias("rows")).first()
        if (most["documents"] or 0) <= 1:
            break
    rows = index.select("id", "file_name", searchable_text(index).alias("_text"))
    if (most["rows"] or 0) > 1:  # a document's words may lie in several rows, which equal hashes bring to one task
        rows = rows.withColumn("_key", F.xxhash64("id", "file_name")).repartition("_key")
    rows = rows.withColumn("_w", words(F.col("_text"))).drop("_text").withColumn("dl", F.size("_w")).withColumn("number", _number(seed))
    if (most["rows"] or 0) > 1:
        spread = array_rows(rows, ("_key", "number"), "_w", "_at", "term")
        counted = spread.groupBy("_key", "number", "term").agg(F.count("*").alias("tf")).drop("_key")
    else:
        counted = rows.select("number", "_w").mapInArrow(_count_words, "number bigint, term string, tf bigint")
    V.write_version(counted.withColumn("part", part_of(F.col("term"), n_parts)).sortWithinPartitions("part", "term"), path, POSTINGS, version, ("part",))
    V.finish(spark.read.parquet(f"{path}/{DOCS}/version={version}") if files is None else files, path, version)
    return version


def _live(spark: SparkSession, path: str, name: str) -> DataFrame:
    rows = V.read_part(spark, path, name)
    if rows is None:
        raise ValueError(f"no words at {path}")
    return rows.join(V.outdated(spark, path), ["file_name", "version"], "left_anti").drop("version")


def read_docs(spark: SparkSession, path: str) -> DataFrame:
    """(id, file_name, custom_field, dl) of every row that counts."""
    return _live(spark, path, DOCS).select("id", "file_name", "custom_field", "dl")


def _asked_postings(spark: SparkSession, path: str, vocabulary: DataFrame, n_words: int | None = None) -> DataFrame:
    """(version, number, term, tf) of the words in ``vocabulary`` (term), from the folders of these words only, and the other columns of ``vocabulary``."""
    n_parts = V.stored(spark, f"{path}/{DOCS}").select("n_parts").first()["n_parts"]
    # At most as many numbers as there are parts.
    parts = [r["part"] for r in vocabulary.select(part_of(F.col("term"), n_parts).alias("part")).distinct().collect()]
    rows = V.read_part(spark, path, POSTINGS)
    if rows is None:
        raise ValueError(f"no words at {path}")
    return rows.filter(F.col("part").isin(parts)).join(small_enough(vocabulary.dropDuplicates(["term"]), n_words), "term")


def _named(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """``rows`` (version, number, ...) with the id and dl of their document; replaced documents are left out."""
    held = V.read_part(spark, path, DOCS).join(V.outdated(spark, path), ["file_name", "version"], "left_anti")
    return rows.join(held.select("version", "number", "id", "dl").dropDuplicates(["version", "number"]), ["version", "number"])


def read_postings(spark: SparkSession, path: str, vocabulary: DataFrame, n_words: int | None = None) -> DataFrame:
    """(id, dl, term, tf) of the words in ``vocabulary`` (term), from the folders of these words only."""
    return _named(spark, path, _asked_postings(spark, path, vocabulary, n_words)).select("id", "dl", "term", "tf")


def read_packed(spark: SparkSession, path: str, vocabulary: DataFrame, n_words: int | None = None) -> DataFrame:
    """(id, dl, words): the rows of ``read_postings`` as one row per document, of which replaced ones are left out.

    Words are structs of term and tf or, where ``vocabulary`` has codes of its terms, numbers as in ``packed``.
    """
    rows, keys = _asked_postings(spark, path, vocabulary, n_words), ("version", "number")
    rows = packed(rows, keys) if "code" in vocabulary.columns else rows.groupBy(*keys).agg(F.collect_list(F.struct("term", "tf")).alias("words"))
    return _named(spark, path, rows).select("id", "dl", "words")


def stored_matches(spark: SparkSession, path: str, questions: DataFrame) -> Matches:
    """What ``questions`` ask of a term table."""
    terms, vocabulary, n_terms = asked_terms(questions)
    found = materialize(read_packed(spark, path, vocabulary, n_terms), "postings")
    return match(found, terms, n_terms, read_docs(spark, path), F.col("dl"), questions)


def search_terms(spark: SparkSession, path: str, questions: DataFrame, k: int | None = None, counts: bool = True,
                 hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """The same rows as ``search_text`` over the index that was added to the term table at ``path``."""
    return hits(stored_matches(spark, path, questions), questions, k, counts, hot_rows)
