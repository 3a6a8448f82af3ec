"""The training-data pipeline over ``documents``: five stages, each written as Parquet and read again.

quality -> exact duplicates -> near duplicates -> benchmark passages -> packing. Every stage works on all
rows its predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.best_fit_packing import best_fit_packing
from corpusloom.llm.decontaminate import drop_contaminated
from corpusloom.llm.exact_dedup import exact_dedup
from corpusloom.llm.mil_quality import keep_good, learn_quality
from corpusloom.llm.parity_join import jaccard_components
from corpusloom.llm.queries import tokenizer_path
from corpusloom.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _with_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` with one of the (distinct) ids, and rows without an id."""
    known = docs.filter(F.col("doc_id").isNotNull()).join(ids, "doc_id", "left_semi")
    return known.unionByName(docs.filter(F.col("doc_id").isNull())).select(docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return keep_good(docs, learn_quality(docs, _table(spark, sf_dir, "labels")))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts; a row that repeats id and text goes too. Rows without an id stay."""
    kept = exact_dedup(docs).filter("kept AND doc_id IS NOT NULL").select("doc_id")
    return _with_ids(docs, kept).dropDuplicates(["doc_id", "text"]).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked documents. Rows without an id stay."""
    groups = jaccard_components(docs)
    return _with_ids(docs, groups.filter("doc_id = component_id").select("doc_id"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a benchmark item."""
    return drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of at most 4096 tokens."""
    return best_fit_packing(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_duplicates),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packing),
]

# Trained weights, alignments and tokenizers have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
