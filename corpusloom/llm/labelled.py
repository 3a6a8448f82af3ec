"""Bounded samples of labelled documents, and the split that keeps rows back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_col: str, folds: int) -> Column:
    """crc32 of the id written as text, modulo ``folds``; NULL for a NULL id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def held_out(id_col: str, folds: int, fold: int) -> Column:
    """Whether a row is kept back from learning. A NULL id has no labels and is not kept back."""
    return F.coalesce(remainder(id_col, folds) == fold, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, limit: int, folds: int, fold: int,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, label) of at most ``limit`` labelled documents that are not held out.

    The sample is chosen by a hash of the id, so it is the same in every run and does not depend on
    text, language or source. Labels other than 0 and 1 and NULL ids are left out; an id with several
    labels counts with the larger one. It is small enough to be broadcast, being bounded by ``limit``.
    """
    chosen = (
        labels.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & (remainder("doc_id", folds) != fold))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    )
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.join(F.broadcast(chosen), "doc_id")
