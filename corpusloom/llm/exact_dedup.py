"""Exact duplicates: rows grouped by a 128-bit content hash, with the bytes compared inside each group.

Main path: DataFrame functions only. The bytes are compared by grouping on (hash, text): the hash
table of the aggregation compares whole keys, and its partial step leaves one row per task of a text
that a third of the rows hold. A text therefore crosses the network once per task that has it. All
later steps work on rows of fixed width.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE_SPACE = (" ", "\t", "\n", "\x0b", "\x0c", "\r")


def without_space(text: Column) -> Column:
    """``text`` without the characters of ``[\\x20\\x09-\\x0D]``; NULL counts as empty."""
    out = F.coalesce(text, F.lit(""))
    for c in WHITE_SPACE:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def content_hash(normal: Column) -> Column:
    """128 bits."""
    return F.unhex(F.md5(F.encode(normal, "UTF-8")))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                hash_of: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical without white space. The row with the most code points
    in its original text stays, on a tie the smallest id.

    - NULL text counts as empty; all empty and all-blank texts are one group.
    - A NULL id sorts after every other id; ``keep_id`` is NULL only if no row of the best length has an id.
    - Rows that repeat an id with an equally long text are the same document: they stay or go together.
    - Two different texts with one content hash are different groups.
    - Other columns of ``docs``, whatever their names, are not read. An empty table gives no rows.
    """
    narrow = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("_text"),
    ).withColumn("_normal", without_space(F.col("_text"))).select(
        "doc_id", "_normal",
        F.length(F.coalesce(F.col("_text"), F.lit(""))).cast("bigint").alias("_points"),
        hash_of(F.col("_normal")).alias("_hash"),
        F.sha2(F.encode(F.col("_normal"), "UTF-8"), 256).alias("text_sha256"),
    )
    groups = (
        narrow.groupBy("_hash", "_normal", "_points")
        .agg(F.count("*").alias("_rows"), F.min("doc_id").alias("_first"))
        # The digest of the grouped bytes names the group from here on, within its hash.
        .select("_hash", F.sha2(F.encode("_normal", "UTF-8"), 256).alias("text_sha256"), "_points", "_rows", "_first")
        .groupBy("_hash", "text_sha256")
        .agg(
            F.sum("_rows").alias("group_size"),
            # Longest first, then rows with an id, then the smallest id.
            F.max(F.struct("_points", F.col("_first").isNotNull(), (-F.col("_first")).alias("_minus"))).alias("_best"),
        )
    )
    # One joined key, which neither side is dealt by yet: both are shuffled for the join alone, so adaptive
    # execution may split the rows of a text that very many documents have.
    key = F.concat("_hash", F.unhex("text_sha256")).alias("_key")
    rows = narrow.select("doc_id", "_points", "text_sha256", key)
    groups = groups.select(key, "group_size", "_best")
    keep_id = -F.col("_best._minus")
    return rows.join(groups, "_key").select(
        "doc_id",
        keep_id.alias("keep_id"),
        "group_size",
        ((F.col("_points") == F.col("_best._points")) & F.col("doc_id").eqNullSafe(keep_id)).alias("kept"),
        "text_sha256",
    )
