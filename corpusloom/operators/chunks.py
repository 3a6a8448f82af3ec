"""Lines and chunks of documents as rows, and their way back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.chunking import split_line_udf, with_chunks
from corpusloom.functions.rows import array_rows
from corpusloom.functions.text import (
    CHARS_PER_TOKEN,
    DEFAULT_MAX_TOKENS,
    content_lines,
    text_units,
    token_estimate,
)
from corpusloom.operators.ordering import parts_by_position


def split_lines(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("processed_name",)) -> DataFrame:
    """One row per line with content, numbered from 0 within its document."""
    return array_rows(df, keep, content_lines(F.col(text)), "line_pos", "line")


def chunk_text(df: DataFrame, max_tokens: int = DEFAULT_MAX_TOKENS, chars_per_token: int = CHARS_PER_TOKEN,
               text: str = "text", keep: tuple[str, ...] = ("processed_name",), units: str = "utf16") -> DataFrame:
    """One row per chunk: position, text and token estimate. No shuffle."""
    packed = with_chunks(df.select(*keep, text), text, "_chunks", max_tokens, chars_per_token, units)
    rows = array_rows(packed, keep, "_chunks", "chunk_pos", "chunk_text")
    return rows.withColumn("n_tokens", token_estimate(F.col("chunk_text"), chars_per_token, units))


def split_long_line(df: DataFrame, max_chars: int, line: str = "line", keep: tuple[str, ...] = (),
                    units: str = "utf16") -> DataFrame:
    """Pieces of every line whose token estimate exceeds ``max_chars / 4``; shorter lines stay whole."""
    cost = token_estimate(F.col(line), CHARS_PER_TOKEN, units)
    long_line = cost > F.lit(max_chars // CHARS_PER_TOKEN)
    pieces = split_line_udf(max_chars, units)(F.when(long_line, F.col(line)))
    every = F.when(long_line, F.col("_pieces")).otherwise(F.array(F.col(line)))
    rows = array_rows(df.withColumn("_pieces", pieces), keep, every, "piece_pos", "piece")
    return rows.withColumn("n_chars", text_units(F.col("piece"), units))


def rejoin_chunks(chunks: DataFrame, keys: tuple[str, ...] = ("processed_name",), sep: str = "\n",
                  part_size: int = 4000) -> DataFrame:
    """Document text from its chunks in order; every ``part_size`` chunks make a part of their own."""
    at = F.col("chunk_pos")
    parts = parts_by_position(chunks, list(keys), at, [at], F.col("chunk_text"), "_texts", part_size)
    return parts.select(*keys, "part", F.array_join("_texts", sep).alias("text"))
