"""The text functions for use from SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from corpusloom.functions.chunking import pack_text, split_line
from corpusloom.functions.text import CHARS_PER_TOKEN


class ChunkText:
    """``chunk_text(text, max_tokens)``: the chunks of one text as rows."""

    def eval(self, text: str, max_tokens: int):
        if text is not None:
            yield from enumerate(pack_text(text, max_tokens, CHARS_PER_TOKEN, "utf16"))


class SplitLine:
    """``split_line(line, max_chars)``: the pieces of one long line as rows."""

    def eval(self, line: str, max_chars: int):
        if line is not None:
            yield from enumerate(split_line(line, max_chars, "utf16"))


def register_functions(spark: SparkSession) -> None:
    """Make ``chunk_text`` and ``split_line`` available to lateral joins in SQL."""
    spark.udtf.register("chunk_text", udtf(ChunkText, returnType="chunk_pos int, chunk_text string"))
    spark.udtf.register("split_line", udtf(SplitLine, returnType="piece_pos int, piece string"))
