"""Custom fields of the documents that ask for them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.chunking import with_chunks
from corpusloom.functions.text import DEFAULT_MAX_TOKENS
from corpusloom.operators.identifiers import identifiers_of
from corpusloom.operators.messages import has_fields, reject_reason, route_custom_fields


def identifiers(messages: DataFrame, max_tokens: int = DEFAULT_MAX_TOKENS, extract_all: bool = False,
                text: str = "text", fields: str = "custom_fields") -> DataFrame:
    """Messages with extracted fields, status and reject reason.

    Chunks and identifiers are worked out within the row of their document, so nothing is
    shuffled. Documents that ask for no fields are not read at all.
    """
    wanted = F.lit(True) if extract_all else has_fields(F.col(fields))
    staged = messages.withColumn("_text", F.when(wanted, F.col(text)))
    chunked = with_chunks(staged, "_text", "_chunks", max_tokens)
    found = F.array_distinct(F.flatten(F.transform("_chunks", lambda c: identifiers_of(c))))
    routed = route_custom_fields(chunked.withColumn("_found", found), "_found", extract_all, fields)
    return routed.withColumn(
        "reject_reason", F.when(wanted, reject_reason(F.col(text))),
    ).drop("_text", "_chunks", "_found")
