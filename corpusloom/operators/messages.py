"""Queue messages: encoding, routing, text look-up, rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import empty_strings
from corpusloom.schemas import MESSAGE

# Queue names, statuses and the marker for a document without identifiers.
QUEUES = ("docqueue", "customfieldqueue", "toindexqueue", "movequeue")
NO_FIELDS_STATUS = "No Custom Fields Specified. Abandoning extraction"
EXTRACTING_STATUS = "Extracting Custom Field"
PROCESSING_STATUS = "Processing"
INDEXING_STATUS = "Adding to Index"
MOVING_STATUS = "Moving original file"
NOT_FOUND = "NOT FOUND"


def encode_messages(df: DataFrame, columns: list[str] | None = None, out: str = "value") -> DataFrame:
    """Each row as one JSON object in ``out``."""
    return df.withColumn(out, F.to_json(F.struct(*(columns or df.columns))))


def decode_messages(df: DataFrame, schema: T.StructType = MESSAGE, value: str = "value",
                    required: str | None = None) -> DataFrame:
    """JSON objects to columns, with ``reject_reason`` set where a value cannot be read."""
    parsed = df.withColumn("_m", F.from_json(F.col(value), schema))
    names = schema.fieldNames()
    broken = F.col("_m").isNull()
    # PERMISSIVE parsing turns a malformed object into a struct of NULLs.
    empty = F.lit(True)
    for n in names:
        empty = empty & F.col("_m")[n].isNull()
    # An object without any known key is read as one with all of them missing.
    broken = broken | (empty & F.json_object_keys(F.col(value)).isNull())
    if required:
        broken = broken | F.col("_m")[required].isNull()
    return parsed.select(
        *[c for c in df.columns], *[F.col("_m")[n].alias(n) for n in names],
        F.when(broken, "unreadable message").alias("reject_reason"),
    )


def default_fields(c: Column) -> Column:
    """The marker list in place of an empty or missing identifier list."""
    return F.when(F.size(F.coalesce(c, empty_strings())) == 0, F.array(F.lit(NOT_FOUND))).otherwise(c)


def has_fields(c: Column) -> Column:
    return F.size(F.coalesce(c, empty_strings())) > 0


def route_custom_fields(messages: DataFrame, extracted: str, extract_all: bool = False,
                        fields: str = "custom_fields") -> DataFrame:
    """Replace the field list by the extracted one where fields were asked for.

    Both routes go to the same queue, so this is one projection; ``status`` tells them apart.
    """
    wanted = F.lit(True) if extract_all else has_fields(F.col(fields))
    return messages.withColumn(
        "status", F.when(wanted, EXTRACTING_STATUS).otherwise(NO_FIELDS_STATUS),
    ).withColumn(
        fields, F.when(wanted, default_fields(F.col(extracted))).otherwise(F.coalesce(F.col(fields), empty_strings())),
    )


def attach_text(messages: DataFrame, texts: DataFrame, key: str = "processed_file_name") -> DataFrame:
    """Messages with their text; NULL text where none is stored.

    ``texts`` is unique in ``key``, so a name shared by many messages is split by
    adaptive skew handling of the left side.
    """
    return messages.join(texts, key, "left")


def reject_reason(text: Column) -> Column:
    """White space counts as content here, as it does when messages are processed."""
    return F.when(text.isNull() | (text == ""), "no content")


def reject_empty(df: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows with text, rejects with a reason)."""
    flagged = df.withColumn("reject_reason", reject_reason(F.col(text)))
    return flagged.filter("reject_reason IS NULL").drop("reject_reason"), flagged.filter("reject_reason IS NOT NULL")


def clone_with_overrides(df: DataFrame, **overrides: Column) -> DataFrame:
    """A message with some columns replaced where the override is not NULL; history stays behind."""
    replaced = {c: F.coalesce(v, F.col(c)) for c, v in overrides.items()}
    return df.withColumns(replaced).drop("tracking")
