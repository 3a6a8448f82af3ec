"""Identifiers: pattern extraction, model replies, collection per document, masking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.rows import array_rows
from corpusloom.functions.text import content_lines, empty_strings
from corpusloom.operators.messages import default_fields
from corpusloom.operators.ordering import parts_by_position

# The labels an identifier may carry and its least length.
LABELS = (
    "Shipping ID", "BOL", "Bill of Lading", "Load ID", "Load Number", "Load Code",
    "Load Reference", "Load Ref", "Load ID Number", "Load ID Code", "Load ID Ref",
    "Load ID Reference", "Booking Number",
)
MIN_LENGTH = 8


def label_pattern(labels: tuple[str, ...] = LABELS, min_len: int = MIN_LENGTH) -> str:
    """A label, an optional separator, then one token. Longer labels are tried first."""
    names = "|".join(sorted(labels, key=lambda s: (-len(s), s))).replace(" ", r"\s+")
    return rf"(?i)\b(?:{names})\b\s*[:#.=-]*\s*([A-Za-z0-9]{{{min_len},}})\b"


def token_pattern(min_len: int = MIN_LENGTH) -> str:
    return rf"\b[A-Za-z0-9]{{{min_len},}}\b"


def is_table_or_list(line: Column) -> Column:
    """Table rows (two or more bars, or tab-separated cells) and list items."""
    return line.rlike(r"\|.*\|") | line.rlike(r"\t.*\t") | line.rlike(r"^\s*(?:[-*+]|\d+[.)])\s")


def identifiers_in(line: Column, labels: tuple[str, ...] = LABELS, min_len: int = MIN_LENGTH) -> Column:
    """Labelled tokens holding a digit, then bare tokens mixing letters and digits."""
    labelled = F.filter(
        F.regexp_extract_all(line, F.lit(label_pattern(labels, min_len)), F.lit(1)),
        lambda t: t.rlike("[0-9]"),
    )
    bare = F.filter(
        F.regexp_extract_all(line, F.lit(token_pattern(min_len)), F.lit(0)),
        lambda t: t.rlike("[0-9]") & t.rlike("[A-Za-z]"),
    )
    return F.concat(labelled, bare)


def identifiers_of(text: Column, labels: tuple[str, ...] = LABELS, min_len: int = MIN_LENGTH,
                   skip_tables: bool = True, distinct: bool = True) -> Column:
    """Identifiers of a text in order of occurrence, by default each once, within the row."""
    lines = content_lines(text)
    if skip_tables:
        lines = F.filter(lines, lambda x: ~is_table_or_list(x))
    found = F.flatten(F.transform(lines, lambda x: identifiers_in(x, labels, min_len)))
    return F.array_distinct(found) if distinct else found


def extract_identifiers(df: DataFrame, text: str = "chunk_text",
                        keep: tuple[str, ...] = ("processed_name", "chunk_pos"),
                        labels: tuple[str, ...] = LABELS, min_len: int = MIN_LENGTH,
                        skip_tables: bool = True, distinct: bool = True, model=None) -> DataFrame:
    """One row per identifier of a chunk: its position within the chunk and the identifier.

    ``model`` may take the place of the patterns: a column function, such as an Arrow UDF, from
    the text to an array of strings. Without ``distinct`` repeats in a chunk are kept.
    """
    found = model(F.col(text)) if model else identifiers_of(F.col(text), labels, min_len, skip_tables, distinct)
    return array_rows(df, keep, found, "field_pos", "field")


def collect_fields(chunk_fields: DataFrame, keys: tuple[str, ...] = ("processed_name",),
                   position: str = "chunk_pos", within: str = "field_pos", dedupe: bool = True,
                   part_size: int = 10_000) -> DataFrame:
    """Identifier list per document: distinct by first position, or all of them in order.

    Every ``part_size`` chunks make a part of their own.
    """
    rows = chunk_fields.select(*keys, "field", F.struct(position, within).alias("_first"))
    if dedupe:
        rows = rows.groupBy(*keys, "field").agg(F.min("_first").alias("_first"))
    order = [F.col("_first"), F.col("field").alias("_f")]
    return parts_by_position(
        rows, list(keys), F.col("_first")[position], order, F.col("field"), "custom_fields", part_size,
    )


def fields_or_marker(df: DataFrame, fields: str = "custom_fields") -> DataFrame:
    return df.withColumn(fields, default_fields(F.coalesce(F.col(fields), empty_strings())))


def clean_reply(c: Column) -> Column:
    """Model reply without its code fence."""
    return F.replace(F.replace(c, F.lit("```json"), F.lit("")), F.lit("```"), F.lit(""))


def clean_model_replies(replies: DataFrame, reply: str = "reply", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per string of each reply's JSON list; unreadable replies give no rows."""
    parsed = F.from_json(clean_reply(F.col(reply)), "array<string>")
    return array_rows(replies, keep, parsed, "pos", "field")


def mask(c: Column) -> Column:
    """First and last four characters with stars between; NULL for values under nine characters."""
    hidden = F.repeat(F.lit("*"), F.greatest(F.length(c) - 8, F.lit(0)))
    return F.when(F.length(c) >= 9, F.concat(F.left(c, F.lit(4)), hidden, F.right(c, F.lit(4))))


def mask_tokens(documents: DataFrame, pattern: str, text: str = "text",
                keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Every match of ``pattern`` in every text with its masked form; too-short matches are rejects."""
    matches = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    found = array_rows(documents, keep, matches, "pos", "_tok")
    return found.select(
        *keep, "pos", mask(F.col("_tok")).alias("masked"),
        F.when(F.length("_tok") < 9, "value too short").alias("reject_reason"),
    )
