"""The file catalogue: which files to queue, and where they are."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Metadata keys and the value written after extraction.
PROCESSED_KEY = "Processed"
QUEUED_KEY = "IsQueued"
PROCESSED_VALUE = "true"

# Accepted spellings of the queue time, tried in this order, then ISO-8601.
TIME_FORMATS = ("M/d/yyyy H:mm:ss", "M/d/yyyy h:mm:ss a")

COPY_BLOCK = 1000


def queue_time(metadata: Column) -> Column:
    """The parsed queue time, NULL where missing or unreadable."""
    text = F.try_element_at(metadata, F.lit(QUEUED_KEY))
    tried = [F.try_to_timestamp(text, F.lit(f)) for f in TIME_FORMATS]
    return F.coalesce(*tried, text.try_cast("timestamp"))


def skip_reason(metadata: Column, force: bool = False, queued_date: datetime | str | None = None) -> Column:
    """'processed', 'queued_later' or NULL for a file that is to be queued."""
    done = F.lit(False) if force else F.coalesce(F.map_contains_key(metadata, PROCESSED_KEY), F.lit(False))
    later = F.lit(False)
    if queued_date is not None:
        later = F.coalesce(queue_time(metadata) > F.lit(queued_date).cast("timestamp"), F.lit(False))
    return F.when(done, "processed").when(later, "queued_later")


def filter_processed(catalog: DataFrame, force: bool = False) -> DataFrame:
    """Drop files whose metadata has the processed key, whatever its value."""
    return catalog.filter(skip_reason(F.col("metadata"), force).isNull())


def filter_queued_before(catalog: DataFrame, queued_date: datetime | str | None = None) -> DataFrame:
    """Drop files queued strictly later than the date; unreadable times are kept."""
    return catalog.filter(skip_reason(F.col("metadata"), True, queued_date).isNull())


def set_metadata(catalog: DataFrame, key: str, value: Column) -> DataFrame:
    """Replace the whole metadata map by one pair."""
    return catalog.withColumn("metadata", F.create_map(F.lit(key), value.cast("string")))


def mark_queued(catalog: DataFrame, at: Column | None = None) -> DataFrame:
    stamp = F.date_format(F.current_timestamp() if at is None else at, "MM/dd/yyyy HH:mm:ss")
    return set_metadata(catalog, QUEUED_KEY, stamp)


def mark_processed(catalog: DataFrame) -> DataFrame:
    return set_metadata(catalog, PROCESSED_KEY, F.lit(PROCESSED_VALUE))


def queue_report(catalog: DataFrame, force: bool = False, queued_date: datetime | str | None = None,
                 by: tuple[str, ...] = ()) -> DataFrame:
    """Number of files queued and skipped, by reason and any further columns."""
    reason = F.coalesce(skip_reason(F.col("metadata"), force, queued_date), F.lit("queued"))
    return catalog.withColumn("reason", reason).groupBy("reason", *by).agg(F.count("*").alias("n_files"))


def skip_existing(new: DataFrame, existing: DataFrame, key: str = "file_name") -> DataFrame:
    """Rows whose key is not stored yet. Stored keys are made distinct before the join."""
    return new.join(existing.select(key).distinct(), key, "left_anti")


def duplicate_corpus(df: DataFrame, start: int = 0, count: int = 100, name: str = "file_name") -> DataFrame:
    """``count`` numbered copies of every listed file; copies are not copied again."""
    if count <= 0:
        return df.filter(F.lit(False)).withColumn("copy", F.lit(0).cast("bigint"))
    # In two steps, so that no row ever holds a list of all copy numbers.
    last = F.lit(start + count - 1).cast("bigint")
    blocks = F.sequence(F.lit(start).cast("bigint"), last, F.lit(COPY_BLOCK).cast("bigint"))
    first = F.col("copy")
    return (
        df.withColumn("copy", F.explode(blocks))
        .withColumn("copy", F.explode(F.sequence(first, F.least(first + COPY_BLOCK - 1, last))))
        .withColumn(name, F.format_string("%06d-%s", F.col("copy"), F.col(name)))
    )


def mark_completed(catalog: DataFrame, messages: DataFrame, completed: str = "completed",
                   name: str = "file_name", message_name: str = "source_file_name") -> DataFrame:
    """The catalogue after moving every file named by a message to the completed container."""
    moved = messages.select(F.col(message_name).alias(name)).distinct().withColumn("_moved", F.lit(True))
    return (
        catalog.join(moved, name, "left")
        .withColumn("container", F.when(F.col("_moved"), F.lit(completed)).otherwise(F.col("container")))
        .drop("_moved")
    )


def move_outcomes(messages: DataFrame, catalog: DataFrame, source: str,
                  name: str = "file_name", message_name: str = "source_file_name") -> DataFrame:
    """Messages with the status their move leaves; a missing source file fails, the message completes."""
    present = catalog.filter(F.col("container") == source).select(F.col(name).alias(message_name)).distinct()
    found = messages.join(present.withColumn("_found", F.lit(True)), message_name, "left")
    # The two closing statuses.
    return found.withColumn(
        "status",
        F.when(F.col("_found"), "Successfully moved original file").otherwise("Failed to move original file"),
    ).drop("_found")


def sweep_processed(catalog: DataFrame, completed: str = "completed") -> DataFrame:
    """Move every file that carries the processed key; one pass, no join."""
    done = F.coalesce(F.map_contains_key("metadata", PROCESSED_KEY), F.lit(False))
    return catalog.withColumn("container", F.when(done, F.lit(completed)).otherwise(F.col("container")))
