"""Which files to queue, to which shard and endpoint."""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import empty_strings
from corpusloom.operators.catalog import filter_processed, filter_queued_before, queue_report
from corpusloom.operators.sharding import N_SHARDS, assign_endpoint, assign_shard
from corpusloom.sources.tracking_log import assign_ids


def ingest_plan(catalog: DataFrame, endpoints: list[str], force: bool = False,
                queued_date: datetime | str | None = None, n_shards: int = N_SHARDS,
                mode: str = "exact") -> DataFrame:
    """One queue message per file to process, with its shard and endpoint."""
    kept = filter_queued_before(filter_processed(catalog, force), queued_date)
    # Only names travel on from here; metadata and bodies are read where they are needed.
    sharded = assign_shard(kept.select("file_name", "container"), n_shards, mode=mode, out="recognizer_index")
    messages = assign_endpoint(sharded, endpoints, "recognizer_index").select(
        F.lit("").alias("id"), F.col("file_name").alias("source_file_name"),
        F.lit("").alias("processed_file_name"), F.col("container").alias("container_name"),
        "recognizer_index", empty_strings().alias("custom_fields"), "endpoint",
    )
    return assign_ids(messages)


class Ingest(NamedTuple):
    """The messages to send, and how many files were queued or skipped for which reason."""

    messages: DataFrame
    report: DataFrame


def ingest(catalog: DataFrame, endpoints: list[str], force: bool = False, queued_date: datetime | str | None = None,
           n_shards: int = N_SHARDS, mode: str = "exact", by: tuple[str, ...] = ()) -> Ingest:
    """The ingest plan with its report; both follow one rule of what is skipped."""
    messages = ingest_plan(catalog, endpoints, force, queued_date, n_shards, mode)
    return Ingest(messages, queue_report(catalog, force, queued_date, by))
