"""Append-only event table behind the tracking records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import is_blank
from corpusloom.operators.tracking import distinct_events


def assign_ids(messages: DataFrame, name: str = "source_file_name", container: str = "container_name") -> DataFrame:
    """Fill blank ids from container and file name, so that a retry of the task gives the same id."""
    made = F.sha1(F.concat_ws("\u0001", F.col(container), F.col(name)).cast("binary"))
    return messages.withColumn("id", F.when(is_blank(F.col("id")), made).otherwise(F.col("id")))


def upsert_tracking(batch: DataFrame, path: str, stage: str, batch_id: int, run: str | None = None) -> None:
    """Write one batch of events to its own folder.

    Running the same batch again replaces that folder, so nothing stored has to be read
    here. Batches of another ``run`` have folders of their own; by default the run is the streaming
    query, whose id lives in its checkpoint. Redeliveries in other batches fall away when the log is read.
    """
    run = run or query_id(batch)
    batch.write.mode("overwrite").parquet(f"{path}/stage={stage}/run={run}/batch_id={batch_id}")


def query_id(batch: DataFrame) -> str:
    """Id of the streaming query that a batch belongs to, which a restart keeps and a new checkpoint changes."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def read_tracking(spark: SparkSession, path: str) -> DataFrame:
    """All events once each."""
    return distinct_events(spark.read.parquet(path).drop("stage", "run", "batch_id"))
