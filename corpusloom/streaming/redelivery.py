"""A stage whose failed messages come back to its queue, with a count of deliveries, until they succeed or are given up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.session import materialize
from corpusloom.sources.queues import queue_source
from corpusloom.sources.tracking_log import query_id
from corpusloom.streaming.stages import Sink, Transform, batch_folder

MAX_ATTEMPTS = 10

# A message that was delivered before travels in an envelope; others are their own body.
_ENVELOPE = "body string, attempt int"


def opened(queue: DataFrame) -> DataFrame:
    """(value, attempt): message JSON and which delivery this is, counted from 1."""
    packed = queue.withColumn("_e", F.from_json("value", _ENVELOPE))
    again = F.col("_e.body").isNotNull() & F.col("_e.attempt").isNotNull()
    return packed.select(
        F.when(again, F.col("_e.body")).otherwise(F.col("value")).alias("value"),
        F.when(again, F.col("_e.attempt")).otherwise(1).alias("attempt"),
    )


def redelivering_stage(spark: SparkSession, queue: str, transform: Transform, sink: Sink, checkpoint: str, dead: str,
                       max_attempts: int = MAX_ATTEMPTS) -> StreamingQuery:
    """Run a stage over the waiting messages of a queue folder, once.

    ``transform`` gets (value, attempt), keeps both columns and sets ``reject_reason`` on the rows that failed; one of them does
    not stop its batch. They go back to the queue for the next run, or after ``max_attempts`` deliveries to the folder ``dead``.
    All folders are named by run and batch, so a batch that runs again replaces what it wrote.
    """
    give_up = batch_folder(dead)

    def run(batch: DataFrame, batch_id: int) -> None:
        # Worked out once, so that a row cannot both pass and come back.
        out = materialize(transform(opened(batch)), "staged")
        failed, last = F.col("reject_reason").isNotNull(), F.col("attempt") >= max_attempts
        again = out.filter(failed & ~last).select(
            F.to_json(F.struct(F.col("value").alias("body"), (F.col("attempt") + 1).alias("attempt"))).alias("value"),
        )
        again.write.mode("overwrite").text(f"{queue}/again/run={query_id(batch)}/batch_id={batch_id}")
        give_up(out.filter(failed & last).select("value", "attempt", "reject_reason"), batch_id)
        sink(out.filter(~failed).drop("reject_reason"), batch_id)

    return (
        queue_source(spark, queue, recursiveFileLookup="true").writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def drain(spark: SparkSession, queue: str, transform: Transform, sink: Sink, checkpoint: str, dead: str,
          max_attempts: int = MAX_ATTEMPTS) -> int:
    """Run the stage until no message is left waiting; the number of runs that had messages."""
    runs = 0
    while True:
        query = redelivering_stage(spark, queue, transform, sink, checkpoint, dead, max_attempts)
        query.awaitTermination()
        if not any(p["numInputRows"] for p in query.recentProgress):
            return runs
        runs += 1
