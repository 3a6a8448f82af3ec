"""The staged flow as Structured Streaming jobs over the same batch functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.operators.tracking import fold_state
from corpusloom.session import materialize
from corpusloom.sources.tracking_log import query_id, upsert_tracking

Transform = Callable[[DataFrame], DataFrame]
Sink = Callable[[DataFrame, int], None]


def stage_stream(source: DataFrame, transform: Transform, sink: Sink, checkpoint: str,
                 rejects: Sink | None = None) -> StreamingQuery:
    """Run one stage over all waiting messages.

    A batch is completed by the checkpoint only after ``sink`` returned; a failed batch
    runs again, so sinks are keyed by the batch number. Rows with a ``reject_reason`` go
    to ``rejects``.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch)
        if rejects is not None and "reject_reason" in out.columns:
            # Worked out once, so that the two sinks cannot disagree about a row.
            out = materialize(out, "staged")
            rejects(out.filter("reject_reason IS NOT NULL"), batch_id)
            out = out.filter("reject_reason IS NULL").drop("reject_reason")
        sink(out, batch_id)

    return (
        source.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def batch_folder(path: str) -> Sink:
    """A sink with one folder per run and batch, replaced when the batch runs again."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/run={query_id(df)}/batch_id={batch_id}")

    return write


def dedupe_messages(stream: DataFrame, key: str = "id", event_time: str | None = None,
                    delay: str = "1 hour") -> DataFrame:
    """First delivery of every message; with an event time the remembered keys expire after ``delay``."""
    if event_time is None or not stream.isStreaming:
        return stream.dropDuplicates([key])
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def tracking_stream(events: DataFrame, path: str, stage: str, checkpoint: str) -> StreamingQuery:
    """Append every step's events to the tracking log; records are folded from the log."""
    return stage_stream(
        events, lambda batch: batch, lambda df, n: upsert_tracking(df, path, stage, n), checkpoint,
    )


def tracking_state_stream(events: DataFrame, sink: Sink, checkpoint: str) -> StreamingQuery:
    """Keep the folded state per id in the state store and hand changed rows to ``sink``.

    The fold is a plain aggregation, so each task combines its events before the shuffle
    and a busy id costs one state row.
    """
    return (
        fold_state(events).writeStream.outputMode("update").foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def dead_letter(rejects: DataFrame, keys: tuple[str, ...] = ("id",), max_attempts: int = 10) -> DataFrame:
    """Rejected messages with reason and number of attempts; ``dead`` once there were too many."""
    return rejects.groupBy(*keys, "reject_reason").agg(F.count("*").alias("attempts")).withColumn(
        "dead", F.col("attempts") >= F.lit(max_attempts),
    )
