"""Queues as streams of JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.operators.messages import encode_messages


def queue_source(spark: SparkSession, path: str, fmt: str = "files", max_files: int | None = None,
                 **options: str) -> DataFrame:
    """A stream with the message JSON in ``value``: a folder of files, or a Kafka topic named by ``path``."""
    if fmt == "kafka":
        stream = spark.readStream.format("kafka").option("subscribe", path).options(**options).load()
        return stream.select(F.col("value").cast("string").alias("value"))
    reader = spark.readStream.format("text").options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def send(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """Append a batch of messages to a queue folder."""
    encode_messages(df, columns).select("value").write.mode("append").text(path)


def queue_sink(stream: DataFrame, path: str, checkpoint: str, fmt: str = "files",
               columns: list[str] | None = None, **options: str) -> StreamingQuery:
    """Write a stream of messages to a queue; a message counts as done once the checkpoint says so."""
    out = encode_messages(stream, columns).select("value").writeStream.option("checkpointLocation", checkpoint)
    if fmt == "kafka":
        out = out.format("kafka").option("topic", path).options(**options)
        return out.trigger(availableNow=True).start()
    return out.format("text").option("path", path).trigger(availableNow=True).start()
