"""Source files to stored, uniquely named text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.catalog import mark_processed, mark_queued
from corpusloom.operators.extract import extract_text
from corpusloom.operators.messages import clone_with_overrides
from corpusloom.operators.sharding import resolve_names
from corpusloom.session import materialize
from corpusloom.sources.documents import stored_names, write_texts


def extract_and_name(messages: DataFrame, texts: DataFrame, existing: DataFrame, run_time: Column,
                     container: str = "processresults", arrival: str = "queued_at") -> DataFrame:
    """Messages with result name, outcome and text.

    ``texts`` has source_file_name and text. Names are settled on the narrow messages
    first; the bodies join last.
    """
    named = resolve_names(messages, existing, run_time, "source_file_name", arrival)
    moved = clone_with_overrides(
        named, processed_file_name=F.col("result_name"),
        container_name=F.when(F.col("outcome") != "failed", F.lit(container)),
    ).drop("result_name")
    with_text = moved.join(texts.select("source_file_name", "text"), "source_file_name", "left")
    reason = (
        F.when(F.col("text").isNull(), "no text extracted")
        .when(F.col("outcome") == "failed", "result name taken")
    )
    return with_text.withColumn("reject_reason", reason)


def extract_and_store(messages: DataFrame, pages: DataFrame, store: str, run_time: Column, model=None,
                      container: str = "processresults", arrival: str = "queued_at") -> DataFrame:
    """Pages to text, named against the text store at ``store`` and written there; the messages without their texts.

    ``pages`` has source_file_name and html. A page without text, or whose name is taken, keeps its message with a
    ``reject_reason`` and writes nothing. The same messages again find their names taken by themselves, so nothing is doubled.
    """
    read = extract_text(pages, model=model)
    texts = read.select("source_file_name", F.when(F.col("reject_reason").isNull(), F.col("text")).alias("text"))
    taken = stored_names(messages.sparkSession, store, "processed_name").withColumnRenamed("processed_name", "result_name")
    # Names depend on what is stored, so they are settled before anything is written.
    extracted = materialize(extract_and_name(messages, texts, taken, run_time, container, arrival), "extracted")
    good = extracted.filter("reject_reason IS NULL").select(F.col("processed_file_name").alias("processed_name"), "text")
    write_texts(good.dropDuplicates(["processed_name"]), store)
    return extracted.drop("text")


def catalog_after(catalog: DataFrame, extracted: DataFrame, queued_at: Column | None = None) -> DataFrame:
    """The catalogue with the files that got a result marked as processed.

    With ``queued_at`` the other files among ``extracted`` carry the time they were queued.
    """
    done = extracted.groupBy(F.col("source_file_name").alias("file_name")).agg(
        F.max(F.col("reject_reason").isNull()).alias("_done"),
    )
    joined = catalog.join(done, "file_name", "left").withColumn("_old", F.col("metadata"))
    stamped = joined if queued_at is None else mark_queued(joined, queued_at)
    stamped = stamped.withColumn("_stamped", F.col("metadata"))
    return mark_processed(stamped).withColumn(
        "metadata",
        F.when(F.col("_done"), F.col("metadata")).when(~F.col("_done"), F.col("_stamped")).otherwise(F.col("_old")),
    ).drop("_done", "_old", "_stamped")
