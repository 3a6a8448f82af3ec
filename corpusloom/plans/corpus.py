"""All stages over a catalogue in one batch run, with the events each of them records."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import DEFAULT_MAX_TOKENS
from corpusloom.functions.vectors import DEFAULT_DIM
from corpusloom.operators.catalog import mark_completed, move_outcomes
from corpusloom.operators.messages import (
    INDEXING_STATUS, MOVING_STATUS, PROCESSING_STATUS, QUEUES, reject_reason,
)
from corpusloom.operators.tracking import track
from corpusloom.plans.extraction import catalog_after, extract_and_name
from corpusloom.plans.fields import identifiers
from corpusloom.plans.indexing import index_rows
from corpusloom.plans.ingest import ingest_plan
from corpusloom.session import materialize

# Names under which the five stages record their events.
STAGES = ("queueing", "extraction", "fields", "indexing", "moving")


@dataclass
class CorpusRun:
    index: DataFrame
    events: DataFrame
    catalog: DataFrame
    rejects: DataFrame


def _sent(queue: str) -> list[Column]:
    return [F.lit(f"Sending to {queue}"), F.lit(f"Sent to {queue}")]


def process_corpus(catalog: DataFrame, texts: DataFrame, existing: DataFrame, endpoints: list[str],
                   run_time: Column, wanted_fields: DataFrame | None = None, force: bool = False,
                   queued_date=None, max_tokens: int = DEFAULT_MAX_TOKENS, dim: int = DEFAULT_DIM,
                   stages: tuple[str, ...] = STAGES) -> CorpusRun:
    """Queue, extract, find fields, index and move.

    ``texts`` has source_file_name and text; ``wanted_fields`` source_file_name and
    custom_fields for the documents that ask for fields. Texts and fields are written once;
    the index rows are worked out from there within the row.
    """
    queueing, extraction, fields, indexing, moving = stages
    docqueue, fieldqueue, indexqueue, movequeue = QUEUES

    messages = ingest_plan(catalog, endpoints, force, queued_date)
    if wanted_fields is not None:
        messages = messages.drop("custom_fields").join(wanted_fields, "source_file_name", "left")
    arrivals = catalog.select(F.col("file_name").alias("source_file_name"), "queued_at")
    named = extract_and_name(messages.join(arrivals, "source_file_name"), texts, existing, run_time)
    # The text store: name, outcome, body and fields of every queued document, worked out in one pass.
    asked = named.withColumnRenamed("reject_reason", "_lost").withColumn("_asked", F.col("custom_fields"))
    store = materialize(
        identifiers(asked, max_tokens).withColumnRenamed("reject_reason", "_no_content"), "extracted",
    )
    extracted = store.withColumn("custom_fields", F.col("_asked")).withColumnRenamed("_lost", "reject_reason")
    failed = F.col("reject_reason").isNotNull()
    # A document asking for fields without having text is dropped here, before indexing sees it.
    routed = store.filter(F.col("_lost").isNull()).withColumnRenamed("_no_content", "reject_reason")
    dropped = F.col("reject_reason").isNotNull()
    onward = routed.filter(~dropped).drop("reject_reason")
    empty = reject_reason(F.col("text")).isNotNull()
    moved = move_outcomes(
        onward.filter(~empty).drop("text", "status"), catalog, "documents",
    )
    processing = F.lit(PROCESSING_STATUS)

    def failure(stage: str, reason: Column) -> Column:
        return F.concat(F.lit(f"Failure in {stage}: "), reason)

    def either(bad: Column, why: Column, good: list[Column]) -> Column:
        return F.when(bad, F.array(processing, why)).otherwise(F.array(processing, *good))

    events = [
        track(extracted, queueing, F.array(*_sent(docqueue)), run_time, 0),
        track(extracted, extraction, either(failed, failure(extraction, F.col("reject_reason")), _sent(fieldqueue)), run_time, 2),
        track(routed, fields, either(dropped, F.lit(None).cast("string"), [F.col("status"), *_sent(indexqueue)]), run_time, 5),
        track(onward, indexing, either(empty, failure(indexing, F.lit("no content")), [F.lit(INDEXING_STATUS), *_sent(movequeue)]),
              run_time, 9),
        track(moved, moving, F.array(F.lit(MOVING_STATUS), F.col("status")), run_time, 13),
    ]
    rejects = (
        extracted.filter(failed).select("id", "source_file_name", F.lit(extraction).alias("stage"), "reject_reason")
        .unionByName(routed.filter(dropped).select("id", "source_file_name", F.lit(fields).alias("stage"), "reject_reason"))
        .unionByName(onward.filter(empty).select(
            "id", "source_file_name", F.lit(indexing).alias("stage"), reject_reason(F.col("text")).alias("reject_reason"),
        ))
    )
    return CorpusRun(
        index=index_rows(onward, max_tokens, dim),
        events=reduce(DataFrame.unionByName, events),
        catalog=mark_completed(catalog_after(catalog, extracted, run_time), moved),
        rejects=rejects,
    )
