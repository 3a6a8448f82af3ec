"""Per-document history: folding, merging, timings, backlog, failures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.rows import array_rows
from corpusloom.operators.ordering import DEFAULT_HOT_ROWS, collect_parts, group_lag

# Columns the first event of a document fixes, and those every later event overwrites.
FIRST_WINS = ("source_file_name", "recognizer_index")
LAST_WINS = ("processed_file_name", "container_name", "custom_fields")
ITEM = ("source", "status", "event_time")


def track(messages: DataFrame, source: str, statuses: Column, at: Column, first_seq: int = 0) -> DataFrame:
    """Tracking events of one stage: a row per message and entry of the array ``statuses``.

    NULL entries leave no event. Numbers count from ``first_seq``, so the events of a
    message keep their order over all stages.
    """
    rows = messages.select("id", *FIRST_WINS, *LAST_WINS, statuses.alias("_statuses"))
    events = array_rows(rows, ("id", *FIRST_WINS, *LAST_WINS), "_statuses", "_n", "status")
    return events.filter(F.col("status").isNotNull()).select(
        "id", (F.col("_n") + first_seq).cast("bigint").alias("seq"), F.lit(source).alias("source"), "status",
        at.alias("event_time"), *FIRST_WINS, *LAST_WINS,
    )


def distinct_events(events: DataFrame) -> DataFrame:
    """Events without redeliveries: one row per (id, seq)."""
    return events.dropDuplicates(["id", "seq"])


def latest_tracking(events: DataFrame) -> DataFrame:
    """Last event of every id. Partial maxima are taken before the shuffle."""
    last = events.groupBy("id").agg(
        F.max("seq").alias("seq"), F.max_by(F.struct(*ITEM), "seq").alias("_last"),
    )
    return last.select("id", "seq", *[F.col("_last")[c].alias(c) for c in ITEM])


def fold_state(events: DataFrame) -> DataFrame:
    """Events to mergeable state rows (id, first_seq, first, last_seq, last, n_events)."""
    first = F.struct(*[F.col(c) for c in FIRST_WINS])
    last = F.struct(*[F.col(c) for c in (*LAST_WINS, *ITEM)])
    return events.groupBy("id").agg(
        F.min("seq").alias("first_seq"), F.min_by(first, "seq").alias("first"),
        F.max("seq").alias("last_seq"), F.max_by(last, "seq").alias("last"),
        F.count("*").alias("n_events"),
    )


def merge_state(state: DataFrame, updates: DataFrame) -> DataFrame:
    """Stored state rows with new ones, keyed by id; equals the fold over all events."""
    return state.unionByName(updates).groupBy("id").agg(
        F.min("first_seq").alias("first_seq"), F.min_by("first", "first_seq").alias("first"),
        F.max("last_seq").alias("last_seq"), F.max_by("last", "last_seq").alias("last"),
        F.sum("n_events").alias("n_events"),
    )


def state_record(state: DataFrame) -> DataFrame:
    """State rows as flat records. Blanks of the last event stand; they are not filled from earlier ones."""
    return state.select(
        "id", *[F.col("first")[c].alias(c) for c in FIRST_WINS], *[F.col("last")[c].alias(c) for c in LAST_WINS],
        F.col("last")["source"].alias("last_source"), F.col("last")["status"].alias("last_status"),
        F.col("last")["event_time"].alias("last_time"), "n_events",
    )


def fold_tracking(events: DataFrame) -> DataFrame:
    """One record per id: first source name and shard, last result name, container and fields."""
    return state_record(fold_state(events))


def tracking_history(events: DataFrame, part_size: int = 1000, hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """History array per id in arrival order.

    A usual document has its whole history in part 0; an id with more than ``part_size``
    events continues in further parts.
    """
    return collect_parts(events, ["id"], ["seq"], F.struct(*ITEM), "tracking", part_size, hot_rows)


def step_seconds(events: DataFrame, hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Each event with the seconds since the preceding event of its id."""
    slim = events.select("id", "seq", *ITEM)
    lagged = group_lag(slim, ["id"], ["event_time", "seq"], "event_time", "_before", hot_rows)
    micros = F.unix_micros("event_time") - F.unix_micros("_before")
    return lagged.withColumn("seconds", micros / F.lit(1_000_000.0)).drop("_before")


def stage_timings(events: DataFrame, hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Per source and status: steps with a predecessor, mean, median and longest seconds."""
    return step_seconds(events, hot_rows).groupBy("source", "status").agg(
        F.count("seconds").alias("n_steps"),
        F.round(F.avg("seconds"), 3).alias("avg_seconds"),
        F.round(F.percentile_approx("seconds", 0.5, 10_000), 3).alias("median_seconds"),
        F.round(F.max("seconds"), 3).alias("max_seconds"),
    )


def backlog(events: DataFrame) -> DataFrame:
    """Documents waiting in each queue: those whose last event says they were sent there."""
    queue = F.regexp_extract("status", r"^Sent to (.*)$", 1)
    return (
        latest_tracking(events).filter(F.col("status").startswith("Sent to "))
        .groupBy(queue.alias("queue")).agg(F.count("*").alias("n_documents"))
    )


def failures(events: DataFrame) -> DataFrame:
    """Failure statuses by stage and message."""
    pattern = r"^Failure in (\w+): (.*)$"
    return (
        events.filter(F.col("status").rlike(pattern))
        .groupBy(F.regexp_extract("status", pattern, 1).alias("stage"),
                 F.regexp_extract("status", pattern, 2).alias("message"))
        .agg(F.count("*").alias("n_failures"))
    )
