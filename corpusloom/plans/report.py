"""One table that says how the processing went."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.ordering import DEFAULT_HOT_ROWS
from corpusloom.operators.tracking import backlog, failures, fold_tracking, stage_timings


def tracking_report(events: DataFrame, hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """(section, name, detail, n, seconds): documents by last status, timings, backlog and failures."""

    def rows(df: DataFrame, section: str, name: str, detail, n: str, seconds=None) -> DataFrame:
        return df.select(
            F.lit(section).alias("section"), F.col(name).alias("name"), detail.alias("detail"),
            F.col(n).cast("bigint").alias("n"),
            (F.lit(None) if seconds is None else F.col(seconds)).cast("double").alias("seconds"),
        )

    none = F.lit("")
    last = fold_tracking(events).groupBy("last_source", "last_status").agg(F.count("*").alias("n"))
    return (
        rows(last, "last status", "last_source", F.col("last_status"), "n")
        .unionByName(rows(stage_timings(events, hot_rows), "timing", "source", F.col("status"), "n_steps", "avg_seconds"))
        .unionByName(rows(backlog(events), "backlog", "queue", none, "n_documents"))
        .unionByName(rows(failures(events), "failure", "stage", F.col("message"), "n_failures"))
    )
