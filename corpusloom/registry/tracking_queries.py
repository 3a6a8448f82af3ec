"""Histories, timings, backlog and failures."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import tracking as T
from corpusloom.plans.report import tracking_report as report
from corpusloom.registry.base import TRACKING_SQL, query, tracking

RECORD = "id, source_file_name, recognizer_index, processed_file_name, container_name, fields, last_source, last_status, last_time, n_events"
FOLD_SQL = f"""folded AS (SELECT id, arg_min(source_file_name, seq) AS source_file_name, arg_min(recognizer_index, seq) AS recognizer_index,
  arg_max(processed_file_name, seq) AS processed_file_name, arg_max(container_name, seq) AS container_name,
  array_to_string(arg_max(custom_fields, seq), '|') AS fields, arg_max(source, seq) AS last_source,
  arg_max(status, seq) AS last_status, arg_max(event_time, seq) AS last_time, count(*) AS n_events FROM tracking GROUP BY id)"""


def record(df):
    flat = df.withColumn("fields", F.array_join("custom_fields", "|"))
    return flat.withColumn("last_time", F.col("last_time").cast("timestamp_ntz")).select(*RECORD.split(", "))


@query(f"""WITH {TRACKING_SQL} SELECT id, max(seq) AS seq, arg_max(source, seq) AS source, arg_max(status, seq) AS status,
  arg_max(event_time, seq) AS event_time FROM tracking GROUP BY id""")
def latest_tracking(spark, sf):
    return T.latest_tracking(tracking(spark, sf)).withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


@query(f"WITH {TRACKING_SQL}, {FOLD_SQL} SELECT {RECORD} FROM folded")
def fold_tracking(spark, sf):
    return record(T.fold_tracking(tracking(spark, sf)))


@query(f"WITH {TRACKING_SQL}, {FOLD_SQL} SELECT {RECORD} FROM folded")
def merge_state(spark, sf):
    events = tracking(spark, sf)
    stored = T.fold_state(events.filter(F.col("seq") % 3 != 0))
    return record(T.state_record(T.merge_state(stored, T.fold_state(events.filter(F.col("seq") % 3 == 0)))))


@query(f"""WITH {TRACKING_SQL}, p AS (SELECT *, (row_number() OVER (PARTITION BY id ORDER BY seq) - 1) // 20 AS part FROM tracking)
  SELECT id, CAST(part AS INTEGER) AS part, string_agg(source || ':' || status, '|' ORDER BY seq) AS history,
    min(event_time) AS since FROM p GROUP BY id, part""")
def tracking_history(spark, sf):
    parts = T.tracking_history(tracking(spark, sf), 20)
    steps = F.transform("tracking", lambda x: F.concat(x["source"], F.lit(":"), x["status"]))
    return parts.select(
        "id", "part", F.array_join(steps, "|").alias("history"),
        F.array_min(F.transform("tracking", lambda x: x["event_time"])).cast("timestamp_ntz").alias("since"),
    )


TIMINGS_SQL = """lagged AS (SELECT *, (epoch_us(event_time) - epoch_us(lag(event_time) OVER (PARTITION BY id ORDER BY event_time, seq))) / 1000000.0 AS seconds FROM tracking),
timings AS (SELECT source, status, count(seconds) AS n_steps, round(avg(seconds), 3) AS avg_seconds,
  round(quantile_disc(seconds, 0.5), 3) AS median_seconds, round(max(seconds), 3) AS max_seconds FROM lagged GROUP BY source, status)"""


@query(f"WITH {TRACKING_SQL}, {TIMINGS_SQL} SELECT * FROM timings")
def stage_timings(spark, sf):
    return T.stage_timings(tracking(spark, sf))


BACKLOG_SQL = """lastof AS (SELECT id, arg_max(source, seq) AS source, arg_max(status, seq) AS status FROM tracking GROUP BY id),
backlog AS (SELECT substr(status, 9) AS queue, count(*) AS n_documents FROM lastof WHERE starts_with(status, 'Sent to ') GROUP BY 1)"""
FAILURES_SQL = r"""failures AS (SELECT regexp_extract(status, '^Failure in (\w+): (.*)$', 1) AS stage,
  regexp_extract(status, '^Failure in (\w+): (.*)$', 2) AS message, count(*) AS n_failures
  FROM tracking WHERE starts_with(status, 'Failure in ') GROUP BY 1, 2)"""


@query(f"WITH {TRACKING_SQL}, {BACKLOG_SQL} SELECT * FROM backlog")
def backlog(spark, sf):
    return T.backlog(tracking(spark, sf))


@query(f"WITH {TRACKING_SQL}, {FAILURES_SQL} SELECT * FROM failures")
def failures(spark, sf):
    return T.failures(tracking(spark, sf))


@query(f"""WITH {TRACKING_SQL}, {TIMINGS_SQL}, {BACKLOG_SQL}, {FAILURES_SQL}
  SELECT 'last status' AS section, source AS name, status AS detail, count(*) AS n, CAST(NULL AS DOUBLE) AS seconds FROM lastof GROUP BY source, status
  UNION ALL SELECT 'timing', source, status, n_steps, avg_seconds FROM timings
  UNION ALL SELECT 'backlog', queue, '', n_documents, NULL FROM backlog
  UNION ALL SELECT 'failure', stage, message, n_failures, NULL FROM failures""")
def tracking_report(spark, sf):
    return report(tracking(spark, sf))
