"""Catalogue, names, shards and messages."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import empty_strings, result_name as name_of
from corpusloom.operators import catalog as C
from corpusloom.operators import messages as M
from corpusloom.operators import sharding as S
from corpusloom.operators.tracking import fold_tracking
from corpusloom.plans.corpus import process_corpus as process
from corpusloom.plans.extraction import extract_and_name as name_and_store
from corpusloom.plans.ingest import ingest_plan as plan_ingest
from corpusloom.registry.base import (
    CATALOG_SQL, ENDPOINTS, FIELDS_SQL, MESSAGES_SQL, QUEUED_DATE, RUN_TIME,
    catalog, flat, messages, query, table, texts,
)

FLAT = "doc_id, file_name, container, processed, is_queued"
LATER = f"coalesce(try_strptime(is_queued, '%m/%d/%Y %H:%M:%S') > TIMESTAMP '{QUEUED_DATE}', false)"


@query(f"WITH {CATALOG_SQL} SELECT {FLAT} FROM catalog")
def list_documents(spark, sf):
    return flat(catalog(spark, sf))


@query(f"WITH {CATALOG_SQL} SELECT {FLAT} FROM catalog WHERE processed IS NULL")
def filter_processed(spark, sf):
    return flat(C.filter_processed(catalog(spark, sf)))


@query(f"WITH {CATALOG_SQL} SELECT {FLAT} FROM catalog WHERE NOT {LATER}")
def filter_queued_before(spark, sf):
    return flat(C.filter_queued_before(catalog(spark, sf), QUEUED_DATE))


@query(f"""WITH {CATALOG_SQL} SELECT doc_id, file_name, container, NULL::VARCHAR AS processed,
  strftime(queued_at, '%m/%d/%Y %H:%M:%S') AS is_queued FROM catalog""")
def set_metadata(spark, sf):
    return flat(C.mark_queued(catalog(spark, sf), F.col("queued_at")))


@query(f"""WITH {CATALOG_SQL},
  r AS (SELECT CASE WHEN processed IS NOT NULL THEN 'processed' WHEN {LATER} THEN 'queued_later' ELSE 'queued' END AS reason FROM catalog)
  SELECT reason, count(*) AS n_files FROM r GROUP BY reason""")
def queue_report(spark, sf):
    return C.queue_report(catalog(spark, sf), False, QUEUED_DATE)


@query(f"""WITH {CATALOG_SQL} SELECT file_name, doc_id FROM catalog
  WHERE file_name NOT IN (SELECT file_name FROM catalog WHERE processed IS NOT NULL)""")
def skip_existing(spark, sf):
    files = catalog(spark, sf)
    stored = files.filter(F.map_contains_key("metadata", C.PROCESSED_KEY))
    return C.skip_existing(files, stored).select("file_name", "doc_id")


@query(f"""WITH {CATALOG_SQL} SELECT printf('%06d', i) || '-' || file_name AS file_name, doc_id, i AS copy
  FROM catalog, (SELECT unnest(range(5, 8)) AS i)""")
def duplicate_corpus(spark, sf):
    return C.duplicate_corpus(catalog(spark, sf), 5, 3).select("file_name", "doc_id", "copy")


@query(f"""WITH {MESSAGES_SQL} SELECT c.file_name, c.doc_id,
  CASE WHEN len(m.custom_fields) > 0 THEN 'completed' ELSE c.container END AS container
  FROM catalog c JOIN msgs m ON m.source_file_name = c.file_name""")
def mark_completed(spark, sf):
    sent = messages(spark, sf).filter(M.has_fields(F.col("custom_fields")))
    return C.mark_completed(catalog(spark, sf), sent).select("file_name", "doc_id", "container")


@query(f"""WITH {MESSAGES_SQL} SELECT m.source_file_name,
  CASE WHEN c.processed IS NULL THEN 'Successfully moved original file' ELSE 'Failed to move original file' END AS status
  FROM msgs m JOIN catalog c ON m.source_file_name = c.file_name""")
def move_outcomes(spark, sf):
    swept = C.sweep_processed(catalog(spark, sf))
    return C.move_outcomes(messages(spark, sf), swept, "documents").select("source_file_name", "status")


@query(f"""WITH {CATALOG_SQL} SELECT file_name, doc_id,
  CASE WHEN processed IS NOT NULL THEN 'completed' ELSE container END AS container FROM catalog""")
def sweep_processed(spark, sf):
    return C.sweep_processed(catalog(spark, sf)).select("file_name", "doc_id", "container")


@query(f"""WITH {CATALOG_SQL} SELECT file_name,
  regexp_replace(regexp_extract(file_name, '[^/]*\\z'), '\\.[^.]*\\z', '') || '.md' AS result_name FROM catalog""")
def result_name(spark, sf):
    return catalog(spark, sf).select("file_name", name_of(F.col("file_name")).alias("result_name"))


@query(f"""WITH {CATALOG_SQL} SELECT file_name, CAST((row_number() OVER (ORDER BY file_name) - 1) % 10 AS INTEGER) AS shard
  FROM catalog WHERE processed IS NULL""")
def assign_shard(spark, sf):
    kept = C.filter_processed(catalog(spark, sf))
    return S.assign_shard(kept.select("file_name"))


@query(f"""WITH {CATALOG_SQL} SELECT doc_id, CAST(doc_id % 10 AS INTEGER) AS shard, 'https://e' || doc_id % 10 % 3 AS endpoint
  FROM catalog""")
def assign_endpoint(spark, sf):
    files = catalog(spark, sf).select("doc_id", (F.col("doc_id") % 10).cast("int").alias("shard"))
    return S.assign_endpoint(files, ENDPOINTS)


@query(f"""WITH {CATALOG_SQL},
  r AS (SELECT processed, CASE WHEN processed IS NOT NULL OR {LATER} THEN NULL ELSE file_name END AS file_name FROM catalog)
  SELECT sha1('documents' || chr(1) || file_name) AS id, file_name AS source_file_name, 'documents' AS container_name,
    CAST((row_number() OVER (ORDER BY file_name) - 1) % 10 AS INTEGER) AS recognizer_index,
    'https://e' || (row_number() OVER (ORDER BY file_name) - 1) % 10 % 3 AS endpoint
  FROM r WHERE file_name IS NOT NULL""")
def ingest_plan(spark, sf):
    return plan_ingest(catalog(spark, sf), ENDPOINTS, queued_date=QUEUED_DATE).select(
        "id", "source_file_name", "container_name", "recognizer_index", "endpoint",
    )


EXISTING_SQL = """existing AS (
  SELECT DISTINCT printf('file%06d', doc_id // 3) || '.md' AS result_name FROM documents WHERE doc_id // 3 % 4 = 0
  UNION ALL
  SELECT DISTINCT printf('file%06d', doc_id // 3) || '-2024-02-03-04-05.md' FROM documents WHERE doc_id // 3 % 8 = 0)"""
NAMES_SQL = f"""{CATALOG_SQL}, {EXISTING_SQL},
  stems AS (SELECT *, regexp_extract(file_name, '([^/]*)\\.[^.]*\\z', 1) AS stem FROM catalog),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY queued_at, file_name) AS claim,
    stem || '.md' NOT IN (SELECT result_name FROM existing) AS p_free,
    stem || '-2024-02-03-04-05.md' NOT IN (SELECT result_name FROM existing) AS d_free FROM stems),
  resolved AS (SELECT *, CASE WHEN claim = 1 AND p_free THEN 'primary'
      WHEN d_free AND ((claim = 1 AND NOT p_free) OR (claim = 2 AND p_free)) THEN 'timestamped' ELSE 'failed' END AS outcome FROM ranked),
  named AS (SELECT *, CASE outcome WHEN 'primary' THEN stem || '.md' WHEN 'timestamped' THEN stem || '-2024-02-03-04-05.md' END AS result_name FROM resolved)"""


def existing_results(spark, sf):
    n = F.expr("doc_id div 3")
    docs = table(spark, sf, "documents")
    plain = docs.filter(n % 4 == 0).select(F.format_string("file%06d.md", n).alias("result_name"))
    dated = docs.filter(n % 8 == 0).select(F.format_string("file%06d-2024-02-03-04-05.md", n).alias("result_name"))
    return plain.unionByName(dated)


@query(f"WITH {NAMES_SQL} SELECT file_name, outcome, result_name FROM named")
def resolve_names(spark, sf):
    run = F.lit(RUN_TIME).cast("timestamp")
    files = catalog(spark, sf).select("file_name", "queued_at")
    return S.resolve_names(files, existing_results(spark, sf), run).select("file_name", "outcome", "result_name")


@query(f"""WITH {NAMES_SQL} SELECT file_name, unnest(['documents', 'documents', 'incoming']) AS container, unnest([0, 1, 2]) AS delivery,
    outcome, result_name FROM named""")
def resolve_names_redelivered(spark, sf):
    """Every file delivered twice, and once more from a second container that arrives too late for a name of its own."""
    run = F.lit(RUN_TIME).cast("timestamp")
    files = catalog(spark, sf).select("file_name", "queued_at").withColumn("delivery", F.explode(F.sequence(F.lit(0), F.lit(2)))).withColumn(
        "container", F.when(F.col("delivery") == 2, "incoming").otherwise("documents"))
    named = S.resolve_names(files, existing_results(spark, sf), run, key=("file_name",))
    return named.select("file_name", "container", "delivery", "outcome", "result_name")


@query(f"""WITH {NAMES_SQL} SELECT n.file_name AS source_file_name, n.outcome, coalesce(n.result_name, '') AS processed_file_name,
    CASE WHEN n.outcome = 'failed' THEN 'documents' ELSE 'processresults' END AS container_name,
    md5(d.text) AS text_hash, CASE WHEN n.outcome = 'failed' THEN 'result name taken' END AS reject_reason
  FROM named n JOIN documents d USING (doc_id)""")
def extract_and_name(spark, sf):
    files = catalog(spark, sf)
    sent = files.select(
        F.col("file_name").alias("source_file_name"), F.col("container").alias("container_name"),
        F.lit("").alias("processed_file_name"), "queued_at",
    )
    bodies = files.select("doc_id", F.col("file_name").alias("source_file_name")).join(
        table(spark, sf, "documents").select("doc_id", "text"), "doc_id",
    )
    out = name_and_store(sent, bodies, existing_results(spark, sf), F.lit(RUN_TIME).cast("timestamp"))
    return out.select(
        "source_file_name", "outcome", "processed_file_name", "container_name",
        F.md5(F.col("text").cast("binary")).alias("text_hash"), "reject_reason",
    )


def _run(spark, sf):
    files = catalog(spark, sf)
    names = files.select("doc_id", F.col("file_name").alias("source_file_name"))
    docs = table(spark, sf, "documents").select("doc_id", "text")
    wanted = messages(spark, sf).select("source_file_name", "custom_fields")
    return process(
        files, names.join(docs, "doc_id"), existing_results(spark, sf), ENDPOINTS, F.lit(RUN_TIME).cast("timestamp"),
        wanted, max_tokens=512, dim=64,
    )


# Only unprocessed files are queued here, so they alone compete for names.
RUN_SQL = f"""{NAMES_SQL.replace("FROM catalog)", "FROM catalog WHERE processed IS NULL)")}, {FIELDS_SQL},
  outcome AS (SELECT n.*, len(f.custom_fields) > 0 AS wanted FROM named n LEFT JOIN fields f USING (doc_id))"""


@query(f"""WITH {RUN_SQL}
  SELECT sha1('documents' || chr(1) || file_name) AS id, CASE WHEN outcome = 'failed' THEN 4 ELSE 15 END AS n_events,
    CASE WHEN outcome = 'failed' THEN 'Failure in extraction: result name taken' ELSE 'Successfully moved original file' END AS last_status,
    coalesce(result_name, '') AS processed_file_name FROM outcome""")
def process_corpus(spark, sf):
    record = fold_tracking(_run(spark, sf).events)
    return record.select("id", "n_events", "last_status", "processed_file_name")


@query(f"""WITH {CATALOG_SQL.replace("catalog AS", "every AS")}, {RUN_SQL}
  SELECT e.file_name, CASE WHEN o.outcome <> 'failed' THEN 'completed' ELSE 'documents' END AS container,
    CASE WHEN e.processed IS NOT NULL OR o.outcome <> 'failed' THEN 'Processed=true'
      ELSE 'IsQueued={datetime.strptime(RUN_TIME, "%Y-%m-%d %H:%M:%S").strftime("%m/%d/%Y %H:%M:%S")}' END AS metadata
  FROM every e LEFT JOIN outcome o USING (file_name)""")
def catalog_after_run(spark, sf):
    return _run(spark, sf).catalog.select(
        "file_name", "container",
        F.array_join(F.transform(F.map_entries("metadata"), lambda x: F.concat_ws("=", x["key"], x["value"])), ",").alias("metadata"),
    )


@query(f"""WITH {MESSAGES_SQL} SELECT doc_id, CAST(to_json({{'id': id, 'source_file_name': source_file_name,
    'recognizer_index': recognizer_index, 'custom_fields': coalesce(custom_fields, CAST([] AS VARCHAR[]))}}) AS VARCHAR) AS value FROM msgs""")
def encode_messages(spark, sf):
    sent = messages(spark, sf).withColumn("custom_fields", F.coalesce("custom_fields", empty_strings()))
    columns = ["id", "source_file_name", "recognizer_index", "custom_fields"]
    return M.encode_messages(sent, columns).select("doc_id", "value")


@query("""WITH v AS (SELECT event_id, CASE WHEN event_id % 7 = 3 THEN replace(props, '}', '') ELSE props END AS value FROM events)
  SELECT event_id, CASE WHEN event_id % 7 <> 3 THEN CAST(json_extract_string(value, '$.k') AS INTEGER) END AS k,
    CASE WHEN event_id % 7 = 3 THEN 'unreadable message' END AS reject_reason FROM v""")
def decode_messages(spark, sf):
    sent = table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_id") % 7 == 3, F.replace("props", F.lit("}"), F.lit(""))).otherwise(F.col("props"))
        .alias("value"),
    )
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    return M.decode_messages(sent, schema).select("event_id", "k", "reject_reason")


@query(f"""WITH {MESSAGES_SQL} SELECT m.doc_id,
  CASE WHEN len(m.custom_fields) > 0 THEN 'Extracting Custom Field' ELSE 'No Custom Fields Specified. Abandoning extraction' END AS status,
  CASE WHEN len(m.custom_fields) > 0 THEN CASE WHEN d.lang = 'en' THEN d.source ELSE 'NOT FOUND' END ELSE '' END AS fields
  FROM msgs m JOIN documents d USING (doc_id)""")
def route_custom_fields(spark, sf):
    docs = table(spark, sf, "documents").select(
        "doc_id",
        F.when(F.col("lang") == "en", F.array("source")).otherwise(empty_strings()).alias("found"),
    )
    routed = M.route_custom_fields(messages(spark, sf).join(docs, "doc_id"), "found")
    return routed.select("doc_id", "status", F.array_join("custom_fields", "|").alias("fields"))


@query("""SELECT doc_id, 'no content' AS reject_reason FROM documents WHERE n_chars < 50 OR lang = 'es'""")
def reject_empty(spark, sf):
    docs = table(spark, sf, "documents").withColumn(
        "text", F.when(F.col("n_chars") < 50, "").when(F.col("lang") != "es", F.col("text")),
    )
    return M.reject_empty(docs)[1].select("doc_id", "reject_reason")


@query(f"""WITH {MESSAGES_SQL} SELECT m.doc_id, m.processed_file_name, md5(d.text) AS text_hash
  FROM msgs m LEFT JOIN documents d ON d.doc_id = m.doc_id AND d.lang <> 'de'""")
def attach_text(spark, sf):
    stored = table(spark, sf, "documents").filter("lang <> 'de'").select("doc_id")
    names = stored.select(F.format_string("doc%06d.md", "doc_id").alias("processed_file_name"))
    joined = M.attach_text(messages(spark, sf), texts(spark, sf).join(names, "processed_file_name", "left_semi"))
    return joined.select("doc_id", "processed_file_name", F.md5(F.col("text").cast("binary")).alias("text_hash"))


@query(f"""WITH {MESSAGES_SQL} SELECT id, source_file_name, 'processresults' AS container_name,
  CASE WHEN doc_id % 2 = 0 THEN 'even.md' ELSE processed_file_name END AS processed_file_name FROM msgs""")
def clone_with_overrides(spark, sf):
    sent = messages(spark, sf)
    cloned = M.clone_with_overrides(
        sent, container_name=F.lit("processresults"),
        processed_file_name=F.when(F.col("doc_id") % 2 == 0, "even.md"),
    )
    return cloned.select("id", "source_file_name", "container_name", "processed_file_name")
