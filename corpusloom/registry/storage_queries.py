"""Stored tables, queues and streams, each written to the scratch folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.operators.messages import decode_messages
from corpusloom.operators.sharding import assign_endpoint
from corpusloom.operators.tracking import fold_tracking, state_record
from corpusloom.registry.base import (
    CATALOG_SQL, ENDPOINTS, INDEX_SQL, QUEUED_DATE, RUN_TIME, MESSAGES_SQL, TRACKING_SQL,
    QUESTIONS_SQL, catalog, index, messages, messages_with_text, query, questions, table, texts, tracking, tracking_of,
)
from corpusloom.plans.extraction import extract_and_store as store_texts
from corpusloom.plans.indexing import index_and_store
from corpusloom.plans.ingest import ingest
from corpusloom.registry.catalog_queries import LATER
from corpusloom.registry.search_queries import CHUNK_INDEX_SQL, HITS_SQL
from corpusloom.registry.text_queries import PAGE_TEXT_SQL
from corpusloom.registry.tracking_queries import FOLD_SQL, RECORD, record
from corpusloom.schemas import MESSAGE
from corpusloom.session import materialize, scratch_path
from corpusloom.sources import documents as D
from corpusloom.sources import index_log as G
from corpusloom.sources import index_table as X
from corpusloom.sources import queues as Q
from corpusloom.sources import term_table as W
from corpusloom.sources import tracking_log as L
from corpusloom.streaming import keyed as K
from corpusloom.streaming import redelivery as R
from corpusloom.streaming import stages as S


@query("SELECT printf('doc%06d', doc_id) || '.md' AS processed_name, text FROM documents")
def read_texts(spark, sf):
    path = scratch_path(spark, "texts")
    texts(spark, sf).withColumnRenamed("processed_file_name", "processed_name").write.parquet(path)
    return D.read_texts(spark, path, "parquet")


@query("""SELECT printf('doc%06d', doc_id) || '.md' AS processed_name, CASE WHEN lang = 'fr' THEN 'first' ELSE 'second' END AS writer,
  md5(text) AS text_hash FROM documents""")
def write_texts(spark, sf):
    path = scratch_path(spark, "texts")
    docs = table(spark, sf, "documents").select(
        F.format_string("doc%06d.md", "doc_id").alias("processed_name"), "text", "lang",
    )
    D.write_texts(docs.filter("lang = 'fr'").drop("lang").withColumn("writer", F.lit("first")), path)
    # The second write offers every name; the ones stored already are kept as they are.
    D.write_texts(docs.drop("lang").withColumn("writer", F.lit("second")), path)
    return spark.read.parquet(path).select(
        "processed_name", "writer", F.md5(F.col("text").cast("binary")).alias("text_hash"),
    )


@query(f"""WITH {MESSAGES_SQL} SELECT id, source_file_name, processed_file_name, container_name, recognizer_index,
  coalesce(array_to_string(custom_fields, '|'), '') AS fields FROM msgs""")
def queue_messages(spark, sf):
    waiting, done = scratch_path(spark, "queue"), scratch_path(spark, "queue")
    sent = messages(spark, sf).drop("doc_id")
    Q.send(sent, waiting)
    received = decode_messages(Q.queue_source(spark, waiting), MESSAGE).select(*MESSAGE.fieldNames())
    Q.queue_sink(received, done, scratch_path(spark, "checkpoint")).awaitTermination()
    out = decode_messages(spark.read.text(done), MESSAGE)
    return out.select(
        "id", "source_file_name", "processed_file_name", "container_name", "recognizer_index",
        F.coalesce(F.array_join("custom_fields", "|"), F.lit("")).alias("fields"),
    )


@query(f"WITH {TRACKING_SQL}, {FOLD_SQL} SELECT {RECORD} FROM folded")
def upsert_tracking(spark, sf):
    path = scratch_path(spark, "tracking")
    events = tracking(spark, sf)
    for n in (0, 1):
        L.upsert_tracking(events.filter(F.col("seq") % 2 == n), path, "load", n)
    # The same batch again, and every event redelivered by another stage.
    L.upsert_tracking(events.filter(F.col("seq") % 2 == 1), path, "load", 1)
    L.upsert_tracking(events, path, "replay", 0)
    return record(fold_tracking(L.read_tracking(spark, path)))


@query(f"""WITH {INDEX_SQL} SELECT id, file_name, CASE WHEN list_contains(custom_field, 'de') THEN 'new' ELSE 'old' END AS version,
  md5(text) AS text_hash FROM idx""")
def write_index(spark, sf):
    path = scratch_path(spark, "index")
    rows = index(spark, sf)
    X.write_index(rows.withColumn("description", F.lit("old")), path, 8, 1)
    again = rows.filter(F.array_contains("custom_field", "de")).withColumn("description", F.lit("new"))
    for _ in range(2):
        X.write_index(again, path, 8, 1)
    return X.read_index(spark, path).select(
        "id", "file_name", F.col("description").alias("version"), F.md5(F.col("text").cast("binary")).alias("text_hash"),
    )


@query(f"""WITH {INDEX_SQL} SELECT id, file_name, CASE WHEN list_contains(custom_field, 'de') THEN 'new' ELSE 'old' END AS upload,
  md5(text) AS text_hash FROM idx WHERE NOT list_contains(custom_field, 'es')""")
def append_index(spark, sf):
    path = scratch_path(spark, "index")
    rows = index(spark, sf)
    first = G.append_index(rows.withColumn("description", F.lit("old")), path)
    again = rows.filter(F.array_contains("custom_field", "de")).withColumn("description", F.lit("new"))
    second = G.append_index(again, path)
    G.append_index(again, path, second)  # the same upload once more
    G.compact_index(spark, path)
    # Files without rows any more.
    G.append_index(rows.limit(0).withColumn("description", F.lit("")), path, files=rows.filter(F.array_contains("custom_field", "es")))
    return G.read_current(spark, path).select(
        "id", "file_name", F.col("description").alias("upload"), F.md5(F.col("text").cast("binary")).alias("text_hash"),
    )


def _term_table(spark, sf):
    """The words of the index in two uploads, of which the second replaces files of the first."""
    path = scratch_path(spark, "terms")
    rows = index(spark, sf)
    old = F.array_contains("custom_field", "de")
    W.append_terms(rows.withColumn("text", F.when(old, "an older text").otherwise(F.col("text"))), path)
    W.append_terms(rows.filter(old), path)
    return path


@query(f"WITH {INDEX_SQL}, {QUESTIONS_SQL}, {HITS_SQL} SELECT question_id, id, score, rank, total_count FROM ranked")
def search_terms(spark, sf):
    return W.search_terms(spark, _term_table(spark, sf), questions(spark, sf))


@query(f"WITH {INDEX_SQL}, {QUESTIONS_SQL}, {HITS_SQL} SELECT question_id, id, score, rank, total_count FROM ranked WHERE rank <= 10")
def search_terms_top10(spark, sf):
    return W.search_terms(spark, _term_table(spark, sf), questions(spark, sf), 10)


@query(f"WITH {INDEX_SQL}, {QUESTIONS_SQL}, {HITS_SQL} SELECT question_id, id, score, rank FROM ranked WHERE rank <= 10")
def search_terms_best10(spark, sf):
    return W.search_terms(spark, _term_table(spark, sf), questions(spark, sf), 10, counts=False)


@query("""SELECT '"documents_index"' AS name, count(*) AS n_rows, count(DISTINCT lang) AS n_languages FROM documents""")
def ensure_index(spark, sf):
    name, path = "documents_index", scratch_path(spark, "index")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    X.ensure_index(spark, name, path)
    # Creating it again leaves it as it is.
    X.ensure_index(spark, name)
    index(spark, sf).select("id", "text", "file_name", "custom_field").write.mode("append").parquet(path)
    spark.catalog.refreshTable(name)
    language = F.element_at("custom_field", -1)
    counted = spark.table(name).agg(
        F.count("*").alias("n_rows"), F.count_distinct(language).alias("n_languages"),
    )
    listed = X.list_indexes(spark).filter(F.col("name") == f'"{name}"')
    return listed.select(
        "name", counted.select("n_rows").scalar().alias("n_rows"),
        counted.select("n_languages").scalar().alias("n_languages"),
    )


def _event_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    return tracking_of(spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf))


@query(f"WITH {TRACKING_SQL}, {FOLD_SQL} SELECT {RECORD} FROM folded")
def tracking_stream(spark, sf):
    path = scratch_path(spark, "tracking")
    S.tracking_stream(_event_stream(spark, sf), path, "events", scratch_path(spark, "checkpoint")).awaitTermination()
    return record(fold_tracking(L.read_tracking(spark, path)))


@query(f"WITH {TRACKING_SQL}, {FOLD_SQL} SELECT {RECORD} FROM folded")
def tracking_state_stream(spark, sf):
    path = scratch_path(spark, "state")
    stream = S.tracking_state_stream(_event_stream(spark, sf), S.batch_folder(path), scratch_path(spark, "checkpoint"))
    stream.awaitTermination()
    states = spark.read.parquet(path).drop("batch_id")
    # Later batches carry the larger counts of an id.
    newest = states.groupBy("id").agg(F.max_by(F.struct(*states.columns), "n_events").alias("s")).select("s.*")
    return record(state_record(newest))


@query(f"WITH {TRACKING_SQL}, {FOLD_SQL} SELECT {RECORD} FROM folded")
def tracking_records_stream(spark, sf):
    path, waiting = scratch_path(spark, "records"), scratch_path(spark, "waiting")
    events = tracking(spark, sf)
    checkpoint = scratch_path(spark, "checkpoint")
    # First every second event, then all, so that half are delivered twice; some documents are forgotten in between.
    for name, some in (("first", events.filter("seq % 2 = 0")), ("all", events)):
        some.write.parquet(f"{waiting}/{name}")
        stream = spark.readStream.schema(events.schema).option("recursiveFileLookup", "true").parquet(waiting)
        K.tracking_records_stream(stream, S.batch_folder(path), checkpoint, "Sent to queue2", 0.001).awaitTermination()
    return record(K.merge_records(spark.read.parquet(path)))


@query(f"""WITH {CATALOG_SQL} SELECT file_name AS source_file_name, 'https://e' || doc_id % 10 % 3 AS endpoint
  FROM catalog WHERE processed IS NULL""")
def ingest_stream(spark, sf):
    waiting, done = scratch_path(spark, "queue"), scratch_path(spark, "stage")
    files = catalog(spark, sf).filter(~F.map_contains_key("metadata", "Processed"))
    sent = files.select(
        F.sha1(F.col("file_name").cast("binary")).alias("id"), F.col("file_name").alias("source_file_name"),
        (F.col("doc_id") % 10).cast("int").alias("recognizer_index"),
    )
    # At-least-once delivery: everything arrives twice.
    Q.send(sent, waiting)
    Q.send(sent, waiting)

    def stage(batch):
        decoded = S.dedupe_messages(decode_messages(batch, MESSAGE))
        return assign_endpoint(decoded, ENDPOINTS, "recognizer_index")

    S.stage_stream(Q.queue_source(spark, waiting), stage, S.batch_folder(done),
                   scratch_path(spark, "checkpoint")).awaitTermination()
    return S.dedupe_messages(spark.read.parquet(done)).select("source_file_name", "endpoint")


@query("""SELECT user_id AS id, 'unreadable message' AS reject_reason, count(*) AS attempts, count(*) >= 3 AS dead
  FROM events WHERE event_id % 7 = 3 GROUP BY user_id""")
def dead_letter(spark, sf):
    done, bad = scratch_path(spark, "stage"), scratch_path(spark, "rejects")
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    events = spark.readStream.schema(table(spark, sf, "events").schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    broken = F.when(F.col("event_id") % 7 == 3, F.replace("props", F.lit("}"), F.lit(""))).otherwise(F.col("props"))

    def stage(batch):
        return decode_messages(batch.select(F.col("user_id").alias("id"), broken.alias("value")), schema)

    S.stage_stream(events, stage, S.batch_folder(done), scratch_path(spark, "checkpoint"),
                   S.batch_folder(bad)).awaitTermination()
    return S.dead_letter(spark.read.parquet(bad), max_attempts=3)


@query("""SELECT doc_id, least(doc_id % 4 + 1, 3) AS attempts, doc_id % 4 < 3 AS done FROM documents""")
def redelivery(spark, sf):
    waiting, done, dead = (scratch_path(spark, x) for x in ("queue", "stage", "dead"))
    schema = T.StructType([T.StructField("doc_id", T.LongType())])
    Q.send(table(spark, sf, "documents").select("doc_id"), waiting)

    def stage(batch):
        read = decode_messages(batch, schema)
        return read.withColumn("reject_reason", F.when(F.col("attempt") <= F.col("doc_id") % 4, "not yet"))

    R.drain(spark, waiting, stage, S.batch_folder(done), scratch_path(spark, "checkpoint"), dead, 3)
    passed = spark.read.parquet(done).select("doc_id", F.col("attempt").alias("attempts"), F.lit(True).alias("done"))
    given_up = decode_messages(spark.read.parquet(dead), schema).select("doc_id", F.col("attempt").alias("attempts"), F.lit(False).alias("done"))
    return passed.unionByName(given_up)


FILES_SQL = """SELECT 'name=my doc ' || doc_id || '+x/' AS folder, md5(text || chr(10)) AS text_hash FROM documents"""


def _files(spark, sf):
    """Every document as a text file in a folder with blanks and a plus sign in its name."""
    docs = table(spark, sf, "documents").select(F.concat(F.lit("my doc "), F.col("doc_id"), F.lit("+x")).alias("name"), "text")
    path = scratch_path(spark, "files")
    D.write_files(docs, path)
    return path


@query(f"""SELECT folder, true AS is_file FROM ({FILES_SQL})""")
def list_files(spark, sf):
    listed = D.list_documents(spark, _files(spark, sf), glob="*.txt")
    return listed.select(F.regexp_extract("file_name", "^.*/", 0).alias("folder"), (F.col("length") > 0).alias("is_file"))


@query(FILES_SQL)
def read_text_files(spark, sf):
    read = D.read_texts(spark, _files(spark, sf), glob="*.txt")
    return read.select(F.regexp_extract("processed_name", "^.*/", 0).alias("folder"), F.md5(F.col("text").cast("binary")).alias("text_hash"))


@query(f"""WITH {CATALOG_SQL},
  r AS (SELECT CASE WHEN processed IS NOT NULL THEN 'processed' WHEN {LATER} THEN 'queued_later' ELSE 'queued' END AS reason FROM catalog)
  SELECT reason, count(*) AS n_files, CASE WHEN reason = 'queued' THEN count(*) ELSE 0 END AS n_messages FROM r GROUP BY reason""")
def ingest_with_report(spark, sf):
    """Every file that the report counts as queued has its message in the queue."""
    run = ingest(catalog(spark, sf), ENDPOINTS, queued_date=QUEUED_DATE)
    waiting = scratch_path(spark, "queue")
    Q.send(run.messages, waiting)
    sent = decode_messages(spark.read.text(waiting), MESSAGE).agg(F.count("source_file_name").alias("_n"))
    return run.report.select(
        "reason", "n_files", F.when(F.col("reason") == "queued", sent.scalar()).otherwise(0).alias("n_messages"),
    )


@query(f"""WITH t AS (SELECT 'page' || page_id AS stem, {PAGE_TEXT_SQL} AS text FROM pages)
  SELECT stem || '.html' AS source_file_name, CASE WHEN text <> '' THEN stem || '.md' END AS stored_name, CASE WHEN text <> '' THEN md5(text) END AS text_hash,
    CASE WHEN text = '' THEN 'no text extracted' END AS reject_reason FROM t""")
def extract_and_store(spark, sf):
    store = scratch_path(spark, "texts")
    name = F.concat(F.lit("page"), F.col("page_id").cast("string"), F.lit(".html"))
    pages = table(spark, sf, "pages").select(name.alias("source_file_name"), "html")
    sent = pages.select(
        "source_file_name", F.lit("documents").alias("container_name"), F.lit("").alias("processed_file_name"), F.lit(0).alias("queued_at"),
    )
    out = store_texts(sent, pages, store, F.lit(RUN_TIME).cast("timestamp"))
    stored = D.read_texts(spark, store, "parquet").select(F.col("processed_name").alias("stored_name"), F.md5(F.col("text").cast("binary")).alias("text_hash"))
    rows = out.select("source_file_name", "reject_reason", F.when(F.col("reject_reason").isNull(), F.col("processed_file_name")).alias("stored_name"))
    return rows.join(stored, "stored_name", "left")


@query(f"""WITH {CHUNK_INDEX_SQL}, {QUESTIONS_SQL.replace("'src' || item_id % 20", "'requested'")}, {HITS_SQL}
  SELECT question_id, id, score, rank, text_hash FROM ranked JOIN (SELECT id, md5(text) AS text_hash FROM idx) USING (id) WHERE rank <= 10""")
def stored_index(spark, sf):
    """Index rows and words stored in two uploads, the second over the first, then searched and read back."""
    path = scratch_path(spark, "stored")
    sent = messages_with_text(spark, sf)
    again = F.pmod(F.xxhash64("processed_file_name"), F.lit(3)) == 0
    index_and_store(sent.withColumn("text", F.when(again, F.lit("an older text")).otherwise(F.col("text"))), path, max_tokens=512, dim=64)
    index_and_store(sent.filter(again), path, max_tokens=512, dim=64)
    asked = questions(spark, sf).withColumn("custom_field", F.when(F.col("custom_field").isNotNull(), "requested"))
    hits = materialize(W.search_terms(spark, f"{path}/terms", asked, 10, counts=False), "hits")
    bodies = G.read_current(spark, f"{path}/index", hits).select("id", F.md5(F.col("text").cast("binary")).alias("text_hash"))
    return hits.join(bodies, "id")
