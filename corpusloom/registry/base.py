"""Registered queries with their oracle SQL, and the inputs derived from the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import WS_CLASS
from corpusloom.operators.catalog import PROCESSED_KEY, QUEUED_KEY
from corpusloom.session import small_enough, spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

RUN_TIME = "2024-02-03 04:05:06"
QUEUED_DATE = "2024-01-01 08:00:00"
ENDPOINTS = ["https://e0", "https://e1", "https://e2"]


def query(sql: str | None = None, name: str | None = None):
    """Register a function as a query, with DuckDB SQL that gives the same rows."""

    def register(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    scan = spark.read.parquet(f"{sf}/{name}.parquet")
    # Tables whose rows carry long text or vectors.
    return spread(scan) if name in ("documents", "pages", "embeddings") else scan


def ws(pattern: str) -> str:
    """A pattern with WS replaced by the white-space class."""
    return pattern.replace("WS", WS_CLASS)


# --- catalog -----------------------------------------------------------------

CATALOG_SQL = """catalog AS (
  SELECT doc_id,
    source || '/file' || printf('%06d', doc_id // 3) || '.' || (['pdf','docx','png','jpg'])[doc_id % 4 + 1] AS file_name,
    'documents' AS container,
    CASE WHEN doc_id % 5 = 0 THEN 'true' END AS processed,
    CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 97 = 2 THEN 'not a date'
         WHEN doc_id % 3 = 1 THEN strftime(make_timestamp((1704067200 + doc_id * 60) * 1000000), '%m/%d/%Y %H:%M:%S') END AS is_queued,
    make_timestamp((1704067200 + doc_id % 7 * 60) * 1000000) AS queued_at
  FROM documents)"""


def catalog(spark: SparkSession, sf: str) -> DataFrame:
    """doc_id, file_name, container, metadata and arrival time of every document."""
    id_ = F.col("doc_id")
    stamp = F.date_format(F.timestamp_seconds(F.lit(1704067200) + id_ * 60), "MM/dd/yyyy HH:mm:ss")
    processed = F.when(id_ % 5 == 0, "true")
    queued = F.when(id_ % 5 == 0, None).when(id_ % 97 == 2, "not a date").when(id_ % 3 == 1, stamp)
    extension = F.element_at(F.array(*map(F.lit, ("pdf", "docx", "png", "jpg"))), (id_ % 4).cast("int") + 1)
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return spark.read.parquet(f"{sf}/documents.parquet").select(
        id_,
        F.concat("source", F.lit("/file"), F.format_string("%06d", F.expr("doc_id div 3")), F.lit("."), extension)
        .alias("file_name"),
        F.lit("documents").alias("container"),
        F.when(processed.isNotNull(), F.create_map(F.lit(PROCESSED_KEY), processed))
        .when(queued.isNotNull(), F.create_map(F.lit(QUEUED_KEY), queued))
        .otherwise(none).alias("metadata"),
        F.timestamp_seconds(F.lit(1704067200) + id_ % 7 * 60).alias("queued_at"),
    )


def flat(df: DataFrame) -> DataFrame:
    """Catalogue rows with the metadata map as two columns."""
    return df.select(
        "doc_id", "file_name", "container",
        F.try_element_at("metadata", F.lit(PROCESSED_KEY)).alias("processed"),
        F.try_element_at("metadata", F.lit(QUEUED_KEY)).alias("is_queued"),
    )


# --- messages ----------------------------------------------------------------

FIELDS_SQL = """fields AS (
  SELECT doc_id, CASE WHEN quality = 1 THEN ['requested'] ELSE CAST([] AS VARCHAR[]) END AS custom_fields FROM labels),
msgs AS (
  SELECT c.doc_id, sha1('documents' || chr(1) || c.file_name) AS id, c.file_name AS source_file_name,
    printf('doc%06d', c.doc_id) || '.md' AS processed_file_name, 'documents' AS container_name,
    CAST(c.doc_id % 10 AS INTEGER) AS recognizer_index, f.custom_fields
  FROM catalog c LEFT JOIN fields f USING (doc_id))"""
MESSAGES_SQL = CATALOG_SQL + ",\n" + FIELDS_SQL


def messages(spark: SparkSession, sf: str) -> DataFrame:
    """A message per document; fields are asked for where a label says quality 1."""
    fields = table(spark, sf, "labels").select(
        "doc_id",
        F.when(F.col("quality") == 1, F.array(F.lit("requested")))
        .otherwise(F.array().cast("array<string>")).alias("custom_fields"),
    )
    return catalog(spark, sf).join(fields, "doc_id", "left").select(
        "doc_id",
        F.sha1(F.concat_ws("\u0001", "container", "file_name").cast("binary")).alias("id"),
        F.col("file_name").alias("source_file_name"),
        F.format_string("doc%06d.md", "doc_id").alias("processed_file_name"),
        F.col("container").alias("container_name"),
        (F.col("doc_id") % 10).cast("int").alias("recognizer_index"),
        "custom_fields",
    )


def texts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        F.format_string("doc%06d.md", "doc_id").alias("processed_file_name"), "text",
    )


def messages_with_text(spark: SparkSession, sf: str) -> DataFrame:
    # Every document has a message; the messages go to the texts while there are few of them.
    return texts(spark, sf).join(small_enough(messages(spark, sf)), "processed_file_name")


# --- tracking ----------------------------------------------------------------

TRACKING_SQL = """keyed AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS n FROM events),
tracking AS (
  SELECT user_id AS id, event_id AS seq, event_type AS source,
    CASE WHEN event_type = 'error' THEN 'Failure in stage' || n % 6 || ': code ' || n
         WHEN n % 2 = 0 THEN 'Processing' ELSE 'Sent to queue' || n % 4 END AS status,
    ts AS event_time,
    'file' || user_id || '-' || n || '.pdf' AS source_file_name, n % 10 AS recognizer_index,
    CASE WHEN n % 3 = 0 THEN '' ELSE 'r' || n || '.md' END AS processed_file_name,
    event_type AS container_name,
    CASE WHEN n % 4 = 0 THEN CAST([] AS VARCHAR[]) ELSE ['f' || n, 'g' || n % 5] END AS custom_fields
  FROM keyed)"""


def tracking_of(events: DataFrame) -> DataFrame:
    n = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    s = n.cast("string")
    status = (
        F.when(kind == "error", F.concat(F.lit("Failure in stage"), (n % 6).cast("string"), F.lit(": code "), s))
        .when(n % 2 == 0, "Processing")
        .otherwise(F.concat(F.lit("Sent to queue"), (n % 4).cast("string")))
    )
    return events.select(
        F.col("user_id").alias("id"), F.col("event_id").alias("seq"), kind.alias("source"), status.alias("status"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.concat(F.lit("file"), F.col("user_id").cast("string"), F.lit("-"), s, F.lit(".pdf")).alias("source_file_name"),
        (n % 10).alias("recognizer_index"),
        F.when(n % 3 == 0, "").otherwise(F.concat(F.lit("r"), s, F.lit(".md"))).alias("processed_file_name"),
        kind.alias("container_name"),
        F.when(n % 4 == 0, F.array().cast("array<string>"))
        .otherwise(F.array(F.concat(F.lit("f"), s), F.concat(F.lit("g"), (n % 5).cast("string")))).alias("custom_fields"),
    )


def tracking(spark: SparkSession, sf: str) -> DataFrame:
    return tracking_of(table(spark, sf, "events"))


# --- questions ---------------------------------------------------------------

QUESTIONS_SQL = """questions AS (
  SELECT item_id AS question_id, text AS question,
    CASE WHEN item_id % 2 = 1 THEN printf('doc%06d', item_id * 5) || '.pdf' END AS file_name,
    CASE WHEN item_id % 4 = 2 THEN 'src' || item_id % 20 END AS custom_field
  FROM benchmark)"""


def questions(spark: SparkSession, sf: str) -> DataFrame:
    """A question per benchmark text; some name a file, some a field value."""
    n = F.col("item_id")
    return table(spark, sf, "benchmark").select(
        n.alias("question_id"), F.col("text").alias("question"),
        F.when(n % 2 == 1, F.concat(F.format_string("doc%06d", n * 5), F.lit(".pdf"))).alias("file_name"),
        F.when(n % 4 == 2, F.concat(F.lit("src"), (n % 20).cast("string"))).alias("custom_field"),
    )


INDEX_SQL = """idx AS (
  SELECT sha1(printf('doc%06d', doc_id) || '.md' || chr(1) || '0') AS id, text,
    printf('doc%06d', doc_id) || '.md' AS file_name, [source, lang] AS custom_field FROM documents)"""


def index(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents as index rows, with source and language as custom fields."""
    name = F.format_string("doc%06d.md", "doc_id")
    return table(spark, sf, "documents").select(
        F.sha1(F.concat_ws("\u0001", name, F.lit("0")).cast("binary")).alias("id"), "text",
        name.alias("file_name"), F.array("source", "lang").alias("custom_field"),
    )


# --- chunks ------------------------------------------------------------------

def runs_sql(items: str, cost: str, limit: int) -> str:
    """A fold that gives every item the number of its greedy run."""
    return f"""list_reduce(list_prepend(
      {{'run': 0, 'tot': 0, 'ids': CAST([] AS INTEGER[])}},
      list_transform({items}, lambda x: {{'run': 0, 'tot': CAST({cost} AS INTEGER), 'ids': CAST([] AS INTEGER[])}})),
      lambda a, x: CASE WHEN a.tot > 0 AND a.tot + x.tot > {limit}
        THEN {{'run': a.run + 1, 'tot': x.tot, 'ids': list_append(a.ids, a.run + 1)}}
        ELSE {{'run': a.run, 'tot': a.tot + x.tot, 'ids': list_append(a.ids, a.run)}} END).ids"""


def trim_sql(expr: str) -> str:
    return ws(f"regexp_replace({expr}, '^[WS]+|[WS]+\\z', '', 'g')")


def chunks_sql(limit: int, source: str) -> str:
    """CTEs ending in chunks(k, chunk_pos, chunk_text) for a source of (k, text)."""
    size = limit * 4
    return ws(f"""src AS ({source}),
lines AS (SELECT k, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^WS]')) AS ls FROM src),
line_runs AS (SELECT k, ls, {runs_sql('ls', '(length(x) + 3) // 4', limit)} AS ids FROM lines WHERE len(ls) > 0),
line_rows AS (SELECT k, unnest(ls) AS line, unnest(ids) AS run, generate_subscripts(ls, 1) AS i FROM line_runs),
packed AS (
  SELECT k, run, string_agg(line, chr(10) ORDER BY i) AS body,
    bool_or((length(line) + 3) // 4 > {limit}) AS too_long FROM line_rows GROUP BY k, run),
long_words AS (SELECT k, run, list_filter(string_split(body, ' '), lambda x: x <> '') AS wl FROM packed WHERE too_long),
word_runs AS (SELECT k, run, wl, {runs_sql('wl', 'length(x) + 1', size)} AS ids FROM long_words),
word_rows AS (SELECT k, run, unnest(wl) AS w, unnest(ids) AS piece, generate_subscripts(wl, 1) AS i FROM word_runs),
pieces AS (
  SELECT k, run, piece, CASE WHEN max(length(w)) > {size}
      THEN list_transform(range(0, max(length(w)), {size}), lambda p: substr(any_value(w), CAST(p AS BIGINT) + 1, {size}))
      ELSE [string_agg(w, ' ' ORDER BY i)] END AS parts
  FROM word_rows GROUP BY k, run, piece),
bodies AS (
  SELECT k, run, 0 AS piece, 0 AS cut, body FROM packed WHERE NOT too_long
  UNION ALL
  SELECT k, run, piece, unnest(range(0, len(parts))) AS cut, unnest(parts) AS body FROM pieces),
chunks AS (
  SELECT k, CAST(row_number() OVER (PARTITION BY k ORDER BY run, piece, cut) - 1 AS INTEGER) AS chunk_pos,
    {trim_sql('body')} AS chunk_text FROM bodies)""")
