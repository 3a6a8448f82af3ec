"""Lines, chunks, identifiers, prompts and pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from corpusloom.functions.sql import register_functions
from corpusloom.operators import chunks as K
from corpusloom.operators import identifiers as I
from corpusloom.operators import prompts as P
from corpusloom.operators.extract import PAGE_RULES
from corpusloom.operators.extract import extract_text as page_to_text
from corpusloom.operators.ordering import collect_parts
from corpusloom.plans.fields import identifiers as field_plan
from corpusloom.registry.base import (
    MESSAGES_SQL, QUESTIONS_SQL, chunks_sql, messages_with_text, query, questions, runs_sql, table, trim_sql, ws,
)

DOCS = "SELECT doc_id AS k, text FROM documents"


@query(ws("""WITH l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^WS]')) AS ls FROM documents)
  SELECT doc_id, CAST(generate_subscripts(ls, 1) - 1 AS INTEGER) AS line_pos, unnest(ls) AS line FROM l"""))
def split_lines(spark, sf):
    return K.split_lines(table(spark, sf, "documents"), keep=("doc_id",))


def _chunk_query(limit: int):
    sql = f"""WITH {chunks_sql(limit, DOCS)}
      SELECT k AS doc_id, chunk_pos, chunk_text, CAST((length(chunk_text) + 3) // 4 AS INTEGER) AS n_tokens FROM chunks"""

    @query(sql, name=f"chunk_text_{limit}")
    def run(spark, sf):
        return K.chunk_text(table(spark, sf, "documents"), limit, keep=("doc_id",))

    return run


for _limit in (8191, 64, 8):
    _chunk_query(_limit)


@query(f"""WITH {chunks_sql(64, DOCS)} SELECT k AS doc_id, chunk_pos, chunk_text FROM chunks""")
def chunk_text_in_sql(spark, sf):
    register_functions(spark)
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return spark.sql("SELECT doc_id, c.chunk_pos, c.chunk_text FROM {docs}, LATERAL chunk_text(text, 64) AS c", docs=docs)


@query(ws(f"""WITH l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^WS]')) AS ls FROM documents),
  r AS (SELECT doc_id, generate_subscripts(ls, 1) - 1 AS line_pos, unnest(ls) AS line FROM l),
  w AS (SELECT doc_id, line_pos, list_filter(string_split(line, ' '), lambda x: x <> '') AS wl FROM r WHERE (length(line) + 3) // 4 > 8),
  f AS (SELECT doc_id, line_pos, wl, {runs_sql('wl', 'length(x) + 1', 32)} AS ids FROM w),
  u AS (SELECT doc_id, line_pos, unnest(wl) AS word, unnest(ids) AS run, generate_subscripts(wl, 1) AS i FROM f),
  g AS (SELECT doc_id, line_pos, run, CASE WHEN max(length(word)) > 32
      THEN list_transform(range(0, max(length(word)), 32), lambda p: substr(any_value(word), CAST(p AS BIGINT) + 1, 32))
      ELSE [string_agg(word, ' ' ORDER BY i)] END AS parts FROM u GROUP BY doc_id, line_pos, run),
  e AS (SELECT doc_id, line_pos, run, generate_subscripts(parts, 1) AS cut, {trim_sql('unnest(parts)')} AS piece FROM g
    UNION ALL SELECT doc_id, line_pos, 0, 0, line FROM r WHERE (length(line) + 3) // 4 <= 8)
  SELECT doc_id, CAST(line_pos AS INTEGER) AS line_pos,
    CAST(row_number() OVER (PARTITION BY doc_id, line_pos ORDER BY run, cut) - 1 AS INTEGER) AS piece_pos,
    piece, CAST(length(piece) AS INTEGER) AS n_chars FROM e"""))
def split_long_line_8(spark, sf):
    lines = K.split_lines(table(spark, sf, "documents"), keep=("doc_id",))
    return K.split_long_line(lines, 32, keep=("doc_id", "line_pos"))


@query(f"""WITH {chunks_sql(64, DOCS)}
  SELECT k AS doc_id, 0 AS part, string_agg(chunk_text, chr(10) ORDER BY chunk_pos) AS text FROM chunks GROUP BY k""")
def rejoin_chunks(spark, sf):
    return K.rejoin_chunks(K.chunk_text(table(spark, sf, "documents"), 64, keep=("doc_id",)), ("doc_id",))


def _sql_text(pattern: str) -> str:
    return pattern.replace("'", "''")


BARE = _sql_text(I.token_pattern())
LABELLED = _sql_text(I.label_pattern())
IDS_SQL = f"""kept AS (
  SELECT k, chunk_pos, list_filter(string_split(chunk_text, chr(10)),
    lambda x: NOT (regexp_matches(x, '\\|.*\\|') OR regexp_matches(x, '\\t.*\\t') OR regexp_matches(x, '^\\s*(?:[-*+]|\\d+[.)])\\s'))) AS ls FROM chunks),
found AS (
  SELECT k, chunk_pos, flatten(list_transform(ls, lambda x: list_concat(
    list_filter(regexp_extract_all(x, '{LABELLED}', 1), lambda t: regexp_matches(t, '[0-9]')),
    list_filter(regexp_extract_all(x, '{BARE}'), lambda t: regexp_matches(t, '[0-9]') AND regexp_matches(t, '[A-Za-z]'))))) AS ids FROM kept),
numbered AS (SELECT k, chunk_pos, unnest(ids) AS field, generate_subscripts(ids, 1) AS i FROM found),
firsts AS (SELECT k, chunk_pos, field, min(i) AS i FROM numbered GROUP BY k, chunk_pos, field)"""
# Every third document gets a labelled line, a list item and a table row of its own.
LABELLED_DOCS = """SELECT doc_id AS k, CASE WHEN doc_id % 3 = 0 THEN text || chr(10) || 'Bill of Lading: AB' || printf('%08d', doc_id)
    || ' and BOL# ' || printf('%09d', doc_id) || chr(10) || '- item X1Y2Z3A4' || chr(10) || '| Q1W2E3R4 | 5 |' ELSE text END AS text FROM documents"""


def labelled_documents(spark, sf):
    n = F.col("doc_id")
    extra = F.concat(
        F.lit("\nBill of Lading: AB"), F.format_string("%08d", n), F.lit(" and BOL# "), F.format_string("%09d", n),
        F.lit("\n- item X1Y2Z3A4\n| Q1W2E3R4 | 5 |"),
    )
    docs = table(spark, sf, "documents")
    return docs.withColumn("text", F.when(n % 3 == 0, F.concat("text", extra)).otherwise(F.col("text")))


def _chunk_fields(spark, sf):
    chunks = K.chunk_text(labelled_documents(spark, sf), 64, keep=("doc_id",))
    return I.extract_identifiers(chunks, keep=("doc_id", "chunk_pos"))


@query(f"""WITH {chunks_sql(64, LABELLED_DOCS)}, {IDS_SQL}
  SELECT k AS doc_id, chunk_pos, CAST(row_number() OVER (PARTITION BY k, chunk_pos ORDER BY i) - 1 AS INTEGER) AS field_pos, field FROM firsts""")
def extract_identifiers(spark, sf):
    return _chunk_fields(spark, sf)


@query(f"""WITH {chunks_sql(64, LABELLED_DOCS)}, {IDS_SQL},
  once AS (SELECT k, field, min({{'c': chunk_pos, 'i': i}}) AS place FROM firsts GROUP BY k, field)
  SELECT k AS doc_id, string_agg(field, '|' ORDER BY place) AS fields FROM once GROUP BY k""")
def collect_fields(spark, sf):
    return I.collect_fields(_chunk_fields(spark, sf), ("doc_id",)).select(
        "doc_id", F.array_join("custom_fields", "|").alias("fields"),
    )


@query(f"""WITH {MESSAGES_SQL}, {chunks_sql(64, LABELLED_DOCS)}, {IDS_SQL},
  once AS (SELECT k, field, min({{'c': chunk_pos, 'i': i}}) AS place FROM firsts GROUP BY k, field),
  lists AS (SELECT k, string_agg(field, '|' ORDER BY place) AS fields FROM once GROUP BY k)
  SELECT m.doc_id,
    CASE WHEN len(m.custom_fields) > 0 THEN 'Extracting Custom Field' ELSE 'No Custom Fields Specified. Abandoning extraction' END AS status,
    CASE WHEN len(m.custom_fields) > 0 THEN coalesce(l.fields, 'NOT FOUND') ELSE '' END AS fields
  FROM msgs m LEFT JOIN lists l ON l.k = m.doc_id""")
def identifiers(spark, sf):
    labelled = labelled_documents(spark, sf).select("doc_id", F.col("text").alias("text2"))
    sent = messages_with_text(spark, sf).join(labelled, "doc_id").withColumn("text", F.col("text2"))
    return field_plan(sent, 64).select("doc_id", "status", F.array_join("custom_fields", "|").alias("fields"))


@query("""WITH r AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '["' || source || '","' || lang || '"]'
    WHEN 1 THEN '["' || lang || '"]' WHEN 2 THEN NULL ELSE '[]' END AS body FROM documents),
  p AS (SELECT doc_id, CAST(from_json(body, '["VARCHAR"]') AS VARCHAR[]) AS l FROM r WHERE body IS NOT NULL)
  SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos, unnest(l) AS field FROM p""")
def clean_model_replies(spark, sf):
    # Fenced lists, bare lists, prose instead of JSON, and empty lists.
    n, q = F.col("doc_id") % 4, F.lit('"')
    two = F.concat(F.lit('```json\n["'), "source", F.lit('","'), "lang", F.lit('"]\n```'))
    one = F.concat(F.lit("["), q, "lang", q, F.lit("]"))
    reply = F.when(n == 0, two).when(n == 1, one).when(n == 2, "no list here").otherwise("```json[]```")
    return I.clean_model_replies(table(spark, sf, "documents").withColumn("reply", reply))


SECRETS = r"\b(?:[0-9a-f]{40}|[0-9]{8,16})\b"


@query(f"""WITH t AS (SELECT doc_id, regexp_extract_all(text, '{SECRETS}') AS l FROM documents),
  u AS (SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos, unnest(l) AS v FROM t)
  SELECT doc_id, pos, CASE WHEN length(v) >= 9 THEN left(v, 4) || repeat('*', length(v) - 8) || right(v, 4) END AS masked,
    CASE WHEN length(v) < 9 THEN 'value too short' END AS reject_reason FROM u""")
def mask_tokens(spark, sf):
    return I.mask_tokens(table(spark, sf, "documents"), SECRETS)


TEMPLATE = '<message role="System">Use only this:\n{{content}}</message>\n<message role="user"> {{ question }} </message>'


@query(f"""WITH {QUESTIONS_SQL} SELECT question_id, replace(replace('{TEMPLATE}', '{{{{content}}}}', coalesce(file_name, '')),
  '{{{{ question }}}}', question) AS prompt FROM questions""")
def render_prompt(spark, sf):
    return P.render_prompt(
        questions(spark, sf), TEMPLATE, {"content": "file_name", "question": "question"},
    ).select("question_id", "prompt")


@query(f"""WITH {QUESTIONS_SQL} SELECT question_id, '**QUESTION:** ' || question || chr(10) || '**CONTENT:** ' || coalesce(custom_field, '-') AS prompt FROM questions""")
def qa_prompt(spark, sf):
    asked = questions(spark, sf).withColumn("context", F.coalesce("custom_field", F.lit("-")))
    return P.qa_prompt(asked).select("question_id", "prompt")


@query(f"""WITH n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i FROM conversations)
  SELECT conv_id, CAST(i // 40 AS INTEGER) AS part, CAST(i % 40 AS INTEGER) AS pos, lower(role) AS role, {trim_sql('text')} AS content FROM n""")
def messages_table(spark, sf):
    turn = F.concat(F.lit('<message role="'), F.upper("role"), F.lit('">\n'), "text", F.lit("\n</message>"))
    parts = collect_parts(table(spark, sf, "conversations"), ["conv_id"], ["turn"], turn, "turns", 40)
    templates = parts.select("conv_id", "part", F.array_join("turns", "\n").alias("template"))
    return P.messages_table(templates, keep=("conv_id", "part"))


def _page_sql() -> str:
    def rule(sql: str, r: tuple[str, str]) -> str:
        to = r[1].replace("'", "''").replace("\n", "' || chr(10) || '")
        return f"regexp_replace({sql}, '{_sql_text(r[0])}', '{to}', 'g')"

    return trim_sql(reduce(rule, PAGE_RULES, "html"))


PAGE_TEXT_SQL = _page_sql()


@query(f"""WITH t AS (SELECT page_id, url, {PAGE_TEXT_SQL} AS text FROM pages)
  SELECT page_id, url, text, CASE WHEN text = '' THEN 'no text extracted' END AS reject_reason FROM t""")
def extract_text(spark, sf):
    return page_to_text(table(spark, sf, "pages")).select("page_id", "url", "text", "reject_reason")
