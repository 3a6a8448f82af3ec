"""Registered queries of the operators, with DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.best_fit_packing import best_fit_packing
from corpusloom.llm.cross_parsing import identify_language, learn_languages
from corpusloom.llm.decontaminate import contaminated_passages
from corpusloom.llm.exact_dedup import exact_dedup
from corpusloom.llm.kd_shards import kd_shards
from corpusloom.llm.masked_lm import learn_language_model, score_language_model
from corpusloom.llm.mil_quality import learn_quality, score_quality
from corpusloom.llm.parity_join import jaccard_components
from corpusloom.llm.permuterm_variants import document_variants
from corpusloom.llm.subword_toxicity import learn_toxicity, score_toxicity
from corpusloom.llm.token_counts import section_token_counts
from corpusloom.llm.tree_negatives import mine_hard_negatives
from corpusloom.llm.url_templates import judge_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Path of a public tokenizer file, which is the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


# Rules of the URL query.
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


@_query
def op1_benchmark_decontamination(spark, sf_dir):
    return contaminated_passages(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query
def op2_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return score_toxicity(docs, learn_toxicity(docs, _table(spark, sf_dir, "labels")))


@_query
def op3_masked_lm_score(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return score_language_model(docs, learn_language_model(docs))


@_query
def op4_ngram_jaccard_join(spark, sf_dir):
    return jaccard_components(_table(spark, sf_dir, "documents"))


@_query
def op5_url_templates(spark, sf_dir):
    return judge_urls(_table(spark, sf_dir, "pages"), URL_RULES)


@_query
def op6_best_fit_packing(spark, sf_dir):
    return best_fit_packing(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


@_query
def op7_section_token_counts(spark, sf_dir):
    import public_tokenizers

    return section_token_counts(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@_query
def op8_exact_dedup(spark, sf_dir):
    return exact_dedup(_table(spark, sf_dir, "documents"))


ORACLES["op8_exact_dedup"] = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS normal
  FROM documents)
SELECT doc_id,
  first_value(doc_id) OVER w AS keep_id,
  count(*) OVER (PARTITION BY normal) AS group_size,
  doc_id = first_value(doc_id) OVER w AS kept,
  sha256(normal) AS text_sha256
FROM t
WINDOW w AS (PARTITION BY normal ORDER BY n DESC, doc_id)
"""


@_query
def op9_quality_classifier(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return score_quality(docs, learn_quality(docs, _table(spark, sf_dir, "labels")))


@_query
def op10_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return identify_language(docs, learn_languages(docs))


@_query
def op11_tree_negatives(spark, sf_dir):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(_table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 100 == 0)


ORACLES["op11_tree_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id AS id, b.label AS other, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0),
p AS (
  SELECT * FROM s WHERE own = other AND id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
  s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE s.own <> s.other AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
QUALIFY rank <= 5
"""


@_query
def op12_spelling_variants(spark, sf_dir):
    return document_variants(_table(spark, sf_dir, "documents"))


ORACLES["op12_spelling_variants"] = """
WITH RECURSIVE
tab AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{7,}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
kinds AS (SELECT run, count(*) AS c, hex(encode(doc_id || ':' || run)) AS bytes FROM runs GROUP BY doc_id, run),
hashed AS (SELECT run, c, xor(list_reduce(list_prepend(4294967295, list_transform(range(len(bytes) // 2), lambda k: ('0x' || substr(bytes, 2 * k + 1, 2))::BIGINT)),
  lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS h FROM kinds, tab),
words AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(c)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 7 AND n >= 2),
cuts AS (SELECT word, n, unnest(range(length(word))) AS i FROM words),
skips AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS less FROM cuts),
pairs AS (
  SELECT a.word, b.word AS other, b.n AS m FROM skips a JOIN skips b ON a.i = b.i AND a.less = b.less AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM skips a JOIN words b ON a.less = b.word
  UNION SELECT b.word, a.word, a.n FROM skips a JOIN words b ON a.less = b.word),
near AS (SELECT word, count(*) AS n_near, first(other ORDER BY m DESC, other) AS best, max(m) AS best_n FROM pairs GROUP BY word),
forms AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * n THEN best END AS form, CASE WHEN best_n >= 10 * n THEN best_n END AS form_n
  FROM words LEFT JOIN near USING (word)),
chain AS (SELECT word, word AS root, form AS next FROM forms
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON c.next = f.word)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM forms f JOIN chain c ON f.word = c.word AND c.next IS NULL
"""


@_query
def op13_kd_shards(spark, sf_dir):
    return kd_shards(_table(spark, sf_dir, "documents"))


@_query
def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
