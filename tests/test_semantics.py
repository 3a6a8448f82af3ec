"""Rules that the given tables do not exercise, on literal rows, and brute-force checks."""

import math
from collections import Counter
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.functions.text import index_key, is_blank, stem, trim_ws
from corpusloom.operators import catalog as C
from corpusloom.operators import identifiers as I
from corpusloom.operators import messages as M
from corpusloom.operators import neighbours as N
from corpusloom.operators import prompts as P
from corpusloom.operators import search as S
from corpusloom.operators import sharding as H
from corpusloom.operators.extract import extract_text
from corpusloom.plans.answers import HELP_MESSAGE, answer_context
from corpusloom.plans.corpus import process_corpus
from corpusloom.plans.fields import identifiers
from corpusloom.plans.indexing import index_rejects, index_rows
from corpusloom.schemas import INDEX_ROW, MESSAGE

META = "file_name string, metadata map<string,string>"


def names(df):
    return sorted(r["file_name"] for r in df.collect())


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_processed_key_counts_whatever_its_value(spark):
    df = spark.createDataFrame([("a", {"Processed": "false"}), ("b", {}), ("c", None)], META)
    assert names(C.filter_processed(df)) == ["b", "c"]
    assert names(C.filter_processed(df, force=True)) == ["a", "b", "c"]


def test_queue_date(spark):
    rows = [
        ("later", {"IsQueued": "01/02/2024 00:00:01"}), ("same", {"IsQueued": "01/02/2024 00:00:00"}),
        ("short", {"IsQueued": "1/3/2024 1:00:00 PM"}), ("iso", {"IsQueued": "2024-01-05T00:00:00"}),
        ("unreadable", {"IsQueued": "soon"}), ("none", {}), ("old", {"IsQueued": "12/31/2023 23:00:00"}),
    ]
    df = spark.createDataFrame(rows, META)
    kept = ["none", "old", "same", "unreadable"]
    assert names(C.filter_queued_before(df, datetime(2024, 1, 2))) == kept
    assert names(C.filter_queued_before(df)) == sorted(r[0] for r in rows)
    # The date holds for forced runs too.
    forced = df.filter(C.skip_reason(F.col("metadata"), True, datetime(2024, 1, 2)).isNull())
    assert names(forced) == kept


def test_metadata_is_replaced(spark):
    df = spark.createDataFrame([("a", {"IsQueued": "x", "other": "y"})], META)
    assert C.mark_processed(df).first()["metadata"] == {"Processed": "true"}


def test_stems(spark):
    cases = {"a/b/c.d.pdf": "c.d", "plain": "plain", ".hidden": "", "x/": "", "a.b/c": "c"}
    for name, want in cases.items():
        assert one(spark, stem(F.lit(name))) == want, name


def test_blank_and_trim(spark):
    assert one(spark, is_blank(F.lit("  \n"))) is True
    assert one(spark, is_blank(F.lit(None).cast("string"))) is True
    assert one(spark, is_blank(F.lit("\x1c"))) is False
    assert one(spark, trim_ws(F.lit(" a b　\n"))) == "a b"


def test_index_key_is_stable(spark):
    a = one(spark, index_key(F.lit("f.md"), F.lit(0)))
    assert a == one(spark, index_key(F.lit("f.md"), F.lit(0))) and len(a) == 40
    assert a != one(spark, index_key(F.lit("f.md"), F.lit(1)))


@pytest.mark.parametrize("n", [1, 2, 3, 10])
def test_endpoints(spark, n):
    df = spark.range(10).select(F.col("id").cast("int").alias("shard"))
    for r in H.assign_endpoint(df, [f"e{i}" for i in range(n)]).collect():
        assert r["endpoint"] == (f"e{r['shard']}" if r["shard"] < n else f"e{r['shard'] % n}")


def test_an_endpoint_is_needed(spark):
    with pytest.raises(ValueError):
        H.assign_endpoint(spark.range(1).withColumn("shard", F.lit(0)), [])


def test_more_endpoints_than_shards(spark):
    df = spark.range(10).select(F.col("id").cast("int").alias("shard"))
    got = H.assign_endpoint(df, [f"e{i}" for i in range(11)]).collect()
    assert all(r["endpoint"] == f"e{r['shard']}" for r in got)


def test_shards_are_dealt_in_order(spark):
    df = spark.createDataFrame([(f"f{i:04d}",) for i in range(257)], "file_name string").repartition(7)
    rows = H.assign_shard(df).orderBy("file_name").collect()
    assert [r["shard"] for r in rows] == [i % 10 for i in range(257)]
    sizes = Counter(r["shard"] for r in H.assign_shard(df, mode="hash").collect())
    assert set(sizes) <= set(range(10))


def test_names_by_brute_force(spark):
    """One file after another, as they arrive; primary names of all stems are settled first."""
    rng = np.random.default_rng(3)
    files = [(f"d{i}/{'hot' if i % 3 == 0 else 's' + str(rng.integers(20))}.{i}.pdf".replace(f".{i}.pdf", f".p{i}"),
              datetime(2024, 1, 1, 0, int(rng.integers(3)))) for i in range(120)]
    files.append(("z/s1-2024-02-03-04-05.pdf", datetime(2024, 1, 2)))
    stored = {"s3.md", "s4.md", "s4-2024-02-03-04-05.md"}
    df = spark.createDataFrame(files, "file_name string, queued_at timestamp").repartition(5)
    existing = spark.createDataFrame([(s,) for s in stored], "result_name string")
    run = F.lit("2024-02-03 04:05:06").cast("timestamp")
    got = {r["file_name"]: (r["outcome"], r["result_name"]) for r in H.resolve_names(df, existing, run).collect()}
    order = sorted(files, key=lambda f: (f[1], f[0]))
    base = {f: f.rsplit("/", 1)[-1].rsplit(".", 1)[0] for f, _ in files}
    taken, want = set(stored), {}
    for f, _ in order:
        if base[f] + ".md" not in taken:
            taken.add(base[f] + ".md")
            want[f] = ("primary", base[f] + ".md")
    for f, _ in order:
        if f not in want:
            dated = base[f] + "-2024-02-03-04-05.md"
            want[f] = ("failed", None) if dated in taken else ("timestamped", dated)
            taken.add(dated)
    assert got == want


def test_duplicates(spark):
    df = spark.createDataFrame([("a",), ("b",)], "file_name string")
    got = names(C.duplicate_corpus(df, 999_999, 2))
    assert got == ["1000000-a", "1000000-b", "999999-a", "999999-b"]
    assert C.duplicate_corpus(df, 0, 0).count() == 0
    assert C.duplicate_corpus(df, 5, 2500).select("copy").distinct().count() == 2500


def test_unreadable_messages(spark):
    values = ['{"id":"1","recognizer_index":3}', "{", "[]", "", "nonsense", "{}"]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    got = {r["value"]: (r["id"], r["reject_reason"]) for r in M.decode_messages(df, MESSAGE).collect()}
    assert got['{"id":"1","recognizer_index":3}'] == ("1", None)
    assert got["{}"] == (None, None)
    for bad in ("{", "", "nonsense"):
        assert got[bad][1] == "unreadable message"


def test_white_space_is_content(spark):
    df = spark.createDataFrame([("a", " "), ("b", ""), ("c", None)], "n string, text string")
    good, bad = M.reject_empty(df)
    assert [r["n"] for r in good.collect()] == ["a"]
    assert sorted(r["n"] for r in bad.collect()) == ["b", "c"]


def test_field_routes(spark):
    df = spark.createDataFrame(
        [(1, ["x"], ["A1"]), (2, ["x"], []), (3, [], ["A1"]), (4, None, ["A1"]), (5, ["x"], None)],
        "n int, custom_fields array<string>, found array<string>",
    )
    got = {r["n"]: (r["custom_fields"], r["status"]) for r in M.route_custom_fields(df, "found").collect()}
    assert got[1] == (["A1"], M.EXTRACTING_STATUS)
    assert got[2][0] == got[5][0] == ["NOT FOUND"]
    assert got[3] == got[4] == ([], M.NO_FIELDS_STATUS)
    everyone = {r["n"]: r["custom_fields"] for r in M.route_custom_fields(df, "found", extract_all=True).collect()}
    assert everyone[3] == everyone[4] == ["A1"]


def test_identifiers(spark):
    text = "\n".join([
        "Ship under Bill of Lading: 123456789 or Load ID Ref # ABCD1234.", "plain AB12CD34EF and again AB12CD34EF",
        "- list ZZ11YY22", "| T4BL3ROW | 1 |", "1. N0M3B3R5X", "abcdefghij 1234567890 A1B2C3",
    ])
    df = spark.createDataFrame([("m", ["x"], text), ("n", ["x"], "nothing"), ("e", ["x"], "")],
                               "n string, custom_fields array<string>, text string")
    got = {r["n"]: r for r in identifiers(df, 1000).collect()}
    assert got["m"]["custom_fields"] == ["123456789", "ABCD1234", "AB12CD34EF"]
    assert got["n"]["custom_fields"] == ["NOT FOUND"]
    assert got["e"]["reject_reason"] == "no content"
    # Small chunks find the same.
    small = {r["n"]: r["custom_fields"] for r in identifiers(df, 20).collect()}
    assert set(small["m"]) == {"123456789", "ABCD1234", "AB12CD34EF"}


def test_field_bag(spark):
    rows = [("d", 0, 0, "a"), ("d", 0, 1, "b"), ("d", 1, 0, "a")]
    df = spark.createDataFrame(rows, "processed_name string, chunk_pos int, field_pos int, field string")
    assert I.collect_fields(df).first()["custom_fields"] == ["a", "b"]
    assert I.collect_fields(df, dedupe=False).first()["custom_fields"] == ["a", "b", "a"]


def test_replies(spark):
    rows = [(1, '```json\n["a","b"]\n```'), (2, "null"), (3, "not json"), (4, '["x", null]'), (5, None), (6, '{"a":1}')]
    df = spark.createDataFrame(rows, "doc_id int, reply string")
    got = [(r["doc_id"], r["pos"], r["field"]) for r in I.clean_model_replies(df).orderBy("doc_id", "pos").collect()]
    assert [g for g in got if g[0] in (1, 2, 3, 5, 6)] == [(1, 0, "a"), (1, 1, "b")]


def test_mask(spark):
    assert one(spark, I.mask(F.lit("abcd1efgh"))) == "abcd*efgh"
    assert one(spark, I.mask(F.lit("abcdefgh"))) is None


def test_prompt_values_are_literal(spark):
    df = spark.createDataFrame([("$1 {{b}} \\1", "B")], "a string, b string")
    got = P.render_prompt(df, "x {{a}} y {{ b }} {{c}}", {"a": "a", "b": "b"}).first()["prompt"]
    assert got == "x $1 {{b}} \\1 y B {{c}}"


def test_messages(spark):
    text = '<message role="System">\n one\ntwo </message> between <message  role="user"></message>'
    df = spark.createDataFrame([(1, text), (2, "none")], "id int, template string")
    got = [(r["id"], r["pos"], r["role"], r["content"]) for r in P.messages_table(df).collect()]
    assert got == [(1, 0, "system", "one\ntwo"), (1, 1, "user", "")]


def test_pages(spark):
    page = ("<html><head><title>t</title></head><body><script>if (a<b) {}</script><h1>Head</h1><ul><li>x &amp; y</li></ul>"
            "<!-- gone --><p>a&nbsp;&lt;b&gt;</p></body></html>")
    df = spark.createDataFrame([(1, page), (2, "<p> </p>"), (3, None)], "page_id int, html string")
    got = {r["page_id"]: r for r in extract_text(df).collect()}
    assert got[1]["text"] == "# Head\n- x & y\na <b>"
    assert got[2]["reject_reason"] == got[3]["reject_reason"] == "no text extracted"


def index_of(spark, rows):
    return spark.createDataFrame(rows, "id string, text string, file_name string, custom_field array<string>")


def test_search_by_brute_force(spark):
    rng = np.random.default_rng(5)
    vocab = ["load", "truck", "bill", "paper", "dock", "crate", "the"]
    docs = [(f"d{i:03d}", " ".join(rng.choice(vocab, int(rng.integers(1, 12)))), f"f{i % 7}.md", [f"v{i % 3}"]) for i in range(80)]
    asked = [(1, "the load load", None, None), (2, "Dock crate?", "x/f3.pdf", None), (3, "bill", None, "v1"),
             (4, "paper truck", "f2.docx", "v2"), (5, "absent", None, None)]
    idx = index_of(spark, docs)
    questions = spark.createDataFrame(asked, "question_id int, question string, file_name string, custom_field string")
    words = {d[0]: (d[1] + " " + d[2].replace(".", " ") + " " + d[3][0]).lower().split() for d in docs}
    n, avgdl = len(docs), sum(map(len, words.values())) / len(docs)
    want = {}
    for q, text, name, field in asked:
        for d in docs:
            if name and d[2].rsplit(".", 1)[0] != name.rsplit("/", 1)[-1].rsplit(".", 1)[0]:
                continue
            if field and field not in d[3]:
                continue
            tf, score = Counter(words[d[0]]), 0.0
            for t in text.lower().replace("?", "").split():
                df = sum(t in w for w in words.values())
                if tf[t]:
                    idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
                    score += idf * tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * len(words[d[0]]) / avgdl))
            if score:
                want[(q, d[0])] = round(score, 5)
    got = {(r["question_id"], r["id"]): round(r["score"], 5) for r in S.search_text(idx, questions).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 2e-5 for k in want)


def test_answers(spark):
    idx = index_of(spark, [("a", "load one", "a.md", []), ("b", "load two", "b.md", [])])
    rows = [(1, "load", None, ""), (2, "zebra", None, ""), (3, " ", None, ""), (4, "load", "dir/b.pdf", "")]
    asked = spark.createDataFrame(rows, "question_id int, question string, file_name string, custom_field string")
    got = {(r["question_id"], r["part"]): r for r in answer_context(idx, asked, part_size=1).collect()}
    assert got[(1, 0)]["context"] + got[(1, 1)]["context"] == "load oneload two"
    assert got[(1, 0)]["n_matches"] == 2 and got[(1, 0)]["status"] == 200
    assert got[(2, 0)]["status"] == 204 and got[(2, 0)]["message"] == S.NO_MATCH_MESSAGE
    assert got[(3, 0)]["status"] == 200 and got[(3, 0)]["message"] == HELP_MESSAGE
    assert got[(4, 0)]["context"] == "load two"
    assert got[(4, 0)]["prompt"] == "**QUESTION:** load\n**CONTENT:** load two"


def test_index_rows(spark):
    df = spark.createDataFrame([("a.md", None, "x y\nz"), ("b.md", ["F1"], ""), ("c.md", ["F1"], " ")],
                               "processed_file_name string, custom_fields array<string>, text string")
    rows = index_rows(df, dim=16)
    assert rows.schema.fieldNames() == INDEX_ROW.fieldNames()
    got = rows.collect()
    assert [(r["file_name"], r["text"], r["custom_field"], len(r["embedding"])) for r in got] == [("a.md", "x y\nz", [], 16)]
    assert abs(sum(v * v for v in got[0]["embedding"]) - 1) < 1e-6
    assert [r["processed_file_name"] for r in index_rejects(df).collect()] == ["b.md"]


def test_run_over_a_catalogue(spark):
    at = datetime(2024, 1, 1)
    files = [("in/a.pdf", {}, at), ("in/b.pdf", {}, at), ("in/c.pdf", {}, at), ("in/d.pdf", {"Processed": "true"}, at),
             ("in/e.pdf", {}, at), ("out/a.pdf", {}, datetime(2024, 1, 2)), ("x/a.pdf", {}, datetime(2024, 1, 3))]
    catalog = spark.createDataFrame(files, "file_name string, metadata map<string,string>, queued_at timestamp") \
        .withColumn("container", F.lit("documents"))
    texts = spark.createDataFrame(
        [("in/a.pdf", "see AB12CD34EF"), ("in/b.pdf", ""), ("in/e.pdf", ""), ("out/a.pdf", " "), ("x/a.pdf", "late")],
        "source_file_name string, text string",
    )
    wanted = spark.createDataFrame([("in/a.pdf", ["ask"]), ("in/b.pdf", ["ask"])],
                                   "source_file_name string, custom_fields array<string>")
    existing = spark.createDataFrame([], "result_name string")
    run = process_corpus(catalog, texts, existing, ["e0"], F.lit("2024-02-03 04:05:06").cast("timestamp"), wanted, dim=8)
    rejects = {(r["source_file_name"], r["stage"], r["reject_reason"]) for r in run.rejects.collect()}
    assert rejects == {("in/b.pdf", "fields", "no content"), ("in/c.pdf", "extraction", "no text extracted"),
                       ("in/e.pdf", "indexing", "no content"), ("x/a.pdf", "extraction", "result name taken")}
    steps = {}
    for r in run.events.orderBy("seq").collect():
        steps.setdefault(r["source_file_name"], []).append(r["status"])
    assert {k: len(v) for k, v in steps.items()} == {
        "in/a.pdf": 15, "in/b.pdf": 6, "in/c.pdf": 4, "in/e.pdf": 11, "out/a.pdf": 15, "x/a.pdf": 4}
    assert steps["in/e.pdf"][-1] == "Failure in indexing: no content"
    assert steps["in/a.pdf"][6] == "Extracting Custom Field"
    index = [(r["file_name"], r["custom_field"]) for r in run.index.collect()]
    assert index == [("a.md", ["AB12CD34EF"])]
    places = {r["file_name"]: (r["container"], r["metadata"]) for r in run.catalog.collect()}
    assert places["in/a.pdf"] == ("completed", {"Processed": "true"})
    queued = {"IsQueued": "02/03/2024 04:05:06"}
    assert places["in/c.pdf"] == ("documents", queued) and places["x/a.pdf"] == ("documents", queued)
    assert places["out/a.pdf"][0] == "completed" and places["in/b.pdf"][0] == "documents"


def vectors(spark, n, dim, seed, name):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.standard_normal(dim)]) for i in range(n)]
    rows[3] = (3, rows[0][1])
    return rows, spark.createDataFrame(rows, f"{name} bigint, vector array<float>").repartition(4)


def test_vectors_by_brute_force(spark):
    rows, idx = vectors(spark, 300, 12, 1, "id")
    qrows, queries = vectors(spark, 30, 12, 2, "query_id")
    m, q = np.array([r[1] for r in rows], dtype=np.float32), np.array([r[1] for r in qrows], dtype=np.float32)
    m, q = m.astype(float), q.astype(float)
    sims = np.round((q @ m.T) / np.linalg.norm(q, axis=1)[:, None] / np.linalg.norm(m, axis=1), 6)
    want = sorted((i, int(j), k + 1) for i in range(30) for k, j in enumerate(np.lexsort((np.arange(300), -sims[i]))[:5]))
    for block in (100, 7):
        got = sorted((r["query_id"], r["id"], r["rank"]) for r in N.vector_top_k(idx, queries, 5, block).collect())
        assert got == want
    near = N.vector_top_k_ann(idx, queries, 5, 12, candidates=100)
    exact = N.vector_top_k(idx, queries, 5)
    assert N.recall(near, exact).first()["recall"] >= 0.9
    all_rows = N.vector_top_k_ann(N.code_vectors(idx, 12), queries, 5, 12, candidates=300)
    assert sorted((r["query_id"], r["id"], r["rank"]) for r in all_rows.collect()) == want
    assert N.vector_top_k(idx, queries.limit(0), 5).count() == 0


def test_given_vectors_recall(spark, sf):
    from corpusloom.registry import QUERIES

    assert QUERIES["ann_recall"](spark, sf).first()["recall"] >= 0.9


def test_sign_codes_are_made_once_and_score_candidates_only(spark, monkeypatch):
    """Blocks of queries read stored codes; the hits are those of a plain scan over the same candidates, also where rows share an id."""
    rows, idx = vectors(spark, 200, 12, 3, "id")
    idx = idx.union(spark.createDataFrame([(5, [float(x) for x in range(12)])], "id bigint, vector array<float>"))
    _, queries = vectors(spark, 20, 12, 4, "query_id")
    plans, chosen, near_rows = [], [], N.near_rows

    def seen(coded, *more):
        plans.append(coded._jdf.queryExecution().toString())
        chosen.append(near_rows(coded, *more))
        return chosen[-1]

    monkeypatch.setattr(N, "near_rows", seen)
    got = N.vector_top_k_ann(idx, queries, 5, 12, candidates=40, query_block=7).collect()
    assert len(plans) > 1 and not any("ArrowEvalPython" in plan for plan in plans)
    asked = {r["query_id"]: np.array(r["vector"], np.float64) for r in queries.collect()}
    held = [(r["id"], np.array(r["vector"], np.float64)) for r in idx.collect()]
    wanted = {tuple(r) for part in chosen for r in part.collect()}
    want = []
    for one, q in asked.items():
        scores = [(-round(float(q @ v / np.linalg.norm(q) / np.linalg.norm(v)), 6), id) for id, v in held if (one, id) in wanted]
        want += [(one, id, k + 1) for k, (_, id) in enumerate(sorted(scores)[:5])]
    assert sorted((r["query_id"], r["id"], r["rank"]) for r in got) == sorted(want)


def test_sign_code_query_asks_for_every_hundredth_row(spark, sf):
    from corpusloom.registry import QUERIES
    from corpusloom.registry.search_queries import _vector_queries, _vectors

    hits = QUERIES["vector_top_k_codes"](spark, sf).cache()
    every = _vector_queries(spark, sf).filter("query_id % 100 = 0")
    assert {r[0] for r in hits.select("query_id").distinct().collect()} == {r[0] for r in every.select("query_id").collect()}
    assert N.recall(hits, N.vector_top_k(_vectors(spark, sf), every, 10)).first()["recall"] >= 0.9
