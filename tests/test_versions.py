"""Appended uploads, the term table and bounded search."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import search as S
from corpusloom.registry.base import index, questions
from corpusloom.session import materialize, scratch_path
from corpusloom.sources import index_log as G
from corpusloom.sources import term_table as W
from corpusloom.sources import versions as V


def rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr)


def make(spark, *values):
    return spark.createDataFrame(list(values), "id string, file_name string, text string")


def stored_files(path):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_an_upload_writes_its_own_rows_only(spark):
    path = scratch_path(spark, "index").replace("file://", "")
    G.append_index(make(spark, ("1", "a", "x"), ("2", "a", "y"), ("3", "b", "z")), path)
    before = stored_files(path)
    assert G.append_index(make(spark, ("1", "a", "new"), ("1", "a", "new")), path) == 2
    after = stored_files(path)
    assert before.items() <= after.items()
    added = [f for f in after if f not in before]
    assert all("version=2" in f for f in added) and spark.read.parquet(f"{path}/rows/version=2").count() == 1
    assert rows(G.read_current(spark, path)) == [("a", "1", "new"), ("b", "3", "z")]


def test_uploads_that_break_or_run_again(spark):
    path = scratch_path(spark, "index")
    G.append_index(make(spark, ("1", "a", "x"), ("3", "b", "z")), path)
    V.write_version(make(spark, ("9", "a", "half")), path, G.ROWS, 2)  # stopped before its files were listed
    assert rows(G.read_current(spark, path)) == [("a", "1", "x"), ("b", "3", "z")]
    for _ in range(2):
        assert G.append_index(make(spark, ("1", "a", "again")), path, 2) == 2
    assert rows(G.read_current(spark, path)) == [("a", "1", "again"), ("b", "3", "z")]
    assert G.append_index(make(spark), path, files=make(spark, ("", "b", ""))) == 4
    assert rows(G.read_current(spark, path)) == [("a", "1", "again")]


def test_compaction(spark):
    path = scratch_path(spark, "index")
    for n in range(3):
        G.append_index(make(spark, (f"{n}", f"f{n}", "old"), ("x", "all", f"v{n}")), path)
    want = rows(G.read_current(spark, path))
    assert G.compact_index(spark, path) == 5 and G.compact_index(spark, path) == 5
    assert rows(G.read_current(spark, path)) == want and V.current_versions(spark, path) == [5]
    assert G.unread_versions(spark, path) == [0, 2, 4]
    assert G.append_index(make(spark, ("x", "all", "newer")), path) == 6
    assert rows(G.read_current(spark, path)) == sorted([r for r in want if r[0] != "all"] + [("all", "x", "newer")], key=repr)


def test_an_upload_during_compaction_stays_newer(spark, monkeypatch):
    path = scratch_path(spark, "index")
    G.append_index(make(spark, ("1", "a", "one")), path)
    G.append_index(make(spark, ("2", "b", "two")), path)
    write = V.write_version

    def slow(part, where, name, version, by=()):
        write(part, where, name, version, by)
        if version == 3:  # the compaction has read and written; another upload ends first
            monkeypatch.setattr(V, "write_version", write)
            G.append_index(make(spark, ("1", "a", "three")), path)

    monkeypatch.setattr(V, "write_version", slow)
    assert G.compact_index(spark, path) == 3
    assert rows(G.read_current(spark, path)) == [("a", "1", "three"), ("b", "2", "two")]


def test_no_index(spark):
    with pytest.raises(ValueError):
        G.read_current(spark, scratch_path(spark, "index"))


def test_a_search_reads_the_asked_folders_and_no_text(spark):
    path = scratch_path(spark, "terms")
    W.append_terms(make(spark, *[(f"{i}", f"f{i}", f"common word{i % 40} rare{i}") for i in range(200)]), path, n_parts=32)
    asked = spark.createDataFrame([(1, "rare7 common"), (2, "nothing")], "question_id int, question string")
    found = W.read_postings(spark, path, S.question_terms(asked).select("term"))
    plan = found._jdf.queryExecution().toString()
    scan = [line for line in plan.splitlines() if "PartitionFilters" in line and "part" in line]
    assert any("part#" in line.split("PartitionFilters")[1] and "IN (" in line.split("PartitionFilters")[1] for line in scan)
    assert "text#" not in plan and len({f.split("part=")[1].split("/")[0] for f in found.inputFiles() if "part=" in f}) <= 32
    assert sorted(r["term"] for r in found.collect()) == ["common"] * 200 + ["rare7"]


def test_words_of_replaced_and_removed_files_do_not_count(spark):
    path, again = scratch_path(spark, "terms"), scratch_path(spark, "terms")
    W.append_terms(make(spark, ("1", "a", "red fish"), ("2", "b", "blue fish"), ("3", "c", "")), path, n_parts=4)
    W.append_terms(make(spark, ("1", "a", "green bird bird")), path, n_parts=99)  # the table keeps its 4 parts
    V.finish(make(spark, ("", "b", "")), path, 4)
    whole = make(spark, ("1", "a", "green bird bird"), ("3", "c", ""))
    W.append_terms(whole, again, n_parts=4)
    asked = spark.createDataFrame([(1, "fish bird a"), (2, "c"), (3, "?!")], "question_id int, question string")
    for k in (None, 1):
        got = rows(W.search_terms(spark, path, asked, k))
        assert got and got == rows(W.search_terms(spark, again, asked, k)) == rows(S.search_text(whole, asked, k))


@pytest.mark.parametrize("seed,k", [(1, 1), (2, 5), (3, 40)])
def test_bounds_lose_nothing(spark, seed, k):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(120)]
    weight = [1 / (i + 1) for i in range(120)]
    texts = [" ".join(draw.choices(vocabulary, weight, k=draw.randint(1, 40))) for _ in range(300)]
    texts += [texts[0]] * 150 + ["", " ".join(vocabulary)]  # many ties
    docs = make(spark, *[(f"d{i:04}", f"f{i % 30}.md", t) for i, t in enumerate(texts)])
    asked = [(i, " ".join(draw.choices(vocabulary, k=draw.randint(1, 12))), f"f{i}.md" if i % 5 == 0 else None) for i in range(30)]
    asked += [(100, texts[0], None), (101, "unknown", None), (102, "", None)]
    asked = spark.createDataFrame(asked, "question_id int, question string, file_name string")
    exact = [r for r in S.search_text(docs, asked).collect()]
    want = sorted((r["question_id"], r["id"], r["score"], r["rank"]) for r in exact if r["rank"] <= k)
    best = S.search_text(docs, asked, k, counts=False).select("question_id", "id", "score", "rank")
    assert sorted(map(tuple, best.collect())) == want
    counted = S.search_text(docs, asked, k)
    totals = {r["question_id"]: r["total_count"] for r in exact}
    got = sorted((r["question_id"], r["id"], r["score"], r["rank"]) for r in counted.collect())
    assert got == want and {r["question_id"]: r["total_count"] for r in counted.collect()} == totals


def test_bounds_leave_words_out(spark):
    frequent = " ".join(f"common{i}" for i in range(6))
    docs = make(spark, *[(f"d{i:04}", "f", f"{frequent} filler{i}" + (" rareword otherrare" if i < 20 else "")) for i in range(800)])
    asked = spark.createDataFrame([(1, f"rareword otherrare {frequent}")], "question_id int, question string")
    m = S.index_matches(docs, asked)
    flags = {r["term"]: r["needed"] for r in S.bounded_weights(m, 10).collect()}
    assert flags["rareword"] and not flags["common0"] and sum(flags.values()) < 8
    assert S.best_scores(m, 10).count() <= 20  # of 800 that match


def test_tasks_sort_out_the_best(spark):
    scored = spark.range(500).select((F.col("id") % 3).alias("question_id"), F.format_string("%03d", "id").alias("id"), (F.col("id") % 11 / 2).alias("score"))
    best = S.local_best(scored.repartition(4), 2, hold=7)
    assert {r["question_id"]: r["n"] for r in best.filter("n IS NOT NULL").groupBy("question_id").agg(F.sum("n").alias("n")).collect()} == {0: 167, 1: 167, 2: 166}
    got = rows(S.top_k(best.filter("n IS NULL").drop("n"), 2))
    assert got == rows(S.top_k(scored, 2)) and best.count() <= 4 * 3 * 3


def test_hits_leave_tasks_in_small_numbers(spark, sf):
    plan = S.search_text(materialize(index(spark, sf)), questions(spark, sf), 10)._jdf.queryExecution().toString()
    assert "best-" in plan and "scores-" not in plan


def test_documents_of_a_search_stay_whole(spark):
    docs = make(spark, *[(f"d{i}", "f", f"red fish{i % 7} red") for i in range(60)], ("d1", "f", "red fish1 red"), ("d2", "f", "red"))
    asked = spark.createDataFrame([(1, "red fish1"), (2, "fish2")], "question_id int, question string")
    m = S.index_matches(docs, asked)
    # Sums are made where the documents are; neither words nor sums are shuffled by question.
    assert "hashpartitioning(question_id" not in S.all_scores(m)._jdf.queryExecution().toString()
    assert m.documents.count() == 61  # a row per document and length, not per word
    got = {(r["question_id"], r["id"]): r["score"] for r in S.all_scores(m).collect()}
    assert len(got) == 60 + 9 and got[1, "d1"] > got[1, "d8"]


def test_packed_words_are_the_postings(spark):
    path = scratch_path(spark, "terms")
    W.append_terms(make(spark, *[(f"{i}", f"f{i % 9}", f"red fish{i % 5} red") for i in range(40)]), path, n_parts=4)
    W.append_terms(make(spark, ("1", "f1", "green fish1"), ("1", "f1", "green fish1")), path)
    terms = spark.createDataFrame([("red",), ("fish1",), ("f1",)], "term string")
    packed = W.read_packed(spark, path, terms)
    assert packed.count() == packed.select("id").distinct().count()
    flat = packed.select("id", "dl", F.explode("words").alias("w")).select("id", "dl", "w.term", "w.tf")
    assert rows(flat) == rows(W.read_postings(spark, path, terms))


def test_postings_hold_numbers_and_no_ids(spark):
    path = scratch_path(spark, "terms")
    W.append_terms(make(spark, *[(f"{i}", f"f{i % 9}", f"red fish{i % 5} red") for i in range(40)]), path, n_parts=4)
    assert sorted(spark.read.parquet(f"{path}/postings").columns) == ["number", "part", "term", "tf", "version"]


def test_words_of_rows_that_share_a_document(spark):
    docs = make(spark, ("1", "a", "red fish"), ("1", "a", "fish red"), ("1", "a", "red"), ("2", "b", "red red blue"), (None, "c", "red"), ("3", None, "blue"), ("4", "d", ""))
    asked = spark.createDataFrame([(1, "red"), (2, "blue fish c")], "question_id int, question string")
    for some in (docs, docs.filter("id <> '1'"), docs.filter("id IS NULL OR id <> '1'")):  # counted after a shuffle, and where they are
        path = scratch_path(spark, "terms")
        W.append_terms(some, path, n_parts=4, files=some)
        known = some.filter("file_name IS NOT NULL")
        got = rows(W.read_postings(spark, path, spark.createDataFrame([("red",), ("blue",), ("fish",)], "term string")))
        words = {}
        for r in some.collect():
            found = f"{r['text']} {r['file_name'] or ''}".split()
            for w in set(found) & {"red", "blue", "fish"}:
                key = (r["id"], r["file_name"], len(found), w)
                words[key] = words.get(key, 0) + found.count(w)
        assert got == sorted(((dl, id_, term, tf) for (id_, _, dl, term), tf in words.items()), key=repr)
        if known.count() == some.count():
            assert rows(W.search_terms(spark, path, asked)) == rows(S.search_text(some, asked))


def test_documents_with_equal_hashes_are_told_apart(spark, monkeypatch):
    hashed, seeds = W._number, []
    monkeypatch.setattr(W, "_number", lambda seed: seeds.append(seed) or (hashed(seed) if seed > 1 else F.length("id").cast("bigint")))
    path = scratch_path(spark, "terms")
    W.append_terms(make(spark, *[(f"{i}", "f", "red") for i in range(5)]), path, n_parts=2)
    assert seeds == [0, 1, 2, 2]
    assert W.read_postings(spark, path, spark.createDataFrame([("red",)], "term string")).select("id").distinct().count() == 5


def test_uploads_move_no_rows_with_ids_of_their_own(spark):
    path = scratch_path(spark, "index")
    docs = make(spark, *[(f"{i}", "f", f"text {i}") for i in range(20)])
    assert G._single(docs) is docs
    shared = docs.unionByName(make(spark, ("3", "f", "again"), (None, "f", "none"), (None, "f", "none")))
    G.append_index(shared, path)
    got = rows(G.read_current(spark, path).select("id"))
    assert got == sorted([(f"{i}",) for i in range(20)] + [(None,)], key=repr)
    assert rows(G.read_current(spark, path, make(spark, ("7", "", ""), ("7", "", ""), ("x", "", "")))) == [("f", "7", "text 7")]
