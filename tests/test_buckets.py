"""The bucketed vector search against the exact one."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import buckets as A
from corpusloom.operators import neighbours as N
from corpusloom.operators.neighbours import recall, vector_top_k
from corpusloom.session import materialize

SCHEMA = "id bigint, vector array<float>"


def frame(spark, m):
    return spark.createDataFrame(pa.table({"id": np.arange(len(m)), "vector": list(m.astype(np.float32))}), SCHEMA)


def clustered(n, dim=64, per=200, seed=0):
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((max(1, n // per), dim))
    return centres[draw.integers(0, len(centres), n)] + 0.35 * draw.standard_normal((n, dim))


def rows(df):
    return sorted(map(tuple, df.collect()))


def queries(index):
    return index.withColumnRenamed("id", "query_id")


@pytest.mark.parametrize("tables,bits,block", [(1, 3, None), (3, 4, 70)])
def test_all_buckets_are_the_exact_search(spark, tables, bits, block):
    index = frame(spark, np.random.default_rng(1).standard_normal((300, 8)).round(1))
    got = A.vector_top_k_buckets(index, queries(index), 7, probes=99, query_block=block, tables=tables, bits=bits)
    assert rows(got) == rows(vector_top_k(index, queries(index), 7))


def test_recall_and_work_on_a_large_index(spark):
    met = {}
    for n in (10_000, 40_000):
        index = materialize(frame(spark, clustered(n)).repartition(8))
        asked = queries(index.filter(F.col("id") % 40 == 0))
        plan = A.plan_buckets(index)
        coded = materialize(A.bucket_vectors(index, plan))
        probes = A.fit_probes(coded, plan, 10)
        got = A.vector_top_k_buckets(coded, asked, 10, plan, probes)
        found = recall(got, vector_top_k(index, asked, 10)).first()
        assert found["recall"] >= 0.9 and found["n_exact"] == n // 40 * 10
        met[n] = A.rows_met(coded, asked, plan, probes).agg(F.avg("n_rows")).first()[0]
    assert met[40_000] < 0.1 * 40_000 and met[40_000] < 2.5 * met[10_000]  # four times the index


def test_random_vectors_reach_the_wanted_recall(spark):
    index = materialize(frame(spark, np.random.default_rng(5).standard_normal((6000, 32))))
    asked = queries(index.filter(F.col("id") % 10 == 0))
    assert recall(A.vector_top_k_buckets(index, asked, 10), vector_top_k(index, asked, 10)).first()["recall"] >= 0.9


def test_a_third_of_the_index_in_one_bucket(spark):
    m = clustered(1500, 16)
    m[:500] = m[0]
    m[700] = 0
    index = frame(spark, m).repartition(6)
    got = A.vector_top_k_buckets(index, queries(index), 10, probes=1, tables=2, bits=6)
    exact = {(r["query_id"], r["id"]): r["score"] for r in vector_top_k(index, queries(index), 1500).collect()}
    held = got.collect()
    assert all(exact[r["query_id"], r["id"]] == r["score"] for r in held)
    assert len(held) == 15_000 and sorted({r["rank"] for r in held}) == list(range(1, 11))  # none comes back short
    copies = sorted(r["id"] for r in held if r["query_id"] == 3)
    assert copies == list(range(10))


def test_small_and_empty_tables(spark):
    index = frame(spark, np.eye(4))
    assert rows(A.vector_top_k_buckets(index, queries(index), 10, probes=1)) == rows(vector_top_k(index, queries(index), 10))
    empty = spark.createDataFrame([], SCHEMA)
    assert rows(A.vector_top_k_buckets(empty, queries(empty), 3)) == []
    assert rows(A.vector_top_k_buckets(index, queries(empty), 3)) == []
    assert rows(A.vector_top_k_buckets(empty, queries(index), 3)) == []


def test_buckets_are_probed_in_order_of_distance():
    plan = A.Buckets(1, 3, np.eye(3), np.zeros(3))
    looked = A.probed_buckets(plan, [np.array([0.9, 0.1, -0.3])], 8)[0, 0].tolist()
    assert looked[:4] == [0b011, 0b001, 0b111, 0b101] and sorted(looked) == list(range(8))


def test_exact_search_keeps_queries_off_the_driver(spark, monkeypatch):
    rng = np.random.default_rng(3)
    vectors = [(i, rng.integers(-2, 3, 6).astype(float).tolist()) for i in range(90)] + [(5, [1.0] * 6)]
    index = spark.createDataFrame(vectors, "id bigint, vector array<double>").repartition(3)
    queries = index.withColumnRenamed("id", "query_id")
    want = sorted(map(tuple, N.vector_top_k(index, queries, 4).collect()))

    def refuse(*_):
        raise AssertionError("queries came to the driver")

    monkeypatch.setattr(N, "_query_blocks", refuse)
    monkeypatch.setattr(N, "CELLS", 70)  # many blocks of rows
    assert sorted(map(tuple, N.vector_top_k(index, queries, 4, query_block=7).collect())) == want


def test_scores_of_a_bucket_are_worked_out_in_slices(spark, monkeypatch):
    index = spark.createDataFrame([(i, [1.0, float(i % 50)]) for i in range(300)], "id bigint, vector array<double>").coalesce(1)
    queries = index.withColumnRenamed("id", "query_id")
    want = sorted(map(tuple, N.vector_top_k(index, queries, 3).collect()))
    monkeypatch.setattr(A, "CELLS", 1000)
    monkeypatch.setattr(A, "LOOKED_BYTES", 16 * 2 * 4 * 100)  # blocks of 100 queries
    found = A.vector_top_k_buckets(index, queries, 3, probes=4, tables=2, bits=2)
    assert sorted(map(tuple, found.collect())) == want


def test_best_rows_of_streamed_blocks():
    draw = np.random.default_rng(3)
    rows = draw.standard_normal((900, 5))
    rows[400:500] = rows[0]  # many ties
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    rows[7] = np.nan
    queries, ids = rows[::50], draw.permutation(900)
    scores = np.round(queries @ rows.T, 6)
    even = lambda q, row: (row + q) % 2 == 0
    for met in (None, even):
        top = N.TopRows(np.arange(len(queries)), queries, 6)
        for first in (0, 300, 310, 800):
            upto = {0: 300, 300: 310, 310: 800, 800: 900}[first]
            top.add(ids[first:upto], rows[first:upto], None if met is None else (lambda q, row: met(q, row + first)))
        got = top.hits()
        for q in range(len(queries)):
            fits = [i for i in range(900) if np.isfinite(scores[q, i]) and (met is None or met(q, i))]
            want = sorted((-scores[q, i], ids[i]) for i in fits)[:6]
            assert [(-s, i) for s, i in zip(got["score"][got["query_id"] == q], got["id"][got["query_id"] == q])] == want


@pytest.mark.parametrize("probes", [3, 5, 8])
def test_the_grid_meets_the_same_rows(spark, monkeypatch, probes):
    vectors = np.random.default_rng(probes).standard_normal((400, 6))
    index = materialize(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id bigint, vector array<double>"))
    asked = index.withColumnRenamed("id", "query_id")
    found = {}
    for share in (0, 1e9):
        monkeypatch.setattr(A, "GRID_SHARE", share)
        if not share:  # no list of queries in the driver
            monkeypatch.setattr(A, "_query_blocks", None)
        found[share] = sorted(map(tuple, A.vector_top_k_buckets(index, asked, 4, probes=probes, tables=2, bits=3).collect()))
        monkeypatch.undo()
    assert found[0] == found[1e9] and len(found[0]) == 1600
