"""Hard negatives against scoring every row for every anchor."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.llm.tree_negatives import Best, Trees, matrix, mine_hard_negatives, norms, products, spanning_tree

SCHEMA = "vec_id bigint, label int, embedding array<float>, score double, id bigint, part string, vector string"


def plain_negatives(rows, anchor_step, scale=256):
    best = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if i not in best or (label, v) < best[i]:
            best[i] = (label, v)
    whole = {i: (label, [int(math.floor(scale * float(np.float32(x)))) for x in v]) for i, (label, v) in best.items()}
    out = []
    for a, (label, v) in whole.items():
        if a % anchor_step:
            continue
        score = {i: sum(x * y for x, y in zip(v, w)) for i, (_, w) in whole.items()}
        first = lambda ids: sorted(ids, key=lambda i: (-score[i], i))[:5]
        for p in first(i for i in whole if whole[i][0] == label and i != a):
            inside = [i for i in whole if whole[i][0] != label and 80 * score[p] <= 100 * score[i] <= 100 * score[p]]
            out += [(a, p, rank, i, score[p], score[i]) for rank, i in enumerate(first(inside), 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, None, None, None, None) for r in rows], SCHEMA)


def mined(spark, rows, step, **more):
    got = mine_hard_negatives(frame(spark, rows).repartition(5), F.col("vec_id") % step == 0, **more)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def clustered(n, dim, seed, spread=0.05):
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((12, dim)) / math.sqrt(dim)
    m = (centres[draw.integers(0, 12, n)] + spread * draw.standard_normal((n, dim)) / math.sqrt(dim)).astype(np.float32)
    return [(int(i), int(draw.integers(0, 4)), m[i].tolist()) for i in range(n)]


@pytest.mark.parametrize("more", [{}, {"tree_anchors": 3, "scan_bytes": 100}])
def test_equals_scoring_everything(spark, more):
    rows = clustered(1200, 16, 1)
    rows += [(5000 + i, i % 4, rows[0][2]) for i in range(600)]  # a third of all vectors are one and the same
    assert mined(spark, rows, 20, **more) == plain_negatives(rows, 20)


def test_random_vectors(spark):
    draw = np.random.default_rng(3)
    rows = [(i, int(draw.integers(0, 3)), draw.standard_normal(6).astype(np.float32).tolist()) for i in range(400)]
    assert mined(spark, rows, 10) == plain_negatives(rows, 10)


def test_odd_rows(spark):
    v = [0.5, -0.25, 1.0]
    rows = [(i, i % 3, [0.1 * i, 0.2, -0.05 * i]) for i in range(0, 60)]
    rows += [(None, 1, v), (100, None, v), (200, 1, None), (300, 1, [0.5, None, 1.0]), (400, 1, [0.5, float("nan"), 1.0])]
    rows += [(500, 1, [float("inf"), 0.0, 0.0]), (600, 1, []), (700, 2, [1.0]), (800, 2, [1.0, 1.0, 1.0, 1.0])]
    rows += [(900, 1, v), (900, 1, v), (900, 0, v), (1000, 99, v), (1100, 0, [-1.0, 0.0, 0.0])]
    assert mined(spark, rows, 10) == plain_negatives(rows, 10)


def test_large_components_are_exact(spark):
    rows = [(i, i % 2, [1e5 * (i + 1), 3e5 - i, 5.0]) for i in range(30)]
    assert mined(spark, rows, 5) == plain_negatives(rows, 5)


def test_tables_without_pairs(spark):
    assert mined(spark, [], 10) == []
    assert mined(spark, [(1, 1, [1.0]), (2, 1, [1.0])], 10) == []
    assert mined(spark, [(10, 1, [1.0]), (2, 2, [1.0])], 10) == []


def test_bounds_hold_and_spare_scores():
    rows = clustered(3000, 16, 5, spread=0.02)
    table = pa.table({"v": pa.array([r[2] for r in rows])})
    m = matrix(table["v"], 16, 256.0)
    anchors = m[::30]
    order, parent, edge = spanning_tree(anchors)
    assert sorted(order) == list(range(len(anchors))) and (parent[1:] < np.arange(1, len(order))).all()
    lengths = [np.linalg.norm(anchors[order[i]] - anchors[order[p]]) for i, p in enumerate(parent) if i]
    assert np.allclose(lengths, edge[1:], rtol=1e-6)
    trees = Trees(pa.table({
        "label": [0] * len(order), "pivot": [0] * len(order), "part": [0] * len(order), "place": np.arange(len(order)), "parent": parent,
        "edge": edge, "vec_id": order, "vector": pa.array(anchors[order].tolist()),
    }), 16, 1.0)
    exact = m @ anchors[order].T
    best, scored = Best(len(order), 5), []

    def need(anchor, low, high):
        assert (low <= exact[:, anchor]).all() and (high >= exact[:, anchor]).all()
        return high >= best.least[anchor]

    def take(anchor, picked, scores):
        assert (scores == exact[picked, anchor]).all()
        scored.append(len(picked))
        best.add(anchor, scores, picked)

    trees.walk(0, len(order), m, norms(m), need, take)
    trees.walk(0, len(order), m, norms(m), need, take)  # once more, now that the least scores are known
    again = sum(scored[len(order):])
    assert again < 0.3 * m.shape[0] * len(order)


def test_products_saturate():
    big = np.array([[1e200, 1.0], [-1e200, 0.0]])
    assert products(big, np.array([1e200, 1.0])).tolist() == [(1 << 63) - 1, -((1 << 63) - 1)]
