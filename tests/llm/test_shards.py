"""Shards against a plain k-d tree over sorted lists."""

import collections
import random
import zlib

import pytest
from pyspark.sql import functions as F

from corpusloom.llm.kd_shards import _narrow, kd_shards


def plain_tree(rows, n_shards, dims, slack):
    """{r: shard} of rows (c, h, d, r, size), every node sorted in full."""
    total = sum(x["size"] for x in rows)
    extent = [max(x["c"][i] for x in rows) - min(x["c"][i] for x in rows) for i in range(dims)]
    loose = slack * total / n_shards
    out = {}

    def split(part, s, k):
        if k == 1 or not part:
            out.update((x["r"], s) for x in part)
            return
        width = [(max(x["c"][i] for x in part) - min(x["c"][i] for x in part)) / (extent[i] or 1) for i in range(dims)]
        dim = width.index(max(width))
        part = sorted(part, key=lambda x: (x["c"][dim], x["h"], x["d"], x["r"]))
        goal = sum(x["size"] for x in part) * (k // 2) / k
        until, places = 0, [(0, 0, True)]
        for i, x in enumerate(part, 1):
            until += x["size"]
            places.append((until, i, i == len(part) or part[i]["h"] != x["h"]))
        groups = [p for p in places if p[2] and abs(p[0] - goal) <= loose]
        cut = min(groups or places, key=lambda p: (abs(p[0] - goal), p[0]))[1]
        split(part[:cut], s, k // 2)
        split(part[cut:], s + k // 2, k - k // 2)

    split(rows, 0, n_shards)
    return out


def check_law(got, rows, n_shards):
    """Whole result, sizes, checksums, gapless slots; the bytes of every shard."""
    want = sorted((i is not None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in got) == want
    slots = collections.defaultdict(list)
    for r in got:
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < n_shards
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = collections.Counter()
    for r in got:
        sizes[r["shard"]] += r["size"]
    return sizes


def texts(n, seed, copies=0):
    draw = random.Random(seed)
    out = [("word " * int(draw.paretovariate(1.1) * 5))[:9000] + str(draw.random()) for _ in range(n)]
    hot = "the same text in many places " * 3
    return out + [hot] * copies + [out[i % 7] for i in range(n // 10)]


@pytest.mark.parametrize("n_shards,few,bins", [(16, 4096, 1024), (16, 3, 4), (5, 10, 7), (1, 10, 7)])
def test_equals_the_plain_tree(documents, n_shards, few, bins):
    body = texts(300, 1, copies=150)  # one group holds a third of the rows
    rows = [(i % 400, t, ["de", "en", None][i % 3], f"site{i % 11}") for i, t in enumerate(body)]
    docs = documents(rows)
    got = kd_shards(docs, n_shards, few=few, bins=bins).collect()
    sizes = check_law(got, [r[:2] for r in rows], n_shards)
    assert len(sizes) == n_shards and max(sizes.values()) - min(sizes.values()) <= 2 * max(r["size"] for r in got)
    narrow = [r.asDict() for r in _narrow(docs, ("lang", "source"), "text", "doc_id").collect()]
    place = plain_tree(narrow, n_shards, 3, 1 / 128)
    key = lambda r: (r["doc_id"], r["size"], r["text_crc32"])
    assert sorted((key(r), r["shard"]) for r in got) == sorted((key(r), place[r["r"]]) for r in narrow)


def test_copies_stay_together_where_bytes_allow(documents):
    rows = [(i, f"text {i // 3} " * (i // 3 % 50 + 5), "de", f"s{i % 9}") for i in range(9000)]
    got = kd_shards(documents(rows)).collect()
    sizes = check_law(got, [r[:2] for r in rows], 16)
    mean = sum(sizes.values()) / 16
    assert max(sizes.values()) < 1.03 * mean and min(sizes.values()) > 0.97 * mean
    held = collections.defaultdict(set)
    for r in got:
        held[r["text_crc32"]].add(r["shard"])
    assert all(len(s) == 1 for s in held.values())


def test_rows_that_cannot_be_told_apart_are_parted(documents):
    rows = [(None, None)] * 400 + [(7, "seven")] * 300 + [(i, f"text {i}") for i in range(100)]
    sizes = check_law(kd_shards(documents(rows), few=8, bins=16).collect(), rows, 16)
    assert len(sizes) == 16 and max(sizes.values()) - min(sizes.values()) <= 12


def test_odd_rows_and_empty_tables(documents, odd_rows):
    check_law(kd_shards(documents(odd_rows)).collect(), [r[:2] for r in odd_rows], 16)
    assert kd_shards(documents([])).collect() == []
    got = kd_shards(documents([(1, "x")])).collect()
    assert [tuple(r) for r in got] == [(1, 2, zlib.crc32(b"x"), "bytes", got[0]["shard"], 0, None)]


def test_target_bytes_and_other_dimensions(spark):
    rows = [(f"id{i}", "t" * (i % 90), i * 0.5, None if i % 5 else True) for i in range(500)]
    docs = spark.createDataFrame(rows, "name string, body string, weight double, flag boolean")
    total = sum(len(r[1]) + 1 for r in rows)
    got = kd_shards(docs, target_bytes=total // 6, dims=("weight", "flag"), text="body", doc_id="name").collect()
    sizes = collections.Counter()
    for r in got:
        sizes[r["shard"]] += r["size"]
    assert len(sizes) == 6 and len(got) == 500 and max(sizes.values()) < 1.1 * total / 6 + 90


def test_plan_has_no_python(documents):
    plan = kd_shards(documents([(i, f"text {i}") for i in range(50)]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
