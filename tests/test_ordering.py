"""Hot keys: the sliced way must give what a plain window gives."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom.operators import ordering as O
from corpusloom.operators import search as S
from corpusloom.operators import tracking as T
from corpusloom.registry.base import index, questions, tracking


def skewed(spark):
    """A third of the rows under key 0, some under NULL, equal order values throughout."""
    n = F.col("id")
    return spark.range(3000).select(
        F.when(n % 3 == 0, 0).when(n % 50 == 1, None).otherwise(n % 40).alias("k"),
        (n * 7919 % 101).alias("t"), n.alias("seq"),
    ).repartition(5)


def rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr)


def test_position(spark):
    df = skewed(spark)
    w = Window.partitionBy("k").orderBy("t", "seq")
    want = df.withColumn("position", F.row_number().over(w).cast("bigint"))
    assert rows(O.group_position(df, ["k"], ["t", "seq"], hot_rows=50)) == rows(want)
    assert rows(O.group_position(df, ["k"], ["t", "seq"])) == rows(want)


def test_position_descending(spark):
    df = skewed(spark)
    w = Window.partitionBy("k").orderBy(F.desc("t"), "seq")
    want = df.withColumn("position", F.row_number().over(w).cast("bigint"))
    assert rows(O.group_position(df, ["k"], [F.desc("t"), F.col("seq")], hot_rows=50)) == rows(want)


def test_lag(spark):
    df = skewed(spark)
    w = Window.partitionBy("k").orderBy("t", "seq")
    want = df.withColumn("before", F.lag("t").over(w))
    assert rows(O.group_lag(df, ["k"], ["t", "seq"], "t", "before", hot_rows=50)) == rows(want)


def test_global_position(spark):
    df = skewed(spark)
    got = O.global_position(df.select("seq"), ["seq"])
    assert all(r["position"] == r["seq"] + 1 for r in got.collect())
    assert got.count() == 3000


def test_collect_parts(spark):
    df = skewed(spark)
    parts = O.collect_parts(df, ["k"], ["t", "seq"], F.col("seq"), "seqs", 7, hot_rows=50)
    assert parts.agg(F.max(F.size("seqs"))).first()[0] == 7
    got = {}
    for r in parts.orderBy("k", "part").collect():
        got.setdefault(r["k"], []).extend(r["seqs"])
    want = {}
    for r in df.orderBy("t", "seq").collect():
        want.setdefault(r["k"], []).append(r["seq"])
    assert got == want


def test_timings_with_hot_ids(spark, sf):
    events = tracking(spark, sf)
    assert rows(T.stage_timings(events, hot_rows=20)) == rows(T.stage_timings(events))


def test_history_with_hot_ids(spark, sf):
    events = tracking(spark, sf)
    assert rows(T.tracking_history(events, 10, hot_rows=20)) == rows(T.tracking_history(events, 10))


def test_search_with_hot_questions(spark, sf):
    idx, asked = index(spark, sf), questions(spark, sf)
    assert rows(S.search_text(idx, asked, hot_rows=50)) == rows(S.search_text(idx, asked))


def test_running_sums_of_hot_and_cold_keys(spark):
    draw = random.Random(6)
    rows = [(0 if draw.random() < 0.5 else draw.randrange(1, 6), i, draw.randrange(100)) for i in range(800)]
    df = spark.createDataFrame(rows, "key int, at int, size int")
    want, sums = [], {}
    for key, at, size in rows:
        want.append((key, at, size, sums.get(key, 0)))
        sums[key] = sums.get(key, 0) + size
    for hot_rows in (10_000, 50, 0):
        got = O.group_running_sum(df, ["key"], ["at"], "size", "before", hot_rows)
        assert sorted(map(tuple, got.collect())) == sorted(want)


@pytest.mark.parametrize("limit,hot_rows", [(40, 10_000), (40, 3), (9, 0), (1000, 10_000)])
def test_parts_never_exceed_their_bytes(spark, limit, hot_rows):
    draw = random.Random(limit)
    texts = ["".join(draw.choice("abé漢😀") for _ in range(draw.choice([0, 1, 3, 8, 30, 90]))) for _ in range(60)]
    hits = spark.createDataFrame([(i % 4, i // 4 + 1, t) for i, t in enumerate(texts)], "question_id int, rank int, text string")
    got = S.parts_by_bytes(hits, limit, "", hot_rows).collect()
    assert all(len(r["context"].encode()) <= limit for r in got)
    for q in range(4):
        mine = sorted((r["part"], r["context"]) for r in got if r["question_id"] == q)
        assert [p for p, _ in mine] == list(range(len(mine)))
        assert "".join(c for _, c in mine) == "".join(texts[q::4])


@pytest.mark.parametrize("limit,hot_rows", [(40, 10_000), (9, 0)])
def test_parts_of_stored_texts(spark, limit, hot_rows):
    draw = random.Random(limit)
    texts = {f"t{i}": "".join(draw.choice("abé漢😀") for _ in range(draw.choice([0, 1, 3, 8, 30, 90]))) for i in range(20)}
    stored = spark.createDataFrame([*texts.items(), ("unasked", "x")], "id string, text string")
    ranked = [(q, i + 1, name) for q in range(4) for i, name in enumerate(draw.sample(sorted(texts), 15))]
    hits = spark.createDataFrame(ranked, "question_id int, rank int, id string")
    got = S.parts_by_bytes(hits, limit, "", hot_rows, stored)
    with_text = spark.createDataFrame([(q, r, texts[i]) for q, r, i in ranked], "question_id int, rank int, text string")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, S.parts_by_bytes(with_text, limit, "", hot_rows).collect()))


def test_each_of_several_texts_with_one_id_is_in_the_context(spark):
    stored = spark.createDataFrame([("a", "one"), ("a", "one"), ("a", "two"), ("b", "three")], "id string, text string")
    hits = spark.createDataFrame([(1, 1, "b"), (1, 2, "a")], "question_id int, rank int, id string")
    assert [r["context"] for r in S.parts_by_bytes(hits, 1000, "|", 10, stored).collect()] == ["three|one|one|two"]
