"""Every stage of the pipeline against a plain version on its own input, and the registered queries."""

import random

import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from corpusloom.llm.mil_quality import learn_quality, score_quality
from corpusloom.llm.queries import ORACLES, QUERIES
from tests.compare import duck, run
from tests.llm.brute import jaccard_components as slow_components
from tests.llm.test_dedup import plain_dedup
from tests.llm.test_tokens import check_packing


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small corpus with junk, copies, near copies and benchmark passages, as Parquet."""
    rnd = random.Random(21)
    where = str(tmp_path_factory.mktemp("corpus"))

    def prose(n):
        return [f"{rnd.choice('bcdfg')}{rnd.choice('aeiou')}{rnd.randrange(900)}" for _ in range(n)]

    items = [(i, " ".join(prose(40))) for i in range(5)]
    rows, labels = [], []
    for i in range(300):
        words = prose(rnd.randrange(30, 150))
        kind = i % 10
        if kind == 1:
            words = [w + "%%%" for w in words]
        elif kind in (2, 3) and i > 20:
            words = rows[i - kind][1].split()
            if kind == 3:
                words[len(words) // 2] = "changed"
        elif kind == 4:
            words[5:5] = items[i % 5][1].split()
        rows.append((i, ("  " if kind == 2 else " ").join(words), "en", "s", 1))
        labels.append((i, int(kind != 1), 0))
    rows += [(None, "a row without an id", None, None, None), (300, None, None, None, None), (301, "", "en", "s", 0), rows[0]]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{where}/benchmark.parquet")
    return where, dict(items)


def test_each_stage(spark, folder, tmp_path):
    where, items = folder
    docs = spark.read.parquet(f"{where}/documents.parquet")
    before = [tuple(r) for r in docs.collect()]

    def stage(k):
        nonlocal docs
        out = corpus_pipeline.STAGES[k][1](spark, docs, where)
        if k < 4:
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        return [tuple(r) for r in docs.collect()]

    good = {r.doc_id for r in score_quality(docs, learn_quality(docs, spark.read.parquet(f"{where}/labels.parquet"))).collect() if r.predicted}
    now = stage(0)
    assert sorted(now, key=repr) == sorted((r for r in before if r[0] in good), key=repr)
    assert not [r for r in now if r[1] and "%%%" in r[1]] and len(now) > 260

    kept = {r[0] for r in plain_dedup([r[:2] for r in now]) if r[3]}
    want = {r for r in now if r[0] is None or r[0] in kept}
    now = stage(1)
    assert sorted(now, key=repr) == sorted(want, key=repr)

    groups = slow_components([r[:2] for r in now if r[0] is not None])
    want = [r for r in now if r[0] is None or groups[r[0]][1] == r[0]]
    now = stage(2)
    assert sorted(now, key=repr) == sorted(want, key=repr)

    want = [r for r in now if not any(t in (r[1] or "") for t in items.values())]
    assert len(want) < len(now)
    now = stage(3)
    assert sorted(now, key=repr) == sorted(want, key=repr)

    stage(4)
    packed = docs.collect()
    assert {r.doc_id for r in packed} == {r[0] for r in now}
    assert check_packing(packed, 4096) == -(-sum(r.length for r in packed) // 4096)
    whole = corpus_pipeline.run(spark, where)
    assert sorted(map(tuple, whole.select("doc_id", "piece", "length", "ids_crc32").collect()), key=repr) == sorted(
        ((r.doc_id, r.piece, r.length, r.ids_crc32) for r in packed), key=repr)


def test_stages_of_empty_tables(spark, folder):
    where, _ = folder
    empty = spark.read.parquet(f"{where}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, where).collect() == []


def test_all_are_registered():
    names = entry_module.queries()
    assert "pipeline" in names and set(QUERIES) <= set(names) and set(ORACLES) <= set(entry_module.oracle_sql())
    for n in range(1, 11):
        assert [q for q in names if q.startswith(f"op{n}_")]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracles(spark, sf, name):
    ok, text = run(spark, duck(sf), name, sf)
    assert ok, text
