"""Exact duplicates and the Jaccard join against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.llm.bloom import build_bloom, in_bloom
from corpusloom.llm.byte_words import WordHasher, cut_long, mix, text_buffer, word_grams
from corpusloom.llm.components import connected_components
from corpusloom.llm.exact_dedup import exact_dedup
from corpusloom.llm.parity_join import (
    _different_blocks, _near_pairs, _with_earlier, band_blocks, block_keys, entered_blocks, jaccard_components, wide_sketches,
)
from corpusloom.session import small_enough
from fractions import Fraction
from tests.llm.brute import Union, jaccard_components as slow_components, words_of


def plain_dedup(rows):
    groups = {}
    for i, t in rows:
        normal = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        groups.setdefault(normal, []).append((-len(t or ""), i is None, i))
    out = []
    for i, t in rows:
        normal = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        n, _, keep = min(groups[normal], key=lambda x: (x[0], x[1], x[2] or 0))
        out.append((i, keep, len(groups[normal]), len(t or "") == -n and i == keep, hashlib.sha256(normal.encode()).hexdigest()))
    return out


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def test_exact_dedup_odd_rows(documents, odd_rows):
    assert in_order(exact_dedup(documents(odd_rows)).collect()) == in_order(plain_dedup(odd_rows))


def test_exact_dedup_tells_colliding_hashes_apart(documents):
    rows = [(i, f"text number {i % 5}") for i in range(40)]
    got = exact_dedup(documents(rows), hash_of=lambda normal: F.unhex(F.lit("00")))
    assert in_order(got.collect()) == in_order(plain_dedup(rows))


def test_empty_tables(documents):
    assert exact_dedup(documents([])).collect() == []
    assert jaccard_components(documents([])).collect() == []


def test_words_equal_a_regular_expression():
    texts = ["Hello  World\tfoo", "", "x", None, "A b\x0bC d", "hello world", "é\xa0ü", "y" * 200_000 + " Z", "a" * 70_000 + " b"]
    at, raw = text_buffer(pa.array(texts))
    _, start, end, text = WordHasher(fold_case=False).words(at, raw)
    got = [(int(t), bytes(raw[a:b]).decode()) for a, b, t in zip(start, end, text)]
    assert got == [(i, w) for i, t in enumerate(texts) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
    h, *_ = WordHasher().words(at, raw)
    assert h[0] == h[-7] or len(set(h.tolist())) < len(h)  # Hello and hello


def test_grams_of_short_and_long_texts():
    at, raw = text_buffer(pa.array(["a b c d e f", "a b", "", "a b c d e"]))
    h, _, _, text = WordHasher().words(at, raw)
    grams, first = word_grams(h, text, 5)
    assert text[first].tolist() == [0, 0, 1, 3] and grams[0] == grams[3] and len(set(grams.tolist())) == 3


def test_slices_cover_long_texts():
    at, raw = text_buffer(pa.array(["a b " * 1000, "", "c" * 5000, "d"]))
    cuts, owner = cut_long(at, raw, 512)
    assert cuts[0] == at[0] and cuts[-1] == at[-1] and (np.diff(cuts) <= 512).all()
    assert np.bincount(owner, weights=np.diff(cuts), minlength=4).tolist() == np.diff(at).tolist()


def test_bloom_finds_all(spark):
    keys = spark.range(5000).selectExpr("xxhash64(id) AS k")
    words = build_bloom(keys, "k", 1 << 16)
    inside = keys.toArrow()["k"].to_numpy()
    other = spark.range(5000, 10000).selectExpr("xxhash64(id) AS k").toArrow()["k"].to_numpy()
    assert in_bloom(words, inside).all() and in_bloom(words, other).mean() < 0.1


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)]
    want = Union({x for e in edges for x in e})
    for a, b in edges:
        want.join(a, b)
    got = {r.node: r.comp for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: want.find(x) for a, b in edges if a != b for x in (a, b)}


def test_linked_sets_share_an_entered_block():
    """For random pairs at the limit, the prefix and pigeonhole argument holds in each order of blocks."""
    rng = np.random.default_rng(1)
    for n in [*range(1, 40), 63, 64, 100, 127, 128, 500]:
        for _ in range(6):
            both = int(np.ceil(0.8 * n))
            a = rng.integers(0, 1 << 62, n).astype(np.uint64)
            cut = int(rng.integers(0, n - both + 1))
            b = np.concatenate([a[:n - cut], rng.integers(0, 1 << 62, max(0, int(both / 0.8) - n) if cut == n - both else 0).astype(np.uint64)])
            x, y = np.unique(a), np.unique(b)
            common = len(np.intersect1d(x, y))
            if 5 * common < 4 * (len(x) + len(y) - common):
                continue
            values, rows = np.concatenate([x, y]), np.repeat([0, 1], [len(x), len(y)])
            found = [set(), set()]
            allowed = entered_blocks(np.array([len(x), len(y)]), Fraction(4, 5))
            for up in (False, True):
                key, count, row = block_keys(values, rows, 2, up, Fraction(4, 5))
                for i in (0, 1):
                    mine = row == i
                    order = np.lexsort((key[mine], -count[mine]))
                    found[i] |= set(key[mine][order][:allowed[i]].tolist())
            assert found[0] & found[1], n


def share_an_entered_block(x, y):
    values, rows = np.concatenate([np.sort(x), np.sort(y)]), np.repeat([0, 1], [len(x), len(y)])
    allowed = entered_blocks(np.array([len(x), len(y)]), Fraction(4, 5))
    found = [set(), set()]
    for up in (False, True):
        key, count, row = block_keys(values, rows, 2, up, Fraction(4, 5))
        for i in (0, 1):
            mine = row == i
            found[i] |= set(key[mine][np.lexsort((key[mine], -count[mine]))][:allowed[i]].tolist())
    return bool(found[0] & found[1])


def test_small_linked_sets_share_an_entered_block():
    """For all sizes up to 10 that may link, and so many draws that shingles meet in few blocks."""
    rng = np.random.default_rng(2)
    for a in range(1, 11):
        for b in range(a, a * 5 // 4 + 1):
            for both in range(-(-4 * (a + b) // 9), a + 1):  # common / (a + b - common) >= 4/5
                for _ in range(500):
                    v = rng.integers(0, 1 << 62, a + b - both).astype(np.uint64)
                    assert share_an_entered_block(v[:a], v[a - both:]), (a, b, both)


def crowded(rng, n, blocks, into):
    """Values that band_blocks deals to the first ``into`` of ``blocks`` blocks."""
    v = rng.integers(0, 1 << 62, (2 * n + 40) * blocks // into).astype(np.uint64)
    return v[mix(v, 21) % np.uint64(blocks) < into][:n]


@pytest.mark.parametrize("n", [4, 5, 8, 12, 16, 20, 31, 32, 40, 48, 51, 64, 100, 120])
def test_linked_sets_in_few_blocks_share_an_entered_block(n):
    """All shingles of both sets lie in as few blocks as the sets may differ in, or fewer, so all of those may be spoilt."""
    rng = np.random.default_rng(n)
    blocks = int(band_blocks(np.int64(np.log2(n))))
    for more in range(n // 4 + 1):
        for into in {1, max(1, more // 2), max(1, more), more + 1}:
            for _ in range(6):
                v = crowded(rng, n + more, blocks, min(into, blocks))
                rng.shuffle(v)
                assert len(v) == n + more and share_an_entered_block(v[:n], v)


def test_blocks_are_enough():
    n = np.arange(1, 5000)
    band = np.floor(np.log2(n)).astype(int)
    assert (entered_blocks(n, Fraction(4, 5)) <= band_blocks(band)).all()


def edited(rnd, words, share):
    return [w if rnd.random() > share else f"w{rnd.randrange(10**9)}" for w in words]


@pytest.fixture(scope="module")
def near_copies():
    """Groups of copies with few and many edits, a passage that most texts share, and short texts."""
    rnd = random.Random(7)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for g in range(12):
        base = [f"v{rnd.randrange(4000)}" for _ in range(rnd.choice([6, 20, 80, 300]))]
        for _ in range(rnd.choice([1, 3, 25])):
            text = edited(rnd, base, rnd.choice([0, 0.005, 0.02, 0.04]))
            if rnd.random() < 0.5:
                text = text + passage
            rows.append(" ".join(text))
    rows += [" ".join(passage[:rnd.randrange(40, 60)]) for _ in range(30)]
    rows += ["a b", "A  b", "a b c", "a b c d e", "a b c d e f", "a b c d e f g", "", None]
    return list(enumerate(rows))


def test_jaccard_components(documents, near_copies):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(documents(near_copies)).collect()}
    assert got == slow_components(near_copies)


def test_jaccard_frequent_blocks(documents, near_copies, monkeypatch):
    """The same result where nearly all blocks count as frequent."""
    monkeypatch.setattr("corpusloom.llm.parity_join.FREQUENT_IN_BATCH", 2)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(documents(near_copies)).collect()}
    assert got == slow_components(near_copies)


def test_jaccard_odd_rows(documents, odd_rows):
    got = in_order(jaccard_components(documents(odd_rows)).collect())
    n = len({tuple(words_of(odd_rows[5][1])[i:i + 5]) for i in range(20_000 - 4)})
    want = [
        (1, 0, 1), (2, 0, 2), (3, 0, 3), (None, 3, None), (None, 0, None), (4, n, 4), (5, n + 1, 4), (6, 3, 6), (7, 3, 6), (7, 3, 6),
        (8, 1, 8), (9, 1, 9), (10, 1, 10), (11, 3, 6),
    ]
    assert got == in_order(want)


def test_wide_sketches_bound_the_difference():
    draw = np.random.default_rng(3)
    for n, change in ((256, 10), (500, 120), (511, 3), (515, 5), (3000, 700), (40_000, 100)):
        a = np.unique(draw.integers(0, 1 << 62, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[change:], draw.integers(0, 1 << 62, change // 2).astype(np.uint64)]))
        x, y = (wide_sketches(s, np.zeros(len(s), np.int64), 1)[0] for s in (a, b))
        if x is None or y is None:
            assert min(len(a), len(b)) < 256
            continue
        while len(x) > len(y):
            x = x[:len(x) // 2] ^ x[len(x) // 2:]
        while len(y) > len(x):
            y = y[:len(y) // 2] ^ y[len(y) // 2:]
        differ = int(np.unpackbits((x ^ y).view(np.uint8)).sum())
        assert differ <= len(np.setxor1d(a, b)) and (n > 4000 or differ > 0.5 * len(np.setxor1d(a, b)))


def test_long_texts_that_share_passages(documents):
    """Many long texts with common passages: some links just at the threshold, most pairs apart."""
    draw = random.Random(11)
    word = lambda: f"w{draw.randrange(10**6)}"
    passages = [[word() for _ in range(150)] for _ in range(4)]
    rows = []
    for i in range(60):
        body = [word() for _ in range(draw.choice([150, 300, 600]))] + passages[i % 4] + passages[(i + 1) % 4]
        rows.append((3 * i, " ".join(body)))
        for j, share in enumerate((0.8, 0.93)):  # a tail of its own, below and above what links
            keep = int(len(body) * share)
            rows.append((3 * i + j + 1, " ".join(body[:keep] + [word() for _ in range(len(body) - keep)])))
    want = slow_components(rows)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(documents(rows)).collect()}
    assert got == want and len({c for _, c in want.values()}) > 60


def test_blocks_of_the_same_sets_are_kept_once(spark):
    """Also where a set comes from several batches, and where blocks differ in a middle set only."""
    sets = {1: (5, 7), 2: (5, 7), 3: (5, 6, 7), 4: (5, 6, 7), 5: (5, 8, 7), 6: (5,), 7: (5, 6), 8: (6, 7)}
    rows = [(k, n) for k, held in sets.items() for n in held] + [(k, 6) for k, held in sets.items() if 6 in held]
    got = _different_blocks(spark.createDataFrame(rows, "key bigint, node bigint").repartition(5)).collect()
    assert sorted(tuple(r) for r in got) == [
        (1, 5, 5, 2), (1, 7, 5, 2), (3, 5, 5, 2), (3, 6, 5, 2), (3, 7, 5, 2), (5, 5, 5, 1), (5, 7, 5, 1), (5, 8, 5, 1),
        (7, 5, 5, 1), (7, 6, 5, 1), (8, 6, 6, 1), (8, 7, 6, 1),
    ]


@pytest.mark.parametrize("earlier", [1, 8])
def test_pairs_of_many_blocks_are_listed_few_times(spark, monkeypatch, earlier):
    monkeypatch.setattr("corpusloom.llm.parity_join.EARLIER", earlier)
    draw = random.Random(5)
    held = {n: set(range(40)) - set(draw.sample(range(40), n % 4)) | {100 + n // 2, 200 + n} for n in range(30)}
    comp = {n: n if n % 5 else 0 for n in held}  # six sets in the main component of each block
    rows = [(k, n, comp[n], 0, 100, 1, 2, 3, 4) for n, keys in held.items() for k in keys]
    placed = spark.createDataFrame(rows, "key bigint, node bigint, comp bigint, main bigint, n bigint, s0 bigint, s1 bigint, s2 bigint, s3 bigint")
    placed = _with_earlier(placed)
    got = [tuple(r) for r in _near_pairs(placed.filter("comp <> main"), placed, Fraction(4, 5)).collect()]
    want = {(a, b) for a in held for b in held if a < b and comp[a] != comp[b]}
    assert set(got) == want and len(got) <= (8 if earlier == 1 else 1.2) * len(want)


def test_jaccard_of_a_common_passage(documents, monkeypatch):
    """Texts that are mostly one passage: chains of links whose ends are apart, found with few earlier blocks known."""
    monkeypatch.setattr("corpusloom.llm.parity_join.EARLIER", 1)
    draw = random.Random(13)
    passage = [f"p{i}" for i in range(130)]
    rows = []
    for i in range(90):
        at = draw.randrange(20)
        own = [f"w{draw.randrange(10**6)}" for _ in range(draw.choice([4, 12, 22, 34, 60]))]
        rows.append((i, " ".join(own + passage[at:130 - draw.randrange(20)])))
    want = slow_components(rows)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(documents(rows)).collect()}
    assert got == want and 1 < len({c for _, c in want.values()}) < 90


def test_rows_of_blocks_stay_where_they_are(spark, monkeypatch):
    """Short tables of blocks go to the rows, also where Spark by itself would move both; beyond the counted bound nothing is sent."""
    from corpusloom.llm import parity_join as P

    rows = spark.createDataFrame([(k, n, n % 3) for k in range(40) for n in range(k % 5 + 2)], "key bigint, node bigint, comp bigint")
    links = spark.createDataFrame([(0, 1)], "a bigint, b bigint")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = []
        for bound in (1000, 0):
            monkeypatch.setattr(P, "small_enough", lambda df, n=None, bound=bound: small_enough(df, n, bound))
            tables = [P._open_blocks(rows), P._merged(rows, links), P._with_earlier(rows)]
            plans = [t._jdf.queryExecution().executedPlan().toString() for t in tables]
            assert all(("BroadcastHashJoin" in plan) == (bound > 0) for plan in plans)
            found.append([sorted(map(repr, t.select(sorted(t.columns)).collect())) for t in tables])
        assert found[0] == found[1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
