"""Decontamination and URL templates."""

import random

import numpy as np
import pytest

from corpusloom.llm import decontaminate, url_templates
from corpusloom.llm.decontaminate import alignment, contaminated_passages, drop_contaminated
from corpusloom.llm.queries import URL_RULES
from corpusloom.llm.url_templates import judge_urls
from tests.llm.brute import smith_waterman


def prose(rnd, n):
    return [f"v{rnd.randrange(3000)}" if rnd.random() < 0.7 else rnd.choice(["the", "of", "in", "and"]) for _ in range(n)]


@pytest.fixture(scope="module")
def leaks():
    """(items, documents, the (document, item) pairs that hold a copy)."""
    rnd = random.Random(11)
    items = [(i, prose(rnd, rnd.randrange(20, 60))) for i in range(30)]
    docs, want = [], set()
    for d in range(300):
        words = prose(rnd, rnd.randrange(50, 400))
        if d % 3 == 0:
            item, copy = rnd.choice(items) if d % 2 else items[0]  # one item in very many documents
            copy = [f"x{rnd.randrange(99)}" if k % 8 == 5 else w for k, w in enumerate(copy)] if d % 4 == 1 else list(copy)
            if d % 4 == 3:
                del copy[7]
                copy.insert(15, "inserted")
            at = rnd.randrange(len(words))
            words[at:at] = [w.upper() + "," for w in copy] if d % 5 == 0 else copy
            want.add((d, item))
        docs.append((d, " ".join(words)))
    return [(i, " ".join(w) + ".") for i, w in items], docs, want


def test_finds_copies_and_leaves_the_rest(spark, documents, leaks):
    items, docs, want = leaks
    table = spark.createDataFrame(items, "item_id bigint, text string")
    got = contaminated_passages(documents(docs), table).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    text = dict(docs)
    for r in got:
        part = text[r.doc_id].encode()[r.start_byte:r.end_byte].decode()
        assert 0.5 <= r.score <= 1 and abs(len(part.split()) - len(dict(items)[r.item_id].split())) <= 2
    kept = drop_contaminated(documents(docs), table)
    assert kept.columns == documents(docs).columns
    assert {r.doc_id for r in kept.collect()} == set(text) - {d for d, _ in want}


def test_blocks_of_items_change_nothing(spark, documents, leaks, monkeypatch):
    items, docs, want = leaks
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 300)
    table = spark.createDataFrame(items, "item_id bigint, text string")
    assert {(r.doc_id, r.item_id) for r in contaminated_passages(documents(docs), table).collect()} == want


@pytest.mark.parametrize("size, edits", [(20, 3), (50, 8), (40, 8), (40, 6), (40, 10), (60, 15)])
@pytest.mark.parametrize("often", [False, True])
def test_finds_copies_with_spread_substitutions(spark, documents, size, edits, often):
    """15 to 25 % of the words replaced, and no unedited copy in the corpus; also where a third of the documents hold the edited one."""
    rnd = random.Random(size + edits)
    item = [f"q{i}" for i in range(size)]
    copy = list(item)
    for k in range(edits):
        copy[(2 * k + 1) * size // (2 * edits)] = f"x{k}"
    docs = []
    for d in range(60):
        words = prose(rnd, 80)
        if d % 3 == 0 if often else d == 7:
            at = rnd.randrange(len(words))
            words[at:at] = copy
        docs.append((d, " ".join(words)))
    got = contaminated_passages(documents(docs), spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")).collect()
    assert sorted(r.doc_id for r in got) == ([d for d in range(60) if d % 3 == 0] if often else [7])
    # Edits at the ends may leave the copy's last words out.
    assert all(1 - 1.5 * edits / size <= r.score <= 1 - 1.5 * (edits - 2) / size for r in got)


def test_each_copy_is_one_passage(documents, spark):
    """Frequent seeds between and around two copies neither join nor repeat them."""
    item = "one two three of the kind four five six seven eight of the kind nine ten".split()
    words = ["of", "the", "kind"] * 5 + item + ["of", "the", "kind"] * 4 + item + ["end"]
    got = contaminated_passages(documents([(1, " ".join(words))]), spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")).collect()
    assert len(got) == 2 and all(r.score == 1 for r in got)


def test_alignment_equals_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(60):
        a, b = (rng.integers(0, 6, rng.integers(1, 25)).astype(np.uint64) for _ in range(2))
        assert alignment(a, b)[0] == pytest.approx(smith_waterman(a.tolist(), b.tolist()))


def test_decontamination_odd_rows(spark, documents, odd_rows):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "..."), (None, odd_rows[5][1]), (4, "same text of seven words for ties"), (4, "same text of seven words for ties")],
                                  "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in contaminated_passages(documents(odd_rows), items).collect()}
    assert got == {(4, None), (5, None), (6, 4), (7, 4), (11, 4)}
    empty = spark.createDataFrame([], "item_id bigint, text string")
    assert contaminated_passages(documents(odd_rows), empty).collect() == []
    assert contaminated_passages(documents([]), items).collect() == []
    assert drop_contaminated(documents(odd_rows), empty).count() == len(odd_rows)


URLS = [
    ("http://Sub.Example.NET/en/7817?utm=1", "sub.example.net", "/en/7817", "example.net/en/", "allow"),
    ("https://a.example.net/de/1", "a.example.net", "/de/1", "net/", "block"),
    ("http://example.com/de/x#top", "example.com", "/de/x", "example.com/de/", "block"),
    ("http://notexample.com/de/x", "notexample.com", "/de/x", None, None),
    ("ftp://x.org/fr/", "x.org", "/fr/", "org/fr/", "allow"),
    ("http://x.org/fr", "x.org", "/fr", None, None),
    ("http://x.net", "x.net", "", None, None),
    ("http://x.net?a=/b", "x.net", "", None, None),
    ("http://É.Net/x", "É.net", "/x", "net/", "block"),
    ("http://host://x/y", "host:", "//x/y", None, None),
    ("no scheme/x", "", "", None, None), ("", "", "", None, None), (None, "", "", None, None),
    ("://net/", "net", "/", "net/", "block"), ("http:///p", "", "/p", None, None),
]


def test_url_parts_and_rules(spark):
    df = spark.createDataFrame([(i, u, "x", None) for i, (u, *_) in enumerate(URLS)], "page_id bigint, url string, host string, rule string")
    got = {r.page_id: r for r in judge_urls(df, URL_RULES).collect()}
    assert len(got) == len(URLS)
    for i, (_, host, path, rule, verdict) in enumerate(URLS):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == verdict if rule else got[i].verdict in ("allow", "block")
    assert judge_urls(df.limit(0), URL_RULES).collect() == []


def slow_templates(rows):
    """{(host, segments): (template, share)} of rows (host, segments, label), by plain loops."""
    import collections

    paths = collections.defaultdict(lambda: [0, 0, 0])
    for host, seg, label in rows:
        p = paths[host, seg]
        p[0] += 1
        p[1] += label is not None
        p[2] += label or 0
    template = {k: k[1] for k in paths}
    for level in range(url_templates.LEVELS):
        child = collections.defaultdict(lambda: np.zeros(5))
        for k, (n, l, b) in paths.items():
            t = template[k]
            if len(t) > level:
                below = len(t) - level - 1
                child["/".join([k[0], *t[:level]]), t[level]] += [n, l, b, below * n, below * below * n]
        total = collections.defaultdict(lambda: np.zeros(6))
        for (parent, _), v in child.items():
            total[parent] += [1, *v]
        for k in paths:
            t = template[k]
            if len(t) <= level:
                continue
            parent = "/".join([k[0], *t[:level]])
            m, n, l, b, d, d2 = total[parent]
            cn, cl, cb, cd, _ = child[parent, t[level]]
            share = (b + 1) / (l + 2)
            gap = abs(cb / cl - share) / np.sqrt(share * (1 - share) / cl) if cl else 0
            spread = np.sqrt(max(d2 / n - (d / n) ** 2, 0) + 0.05)
            deep = abs(cd / cn - d / n) / (spread / np.sqrt(cn))
            if m > 1 and gap <= url_templates.ALIKE and deep <= url_templates.ALIKE:
                template[k] = (*t[:level], "*", *t[level + 1:])
    n_all, b_all = sum(v[1] for v in paths.values()), sum(v[2] for v in paths.values())
    nodes = collections.defaultdict(lambda: np.zeros(2))

    def way(host, t):
        return [(0, "." + ".".join(host.split(".")[-2:]))] + [(k + 1, "/".join([host, *t[:k]])) for k in range(len(t) + 1)]

    for (host, seg), (_, l, b) in paths.items():
        for node in way(host, template[host, seg]):
            nodes[node] += [l, b]
    out = {}
    for host, seg in paths:
        share = (b_all + 1) / (n_all + 2)
        for node in way(host, template[host, seg]):
            l, b = nodes[node]
            share = (b + url_templates.SMOOTHING * share) / (l + url_templates.SMOOTHING)
        out[host, seg] = (template[host, seg], share)
    return out


def test_templates_equal_brute_force(spark):
    rnd = random.Random(9)
    rows = []
    for _ in range(1500):
        host = rnd.choice(["big.com"] * 5 + ["a.org", "b.a.org", ""])
        first = rnd.choice(["news", "spam", "shop", "blog", "user"])
        seg = (first, *[rnd.choice(["{n}", "x", "y", "z", "{n}.html"]) for _ in range(rnd.choice([0, 1, 1, 2, 5]))])
        label = rnd.choice([None, int(first == "spam" or rnd.random() < 0.1)])
        rows.append((host, list(seg), label))
    got = url_templates.path_templates(spark.createDataFrame(rows, "host string, segments array<string>, label int")).collect()
    want = slow_templates([(h, tuple(s), l) for h, s, l in rows])
    assert len(got) == len(want)
    for r in got:
        template, share = want[r.host, tuple(r.segments)]
        assert tuple(r.template) == template and r.blocked_share == pytest.approx(share)
    assert any("*" in r.template for r in got) and any("spam" in r.template for r in got)


def test_no_python_in_the_url_plan(spark):
    df = spark.createDataFrame([(1, "http://x.net/a/1")], "page_id bigint, url string")
    plan = judge_urls(df, URL_RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
