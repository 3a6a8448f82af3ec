"""Classifiers, language identification and language-model scores."""

import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from corpusloom.llm import masked_lm, mil_quality, subword_toxicity
from corpusloom.llm.byte_words import text_buffer
from corpusloom.llm.cross_parsing import SYMBOLS, compact, count_phrases, identify_language, learn_languages, suffix_automaton, symbols
from corpusloom.llm.labelled import labelled_sample
from corpusloom.llm.masked_lm import learn_language_model, score_language_model
from corpusloom.llm.mil_quality import fit, keep_good, learn_quality, score_quality
from corpusloom.llm.queries import QUERIES
from corpusloom.llm.subword_toxicity import learn_toxicity, score_toxicity
from tests.llm.brute import cross_parse

SYLLABLES = ["ta", "ri", "no", "lem", "su", "kar", "po", "den", "vi", "gro"]


def prose(rnd, n, extra=()):
    words = ["".join(rnd.choice(SYLLABLES) for _ in range(rnd.randrange(1, 4))) for _ in range(n)]
    for w in extra:
        words[rnd.randrange(n)] = w
    return " ".join(words)


@pytest.fixture(scope="module")
def labelled(spark, documents):
    rnd = random.Random(3)
    bad = ["blockhead", "nitwit", "dimwit"]
    rows, labels = [], []
    for i in range(400):
        toxic, good = i % 3 == 0, i % 4 != 0
        n = rnd.randrange(40, 300)
        text = prose(rnd, n, [rnd.choice(bad) for _ in range(max(1, n // 40))] if toxic else ())
        if not good:
            text = " ".join(w + "$$$" for w in text.split())
        rows.append((i, text))
        labels.append((i, int(good), int(toxic)))
    labels += [(5, None, None), (None, 1, 1), (6, 1, 0), (7, 9, 9)]
    return rows, documents(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def held_accuracy(df, truth):
    rows = [r for r in df.collect() if r.held_out]
    assert len(rows) > 40 and all(0 <= r.score <= 1 for r in rows)
    return np.mean([r.predicted == truth(r.doc_id) for r in rows])


def test_quality_held_out(labelled):
    _, docs, labels = labelled
    model = learn_quality(docs, labels)
    assert held_accuracy(score_quality(docs, model), lambda i: int(i % 4 != 0)) > 0.97
    kept = keep_good(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in score_quality(docs, model).collect() if r.predicted}


def test_toxicity_held_out_and_unseen_spelling(labelled, documents):
    _, docs, labels = labelled
    model = learn_toxicity(docs, labels)
    assert held_accuracy(score_toxicity(docs, model), lambda i: int(i % 3 == 0)) > 0.95
    rnd = random.Random(5)
    pairs = [(2 * i + k, prose(rnd, 60, ["blockheadd", "nittwit", "dimwitt"] if k else ())) for i in range(20) for k in (0, 1)]
    score = {r.doc_id: r.score for r in score_toxicity(documents(pairs), model).collect()}
    assert np.mean([score[2 * i + 1] > score[2 * i] for i in range(20)]) > 0.9


def test_toxicity_of_few_documents_without_common_ngrams(documents, spark):
    docs = documents([(i, f"word{i} other{i}") for i in range(6)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(6)], "doc_id bigint, toxic int")
    scores = score_toxicity(docs, learn_toxicity(docs, labels)).collect()
    assert len(scores) == 6 and all(0 < r.score < 1 for r in scores)


def test_attention_gradient_is_right():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(12, 5))
    owner, y = np.repeat([0, 1, 2], [3, 5, 4]), np.array([1.0, 0.0, 1.0])
    m = {"mean": np.zeros(5), "scale": np.ones(5), "W": rng.normal(size=(5, 4)), "b": rng.normal(size=4), "V": rng.normal(size=(4, 3)),
         "U": rng.normal(size=(4, 3)), "w": rng.normal(size=3), "c": rng.normal(size=4), "d": np.array([0.3])}

    def loss():
        p = mil_quality.predict(m, x, owner)
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    grad = mil_quality._gradient(m, x, owner, y)
    for k, g in grad.items():
        at = tuple(rng.integers(0, s) for s in m[k].shape)
        old = m[k][at]
        m[k][at] = old + 1e-6
        up = loss()
        m[k][at] = old - 1e-6
        down = loss()
        m[k][at] = old
        assert abs((up - down) / 2e-6 - g[at]) < 1e-5, k


def test_no_labels_or_one_class(spark, documents):
    docs = documents([(1, "a b c"), (2, None)])
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    one = spark.createDataFrame([(1, 1, 1), (2, 1, 1)], "doc_id bigint, quality int, toxic int")
    assert {r.score for r in score_quality(docs, learn_quality(docs, none)).collect()} == {0.5}
    assert {r.score for r in score_toxicity(docs, learn_toxicity(docs, none)).collect()} == {0.0}
    assert {r.predicted for r in score_quality(docs, learn_quality(docs, one)).collect()} == {1}
    assert fit(np.zeros((0, 3)), np.zeros(0, int), np.zeros(0))["constant"] == 0.5


def test_sample_leaves_held_out_rows_out(labelled):
    import zlib

    _, docs, labels = labelled
    ids = [r.doc_id for r in labelled_sample(docs, labels, "quality", 50, 5, 0).collect()]
    assert len(ids) == len(set(ids)) == 50 and all(zlib.crc32(str(i).encode()) % 5 for i in ids) and 7 not in ids


def test_subwords_equal_plain_ngrams():
    text = "Ab  cde\tf"
    at, raw = text_buffer(pa.array([text, ""]))
    bucket, owner = subword_toxicity.subwords(at, raw)
    want = sum(max(0, len(f"<{w}>") - k + 1) for w in text.split() for k in subword_toxicity.GRAMS)
    assert len(bucket) == want and set(owner.tolist()) == {0}
    same = subword_toxicity.subwords(*text_buffer(pa.array(["f cde ab"])))[0]
    assert sorted(bucket.tolist()) == sorted(same.tolist())


@pytest.mark.parametrize("seed", range(4))
def test_phrases_equal_brute_force(seed):
    rnd = random.Random(seed)
    corpus = bytes(rnd.choice(b"abcdA \xc3\xa9") for _ in range(150))
    blocks = [bytes(rnd.choice(b"abcde x\xc3\xa9!") for _ in range(n)) for n in (60, 33, 33, 5, 1)]
    own = symbols(np.frombuffer(corpus, np.uint8))
    used = np.unique(own).astype(np.int64)
    table = compact(suffix_automaton(own), used)
    place = np.full(SYMBOLS, len(used), np.int32)
    place[used] = np.arange(len(used))
    size = np.array([len(b) for b in blocks])
    text = place[symbols(np.frombuffer(b"".join(blocks), np.uint8))]
    got = count_phrases(table, text, np.cumsum(size) - size, size)
    assert got.tolist() == [cross_parse(own.tolist(), symbols(np.frombuffer(b, np.uint8)).tolist()) for b in blocks]


def test_languages(documents):
    rnd = random.Random(2)
    parts = {"xx": ["tion", "ing", "the", "er"], "yy": ["ció", "ñar", "que", "os"], "zz": ["sch", "ung", "keit", "ü"]}
    rows = [(i, " ".join("".join(rnd.choice(p) for _ in range(3)) for _ in range(80)), lang) for i in range(240) for lang, p in [rnd.choice(list(parts.items()))]]
    rows += [(900, None, "xx"), (901, "", "xx"), (902, "123 !!! ...", "xx"), (903, rows[0][1], None), (None, rows[0][1], "yy")]
    docs = documents(rows)
    got = identify_language(docs, learn_languages(docs)).collect()
    lang = {r[0]: r[2] for r in rows}
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 900]
    assert len(held) > 40 and all(r.lang_pred == lang[r.doc_id] and 0.5 <= r.score <= 1 for r in held)
    by_id = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert by_id[900] == by_id[901] == by_id[902] == ("und", 0.0)
    assert by_id[903] == by_id[None] == by_id[0]


def test_no_language(documents):
    docs = documents([(1, "some text", None)])
    assert [(r.lang_pred, r.score) for r in identify_language(docs, learn_languages(docs)).collect()] == [("und", 0.0)]


def test_language_model_orders_texts(documents):
    rnd = random.Random(4)
    rows = [(i, " ".join(f"w{(i + k) % 7}" for k in range(200))) for i in range(60)]
    shuffled = [(1000 + i, " ".join(rnd.sample(t.split(), 200))) for i, t in rows]
    docs = documents(rows)
    model = learn_language_model(docs)
    good = {r.doc_id: r for r in score_language_model(docs, model).collect()}
    bad = {r.doc_id: r for r in score_language_model(documents(shuffled), model).collect()}
    assert min(r.score for r in good.values()) > max(r.score for r in bad.values())
    assert all(abs(r.score * r.n_words - r.log_likelihood) < 1e-6 and r.n_words == 200 for r in good.values())


def test_language_model_equals_plain_sums(documents):
    texts = ["one two three", "two two", "x", None, ""]
    docs = documents(list(enumerate(texts)))
    model = learn_language_model(docs)
    vocab, net = model["vocabulary"], model["network"]
    for r in score_language_model(docs, model).collect():
        slot, _ = masked_lm.slots(*text_buffer(pa.array([texts[r.doc_id]])))
        want = 0.0
        for t in range(len(slot)):
            z = net["b"].astype(float).copy()
            for j, d in enumerate(masked_lm.WINDOW):
                z += net["E"][j][vocab["context"][slot[t + d]] if 0 <= t + d < len(slot) else masked_lm.NOTHING]
            logit = np.tanh(z) @ net["W"] + net["c"]
            want += logit[vocab["class"][slot[t]]] - np.log(np.exp(logit).sum()) + vocab["log_within"][slot[t]]
        assert abs(want - r.log_likelihood) < 1e-3 and r.n_words == len(slot)


def test_every_position_is_trained_on():
    batches = [pa.RecordBatch.from_arrays([pa.array(texts)], ["text"]) for texts in (["one two three", "two two", None, ""], ["x"])]
    vocab = masked_lm.vocabulary(np.ones(masked_lm.SLOTS, np.int64))
    (learnt,) = masked_lm._train(SimpleNamespace(value=vocab))(iter(batches))
    assert set(learnt.column("weight").to_pylist()) == {6.0}


def test_class_probabilities_add_up():
    rng = np.random.default_rng(0)
    vocab = masked_lm.vocabulary(rng.poisson(0.2, masked_lm.SLOTS))
    assert abs(np.bincount(vocab["class"], weights=np.exp(vocab["log_within"]), minlength=masked_lm.CLASSES) - 1).max() < 1e-3


@pytest.mark.parametrize("name", ["op2_toxicity", "op9_quality_classifier", "op10_language_id"])
def test_held_out_accuracy_on_the_tables(spark, name):
    sf = "/root/testdata/sf0.01"
    column = {"op2_toxicity": "toxic", "op9_quality_classifier": "quality"}.get(name)
    truth = "labels" if column else "documents"
    got = QUERIES[name](spark, sf).join(spark.read.parquet(f"{sf}/{truth}.parquet"), "doc_id").filter("held_out").collect()
    right = [r.predicted == r[column] if column else r.lang_pred == r.lang for r in got]
    # Some labels of toxicity contradict their texts.
    assert len(right) > 50 and np.mean(right) > (0.88 if column == "toxic" else 0.93)


def test_odd_rows_and_empty_tables(documents, odd_rows, labelled):
    _, docs, labels = labelled
    odd = documents(odd_rows)
    quality, toxicity, language = learn_quality(docs, labels), learn_toxicity(docs, labels), learn_languages(docs)
    runs = [lambda d: score_quality(d, quality), lambda d: score_toxicity(d, toxicity), lambda d: identify_language(d, language),
            lambda d: score_language_model(d, learn_language_model(d))]
    for run in runs:
        got = run(odd).collect()
        assert sorted(map(str, (r.doc_id for r in got))) == sorted(map(str, (r[0] for r in odd_rows)))
        assert len({tuple(r)[1:] for r in got if r.doc_id in (6, 7)} | {None}) <= 3
        assert run(documents([])).collect() == []
