"""Quality by attention-based multiple-instance learning.

A document is a bag of passages and only the document has a label. Every passage is encoded by a
small tanh layer; gated attention (Ilse et al., 2018) learns which passages decide; the weighted
passage representation is scored by a logistic unit. All is trained together, in numpy, on a
bounded sample; every passage of every document is scored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.byte_words import WordHasher, cut_long, text_buffer, text_groups
from corpusloom.llm.labelled import held_out, labelled_sample

PASSAGE_WORDS = 64
WORD_BUCKETS = 64
HIDDEN, ATTENTION = 24, 12
# Bounds of the training sample: documents, and passages of one of them (spread evenly).
SAMPLE_DOCS, SAMPLE_PASSAGES = 6000, 48
EPOCHS, BATCH, RATE = 30, 128, 0.01
FOLDS, FOLD = 5, 0
THRESHOLD = 0.3

# Byte classes: lower, upper, digit, each ASCII sign by itself, white space, beyond ASCII.
_CLASS = np.full(256, 3, np.int64)
_CLASS[128:] = 4
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_SIGNS = [b for b in range(33, 127) if not chr(b).isalnum()]
_CLASS[_SIGNS] = 5 + np.arange(len(_SIGNS))
_N_CLASSES = 5 + len(_SIGNS)
_N_STATS = 6
FEATURES = _N_CLASSES + _N_STATS + WORD_BUCKETS
_HASHER = WordHasher(31)


def passages(at: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features, text of each passage) of consecutive texts; a text without words is one passage of zeros.

    Passages have ``PASSAGE_WORDS`` words; in texts beyond a megabyte they start afresh with each slice.
    """
    at, owner = cut_long(at, raw)
    parts = [(x, owner[a + own]) for a, b in text_groups(at) for x, own in [_features(at[a:b + 1], raw)]]
    if not parts:
        return np.zeros((0, FEATURES), np.float32), np.zeros(0, np.int64)
    return tuple(np.concatenate(v) for v in zip(*parts))


def _features(at: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(at) - 1
    h, start, end, text = _HASHER.words(at, raw)
    words = np.bincount(text, minlength=n)
    count = np.maximum(1, -(-words // PASSAGE_WORDS))
    base = np.concatenate([[0], np.cumsum(count)])
    total = int(base[-1])
    x = np.zeros((total, FEATURES), np.float32)
    owner = np.repeat(np.arange(n), count)
    if not len(h):
        return x, owner
    head = np.concatenate([[0], np.cumsum(words)])[text]
    passage = base[text] + (np.arange(len(h)) - head) // PASSAGE_WORDS
    size = end - start
    place = np.repeat(passage, size)
    before = np.cumsum(size) - size
    byte = raw[np.arange(int(size.sum())) + np.repeat(start - before, size)]
    letters = np.bincount(place * _N_CLASSES + _CLASS[byte], minlength=total * _N_CLASSES).reshape(total, _N_CLASSES)
    n_bytes = np.maximum(1, letters.sum(1))
    n_words = np.bincount(passage, minlength=total)
    some = np.maximum(1, n_words)
    x[:, :_N_CLASSES] = np.sqrt(letters / n_bytes[:, None])
    order = np.lexsort((h, passage))
    hs, ps = h[order], passage[order]
    new = np.ones(len(hs), bool)
    new[1:] = (hs[1:] != hs[:-1]) | (ps[1:] != ps[:-1])
    runs = np.diff(np.append(np.flatnonzero(new), len(hs)))
    most = np.zeros(total)
    np.maximum.at(most, ps[new], runs)
    last = raw[end - 1]
    stats = x[:, _N_CLASSES:_N_CLASSES + _N_STATS]
    stats[:, 0] = np.bincount(ps[new], minlength=total) / some
    stats[:, 1] = most / some
    stats[:, 2] = np.log1p(np.bincount(passage, weights=size, minlength=total) / some) / 3
    stats[:, 3] = np.bincount(passage, weights=_CLASS[last] >= 5, minlength=total) / some
    stats[:, 4] = np.bincount(passage, weights=_CLASS[raw[start]] == 1, minlength=total) / some
    stats[:, 5] = n_words / PASSAGE_WORDS
    bag = np.bincount(passage * WORD_BUCKETS + (h % np.uint64(WORD_BUCKETS)).astype(np.int64), minlength=total * WORD_BUCKETS)
    x[:, _N_CLASSES + _N_STATS:] = np.sqrt(bag.reshape(total, WORD_BUCKETS) / some[:, None])
    return x, owner


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _forward(m: dict, x: np.ndarray, owner: np.ndarray):
    """Passages of one document must follow each other."""
    heads = np.flatnonzero(np.diff(owner, prepend=-1))
    seg = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(owner))))
    z = np.tanh((x - m["mean"]) / m["scale"] @ m["W"] + m["b"])
    v, u = np.tanh(z @ m["V"]), _sigmoid(z @ m["U"])
    e = (v * u) @ m["w"]
    e = np.exp(e - np.maximum.reduceat(e, heads)[seg])
    a = e / np.add.reduceat(e, heads)[seg]
    bag = np.add.reduceat(a[:, None] * z, heads)
    return heads, seg, z, v, u, a, bag, bag @ m["c"] + m["d"][0]


def predict(m: dict, x: np.ndarray, owner: np.ndarray) -> np.ndarray:
    if "constant" in m:
        return np.full(len(np.unique(owner)), m["constant"])
    return _sigmoid(_forward(m, x, owner)[-1])


def _gradient(m: dict, x, owner, y):
    heads, seg, z, v, u, a, bag, logit = _forward(m, x, owner)
    g = (_sigmoid(logit) - y) / len(y)
    xs = (x - m["mean"]) / m["scale"]
    d_bag = g[:, None] * m["c"]
    d_a = (d_bag[seg] * z).sum(1)
    d_e = a * (d_a - np.add.reduceat(a * d_a, heads)[seg])
    d_gate = d_e[:, None] * m["w"]
    d_v, d_u = d_gate * u * (1 - v * v), d_gate * v * u * (1 - u)
    d_z = (a[:, None] * d_bag[seg] + d_v @ m["V"].T + d_u @ m["U"].T) * (1 - z * z)
    return {
        "W": xs.T @ d_z, "b": d_z.sum(0), "V": z.T @ d_v, "U": z.T @ d_u, "w": (v * u).T @ d_e,
        "c": bag.T @ g, "d": np.array([g.sum()]),
    }


def fit(x: np.ndarray, owner: np.ndarray, y: np.ndarray, seed: int = 0) -> dict:
    """Train on passages ``x`` of documents ``owner`` (0..n-1 in order) with labels ``y``."""
    if len(y) == 0 or y.min() == y.max():  # nothing to tell apart
        return {"constant": float(y.mean()) if len(y) else 0.5}
    rng = np.random.default_rng(seed)
    f = x.shape[1]
    m = {
        "mean": x.mean(0), "scale": x.std(0) + 0.05,
        "W": rng.normal(0, 1 / np.sqrt(f), (f, HIDDEN)), "b": np.zeros(HIDDEN),
        "V": rng.normal(0, 0.3, (HIDDEN, ATTENTION)), "U": rng.normal(0, 0.3, (HIDDEN, ATTENTION)),
        "w": rng.normal(0, 0.3, ATTENTION), "c": rng.normal(0, 0.3, HIDDEN), "d": np.array([np.log(y.mean() / (1 - y.mean()))]),
    }
    m = {k: v.astype(np.float32) for k, v in m.items()}
    learned = [k for k in m if k not in ("mean", "scale")]
    mo, ve = ({k: np.zeros_like(m[k]) for k in learned} for _ in range(2))
    edges = np.searchsorted(owner, np.arange(len(y) + 1))
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(y))
        rate = RATE * 0.5 * (1 + np.cos(np.pi * epoch / EPOCHS))
        for i in range(0, len(y), BATCH):
            docs = order[i:i + BATCH]
            rows = np.concatenate([np.arange(edges[d], edges[d + 1]) for d in docs])
            own = np.repeat(np.arange(len(docs)), edges[docs + 1] - edges[docs])
            grad = _gradient(m, x[rows], own, y[docs].astype(np.float32))
            step += 1
            for k in learned:  # Adam with decoupled decay
                mo[k] = 0.9 * mo[k] + 0.1 * grad[k]
                ve[k] = 0.999 * ve[k] + 0.001 * grad[k] ** 2
                move = mo[k] / (1 - 0.9 ** step) / (np.sqrt(ve[k] / (1 - 0.999 ** step)) + 1e-8)
                m[k] = (m[k] - rate * (move + 1e-3 * m[k])).astype(np.float32)
    return m


def _scores(m: dict, column: pa.Array) -> np.ndarray:
    at, raw = text_buffer(column)
    parts = [predict(m, *passages(at[a:b + 1], raw)) for a, b in text_groups(at)]
    return np.concatenate(parts).astype(np.float64) if parts else np.zeros(0)


def _sample_features(batches):
    for batch in batches:
        at, raw = text_buffer(batch.column("text"))
        rows, lists = [], []
        for a, b in text_groups(at):
            x, owner = passages(at[a:b + 1], raw)
            edges = np.searchsorted(owner, np.arange(b - a + 1))
            for i in range(b - a):
                n = edges[i + 1] - edges[i]
                take = edges[i] + (np.arange(n) if n <= SAMPLE_PASSAGES else np.arange(SAMPLE_PASSAGES) * n // SAMPLE_PASSAGES)
                rows.append(a + i)
                lists.append(x[take].astype(np.float16).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(c).take(pa.array(rows, pa.int64())) for c in ("doc_id", "label")] + [pa.array(lists, pa.binary())],
            ["doc_id", "label", "features"],
        )


def learn_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS, fold: int = FOLD,
                  id_col: str = "doc_id", text_col: str = "text") -> dict:
    """The model, from at most ``SAMPLE_DOCS`` labelled documents that are not held out.

    Without labels it is the constant 0.5, with a single class that class.
    """
    sample = labelled_sample(docs, labels, label, SAMPLE_DOCS, folds, fold, id_col, text_col)
    got = sample.mapInArrow(_sample_features, "doc_id bigint, label int, features binary").toArrow()
    got = got.sort_by([("doc_id", "ascending")])
    x = [np.frombuffer(v, np.float16).reshape(-1, FEATURES) for v in got["features"].to_pylist()]
    y = got["label"].to_numpy().astype(np.int64)
    if not x:
        return fit(np.zeros((0, FEATURES), np.float32), np.zeros(0, np.int64), y)
    return fit(np.concatenate(x).astype(np.float32), np.repeat(np.arange(len(x)), [len(v) for v in x]), y)


def score_quality(docs: DataFrame, model: dict, threshold: float = THRESHOLD, folds: int = FOLDS, fold: int = FOLD,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, from its whole text alone.

    - NULL, empty and blank texts are a bag of one passage without words, and get that bag's score.
    - NULL and repeated ids are kept; equal texts get equal scores. An empty table gives no rows.
    - Other columns, whatever their names, are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_scores(sent.value, batch.column("text")))], ["doc_id", "score"])

    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, "doc_id bigint, score double").select(
        "doc_id", held_out("doc_id", folds, fold).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, model: dict, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score reaches the threshold. No shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            score = _scores(sent.value, batch.column(text_col))
            yield batch.filter(pa.array(score >= threshold))

    return docs.mapInArrow(run, docs.schema)
