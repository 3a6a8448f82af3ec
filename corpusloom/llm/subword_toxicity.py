"""Toxicity by a bag of subword embeddings, averaged into a linear softmax and trained jointly in numpy.

The features of a text are the byte n-grams of its words with their boundaries marked, hashed into
a table of embeddings, so a misspelling that was never seen shares most of its vectors with the
word that was. The two-class softmax of the averaged vector depends on the difference of its two rows only,
so scoring needs one number per bucket: the product of embedding and that difference.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.byte_words import WHITE_SPACE, cut_long, mix, text_buffer, text_groups
from corpusloom.llm.labelled import held_out, labelled_sample

GRAMS = (3, 4, 5, 6)
BUCKETS = 1 << 18
DIMENSIONS = 8
# Bounds of the training sample: documents, and different n-grams of one of them (the smallest hashes).
SAMPLE_DOCS, SAMPLE_GRAMS = 6000, 1 << 13
EPOCHS, RATE, DECAY = 60, 0.1, 10.0
# N-grams of fewer training documents teach nothing.
LEAST_DOCS = 8
# The average is scaled before the softmax, because a handful of words among many decide.
SCALE = 200.0
# Entries (document and n-gram) that training works on at once, those of one document aside.
STEP_ENTRIES = 1 << 19
# N-grams that the average of a short text is shrunk by.
SHRINK = 100
BALANCE = 0.5
FOLDS, FOLD = 5, 0
THRESHOLD = 0.5

_EDGE = np.zeros(256, bool)
_EDGE[list(WHITE_SPACE)] = True
_CODES = mix(np.arange(256, dtype=np.uint64), 41)
_CODES[65:91] = _CODES[97:123]
_CODES[_EDGE] = _CODES[32]


def subwords(at: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of all n-grams of consecutive texts, A-Z lower-cased, white space as the word boundary."""
    n = len(at) - 1
    sizes = np.diff(at)
    # Each text gets a boundary on either side.
    padded = np.full(int(sizes.sum()) + 2 * n, 32, np.uint8)
    text = np.repeat(np.arange(n), sizes + 2)
    inner = np.arange(int(sizes.sum())) + np.repeat(2 * np.arange(n) + 1, sizes)
    padded[inner] = raw[at[0]:at[-1]]
    edge = _EDGE[padded]
    code = _CODES[padded]
    before = np.concatenate([[0], np.cumsum(edge)])
    buckets, owners = [], []
    rolled = np.zeros(len(padded), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(max(GRAMS)):
            m = len(padded) - k
            if m <= 0:
                break
            rolled = rolled[:m] * np.uint64(0x9E3779B97F4A7C15 | 1) + code[k:]
            if k + 1 in GRAMS:
                # No boundary strictly inside, and not two boundaries alone.
                keep = np.flatnonzero(before[k:k + m] == before[1:1 + m])
                buckets.append((mix(rolled[keep], k) % np.uint64(BUCKETS)).astype(np.int64))
                owners.append(text[keep])
    return (np.concatenate(buckets), np.concatenate(owners)) if buckets else (np.zeros(0, np.int64),) * 2


def fit(bucket: np.ndarray, doc: np.ndarray, weight: np.ndarray, y: np.ndarray, seed: int = 0) -> dict:
    """Embeddings and softmax rows, trained together by Adam on the whole sample.

    ``weight`` is the share of a bucket in its document.
    """
    if len(y) == 0 or y.min() == y.max():
        return {"constant": float(y.mean()) if len(y) else 0.0}
    rng = np.random.default_rng(seed)
    seen = np.bincount(bucket, minlength=BUCKETS) > 0
    used, place = np.flatnonzero(seen), (np.cumsum(seen) - 1).astype(np.int32)[bucket]
    table = rng.normal(0, 0.1, (len(used), DIMENSIONS)).astype(np.float32)
    rows = rng.normal(0, 0.1, (2, DIMENSIONS)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    # Between equal weights of documents and of classes.
    each = np.where(y == 1, (y == 1).mean() ** -BALANCE, (y == 0).mean() ** -BALANCE)
    each = each / each.sum()
    # Ranges of entries and their documents, so that what a step works on stays small.
    cuts = np.unique(np.append(np.searchsorted(doc, doc[::STEP_ENTRIES]), len(doc)))
    ranges = [(a, b, doc[a], doc[b - 1] + 1) for a, b in zip(cuts[:-1], cuts[1:])]
    m = [np.zeros_like(a) for a in (table, rows, bias)]
    v = [np.zeros_like(a) for a in (table, rows, bias)]
    for step in range(1, EPOCHS + 1):
        value = table @ (rows[1] - rows[0])
        logit = np.zeros(len(y))
        for a, b, first, last in ranges:
            logit[first:last] = np.bincount(doc[a:b] - first, weights=weight[a:b] * value[place[a:b]], minlength=last - first)
        p = 1 / (1 + np.exp(-np.clip(logit * SCALE + bias[1] - bias[0], -30, 30)))
        g = (p - y) * each
        pull = np.zeros(len(used))
        for a, b, _, _ in ranges:
            pull += np.bincount(place[a:b], weights=weight[a:b] * g[doc[a:b]], minlength=len(used))
        pull = pull.astype(np.float32) * SCALE
        d_rows = table.T @ pull
        grads = (
            pull[:, None] * (rows[1] - rows[0]) + DECAY / max(1, len(used)) * table,
            np.stack([-d_rows, d_rows]), np.array([-g.sum(), g.sum()], np.float32),
        )
        for i, (a, d) in enumerate(zip((table, rows, bias), grads)):
            m[i] = 0.9 * m[i] + 0.1 * d
            v[i] = 0.99 * v[i] + 0.01 * d * d
            a -= RATE * m[i] / (1 - 0.9 ** step) / (np.sqrt(v[i] / (1 - 0.99 ** step)) + 1e-7)
    values = np.zeros(BUCKETS, np.float32)
    values[used] = table @ (rows[1] - rows[0])
    return {"values": values, "bias": float(bias[1] - bias[0])}


def predict(model: dict, at: np.ndarray, raw: np.ndarray) -> np.ndarray:
    n = len(at) - 1
    if "constant" in model:
        return np.full(n, model["constant"])
    at, owner = cut_long(at, raw)
    total, count = np.zeros(n), np.zeros(n)
    for a, b in text_groups(at):
        bucket, text = subwords(at[a:b + 1], raw)
        total += np.bincount(owner[a + text], weights=model["values"][bucket], minlength=n)
        count += np.bincount(owner[a + text], minlength=n)
    mean = total / (count + SHRINK)
    return 1 / (1 + np.exp(-np.clip(mean * SCALE + model["bias"], -30, 30)))


def _sample_grams(batches):
    for batch in batches:
        at, raw = text_buffer(batch.column("text"))
        grams, shares = [], []
        for i in range(batch.num_rows):
            count = np.zeros(BUCKETS, np.int64)
            pieces, _ = cut_long(at[i:i + 2], raw)
            for a, b in text_groups(pieces):
                count += np.bincount(subwords(pieces[a:b + 1], raw)[0], minlength=BUCKETS)
            found = np.flatnonzero(count)
            share = count[found] / (count.sum() + SHRINK)
            if len(found) > SAMPLE_GRAMS:
                keep = np.argsort(mix(found.astype(np.uint64)))[:SAMPLE_GRAMS]
                found, share = found[keep], share[keep]
            grams.append(found.astype(np.int32).tobytes())
            shares.append(share.astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), pa.array(grams, pa.binary()), pa.array(shares, pa.binary())],
            ["doc_id", "label", "grams", "shares"],
        )


def _training_arrays(got: pa.Table) -> tuple[np.ndarray, ...]:
    """(labels, document, bucket, weight) by doc_id, without n-grams of fewer than ``LEAST_DOCS`` documents.

    One document is unpacked at a time, because everything together would be held several times over.
    """
    order = np.argsort(got["doc_id"].to_numpy(), kind="stable").tolist()
    y = got["label"].to_numpy().astype(np.int64)[order]
    docs = np.zeros(BUCKETS, np.int64)
    for value in got["grams"]:
        docs[np.frombuffer(value.as_buffer(), np.int32)] += 1
    often = docs >= LEAST_DOCS
    size = int(docs[often].sum())
    doc, bucket, weight = np.zeros(size, np.int32), np.zeros(size, np.int32), np.zeros(size, np.float32)
    end = 0
    for at, row in enumerate(order):
        found = np.frombuffer(got["grams"][row].as_buffer(), np.int32)
        keep = often[found]
        start, end = end, end + int(keep.sum())
        doc[start:end], bucket[start:end] = at, found[keep]
        weight[start:end] = np.frombuffer(got["shares"][row].as_buffer(), np.float32)[keep]
    return y, doc, bucket, weight


def learn_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = FOLDS, fold: int = FOLD,
                   id_col: str = "doc_id", text_col: str = "text") -> dict:
    """The model, from at most ``SAMPLE_DOCS`` labelled documents that are not held out.

    Without labels it is the constant 0, with a single class that class.
    """
    sample = labelled_sample(docs, labels, label, SAMPLE_DOCS, folds, fold, id_col, text_col)
    got = sample.mapInArrow(_sample_grams, "doc_id bigint, label int, grams binary, shares binary").toArrow()
    y, doc, bucket, weight = _training_arrays(got)
    del got
    return fit(bucket, doc, weight, y)


def score_toxicity(docs: DataFrame, model: dict, threshold: float = THRESHOLD, folds: int = FOLDS, fold: int = FOLD,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, from its whole text alone.

    - NULL, empty and blank texts have no n-grams and get the score of the bias.
    - NULL and repeated ids are kept; equal texts get equal scores. An empty table gives no rows.
    - Other columns, whatever their names, are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            at, raw = text_buffer(batch.column("text"))
            parts = [predict(sent.value, at[a:b + 1], raw) for a, b in text_groups(at)]
            score = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, "doc_id bigint, score double").select(
        "doc_id", held_out("doc_id", folds, fold).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
