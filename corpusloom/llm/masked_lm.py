"""Language-model scores by masked pseudo-likelihood.

Every word of a document is predicted from the two words on either side by a small window network;
the sum of the log-probabilities is the document's score. A word's probability is that of its class, given
by the network, times that of the word within its class, given by counts over the whole corpus: the
most frequent words are classes of their own, all others are classed by their ending.

The network is trained in numpy on all documents and all positions: each word is masked once and predicted from
the words around it. Each task trains a copy on its own documents, and the copies are averaged by
position count with an ordinary aggregation, one row per parameter and task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.byte_words import WordHasher, cut_long, mix, text_buffer, text_groups

# Words are told apart by slot: 32 endings times 2^15 hashes.
ENDINGS, PER_ENDING = 32, 1 << 15
SLOTS = ENDINGS * PER_ENDING
OWN_CLASS, OWN_CONTEXT = 32, 1024
CLASSES, CONTEXTS = OWN_CLASS + ENDINGS, OWN_CONTEXT + ENDINGS + 1
NOTHING = CONTEXTS - 1  # beyond the ends of a text
WINDOW = (-2, -1, 1, 2)
HIDDEN = 16
BATCH, RATE = 2048, 0.5
_HASHER = WordHasher(71)
_SHAPES = (("E", (len(WINDOW), CONTEXTS, HIDDEN)), ("b", (HIDDEN,)), ("W", (HIDDEN, CLASSES)), ("c", (CLASSES,)))


def slots(at: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slot, text) of every word."""
    h, start, end, text = _HASHER.words(at, raw)
    last = raw[end - 1].astype(np.uint64)
    before = np.where(end - start > 1, raw[np.maximum(end - 2, start)], 0).astype(np.uint64)
    ending = mix(last * np.uint64(256) + before, 72) % np.uint64(ENDINGS)
    return (ending * np.uint64(PER_ENDING) + h % np.uint64(PER_ENDING)).astype(np.int32), text


def _count(batches):
    total = np.zeros(SLOTS, np.int64)
    for batch in batches:
        at, raw = text_buffer(batch.column("text"))
        for a, b in text_groups(at):
            total += np.bincount(slots(at[a:b + 1], raw)[0], minlength=SLOTS)
    there = np.flatnonzero(total)
    for k in range(0, len(there), 1 << 16):
        part = there[k:k + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], ["slot", "n"])


def vocabulary(counts: np.ndarray) -> dict:
    """Class, context and log-probability within the class of each slot."""
    order = np.argsort(-counts, kind="stable")
    slot_class = (OWN_CLASS + np.arange(SLOTS) // PER_ENDING).astype(np.int16)
    context = (OWN_CONTEXT + np.arange(SLOTS) // PER_ENDING).astype(np.int16)
    own = order[:OWN_CLASS][counts[order[:OWN_CLASS]] > 0]
    slot_class[own] = np.arange(len(own))
    near = order[:OWN_CONTEXT][counts[order[:OWN_CONTEXT]] > 0]
    context[near] = np.arange(len(near))
    smooth = counts + 0.5
    of_class = np.bincount(slot_class, weights=smooth, minlength=CLASSES)
    return {
        "class": slot_class, "context": context, "log_within": np.log(smooth / of_class[slot_class]).astype(np.float32),
        "prior": np.log((of_class + 1) / (of_class + 1).sum()).astype(np.float32),
    }


def start_network(prior: np.ndarray) -> dict:
    rng = np.random.default_rng(0)
    m = {k: rng.normal(0, 0.1, shape).astype(np.float32) for k, shape in _SHAPES}
    m["c"] = prior.copy()
    return m


def _windows(vocab: dict, slot: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Contexts [position in window, word]."""
    ids = vocab["context"][slot]
    n = len(ids)
    out = np.full((len(WINDOW), n), NOTHING, np.int16)
    for j, d in enumerate(WINDOW):
        a, b = max(0, -d), min(n, n - d)  # words that have a neighbour there
        if b > a:
            out[j, a:b] = np.where(text[a:b] == text[a + d:b + d], ids[a + d:b + d], NOTHING)
    return out


def _forward(m: dict, context: np.ndarray):
    z = m["b"] + m["E"][0][context[0]]
    for j in range(1, len(WINDOW)):
        z += m["E"][j][context[j]]
    h = np.tanh(z)
    logit = h @ m["W"] + m["c"]
    logit -= logit.max(1, keepdims=True)
    e = np.exp(logit)
    return h, logit, e, e.sum(1)


def log_class(m: dict, context: np.ndarray, target: np.ndarray) -> np.ndarray:
    out = np.empty(len(target), np.float32)
    for k in range(0, len(target), BATCH):
        rows = slice(k, k + BATCH)
        _, logit, _, total = _forward(m, context[:, rows])
        out[rows] = logit[np.arange(len(total)), target[rows]] - np.log(total)
    return out


def train_step(m: dict, context: np.ndarray, target: np.ndarray) -> None:
    h, _, e, total = _forward(m, context)
    n = len(target)
    d = e / total[:, None]
    d[np.arange(n), target] -= 1
    rate = RATE * min(1.0, n / BATCH)
    d /= n
    d_z = (d @ m["W"].T) * (1 - h * h)
    m["W"] -= rate * (h.T @ d)
    m["c"] -= rate * d.sum(0)
    m["b"] -= rate * d_z.sum(0)
    for j in range(len(WINDOW)):
        order = np.argsort(context[j], kind="stable")
        heads = np.flatnonzero(np.diff(context[j][order], prepend=-1))
        # Rare contexts would hardly move at the common rate.
        many = np.diff(np.append(heads, n))[:, None]
        m["E"][j][context[j][order][heads]] -= rate * np.sqrt(n / many) * np.add.reduceat(d_z[order], heads)


def _train(sent):
    def run(batches):
        vocab = sent.value
        m = start_network(vocab["prior"])
        seen = 0
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def step():
            nonlocal held, size, seen
            context, target = (np.concatenate([x[i] for x in held], axis=-1) for i in (0, 1))
            for k in range(0, len(target), BATCH):
                train_step(m, context[:, k:k + BATCH], target[k:k + BATCH])
            seen += len(target)
            held, size = [], 0

        for batch in batches:
            at, raw = text_buffer(batch.column("text"))
            for a, b in text_groups(at):
                slot, text = slots(at[a:b + 1], raw)
                if not len(slot):
                    continue
                held.append((_windows(vocab, slot, text), vocab["class"][slot]))
                size += len(slot)
                if size >= BATCH:
                    step()
        if held:
            step()
        if seen:
            flat = np.concatenate([m[k].ravel() for k, _ in _SHAPES]).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat * seen), pa.array(np.full(len(flat), float(seen)))],
                ["parameter", "weighted", "weight"],
            )

    return run


def learn_language_model(docs: DataFrame, text_col: str = "text") -> dict:
    """Vocabulary and network from all texts. Without any word, the network is the untrained one."""
    spark = docs.sparkSession
    texts = docs.select(F.col(text_col).alias("text"))
    found = texts.mapInArrow(_count, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()  # at most SLOTS rows
    counts = np.zeros(SLOTS, np.int64)
    counts[found["slot"].to_numpy()] = found["n"].to_numpy()
    vocab = vocabulary(counts)
    mean = (
        texts.mapInArrow(_train(spark.sparkContext.broadcast(vocab)), "parameter int, weighted double, weight double")
        .groupBy("parameter").agg((F.sum("weighted") / F.sum("weight")).alias("value")).toArrow()  # one row per parameter
    )
    network = start_network(vocab["prior"])
    if mean.num_rows:
        flat = np.zeros(mean.num_rows, np.float32)
        flat[mean["parameter"].to_numpy()] = mean["value"].to_numpy()
        k = 0
        for name, shape in _SHAPES:
            size = int(np.prod(shape))
            network[name] = flat[k:k + size].reshape(shape)
            k += size
    return {"vocabulary": vocab, "network": network}


def score_language_model(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, log_likelihood, score): sum and mean over all words of the log-probability given both sides.

    - NULL, empty and blank texts have no words: sum and score are 0.
    - Texts beyond a megabyte are scored in slices whose ends count as ends of the text.
    - NULL and repeated ids are kept; equal texts get equal scores. An empty table gives no rows.
    - Other columns, whatever their names, are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        vocab, network = sent.value["vocabulary"], sent.value["network"]
        for batch in batches:
            at, raw = text_buffer(batch.column("text"))
            n_words, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            pieces, owner = cut_long(at, raw)
            for a, b in text_groups(pieces):
                slot, text = slots(pieces[a:b + 1], raw)
                value = vocab["log_within"][slot] + log_class(network, _windows(vocab, slot, text), vocab["class"][slot])
                own = owner[a + text]
                first = int(owner[a])
                many = int(owner[b - 1]) + 1 - first
                n_words[first:first + many] += np.bincount(own - first, minlength=many)
                total[first:first + many] += np.bincount(own - first, weights=value, minlength=many)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words), pa.array(total), pa.array(total / np.maximum(1, n_words))],
                ["doc_id", "n_words", "log_likelihood", "score"],
            )

    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, "doc_id bigint, n_words bigint, log_likelihood double, score double")
