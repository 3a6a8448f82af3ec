"""Benchmark decontamination: n-gram seeds join passages to test items, Smith-Waterman scores them.

All word 3-grams of the test items are seeds, frequent ones too: those that occur in the corpus at all may be the
only ones that edits left. A passage of a document that shares at least two seeds with an item, at about
the same distance from each other, is aligned with the item word by word, so copies with changed, left
out or added words are found and get a score.

Test items are a query set: they go to every task in blocks of a bounded number of words, and every
block meets all documents. Nothing is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.byte_words import WordHasher, text_buffer, text_groups, word_grams

SEED_WORDS = 3
LEAST_SEEDS = 2
# Score of an alignment over that of the item with itself, from which a document counts as contaminated.
THRESHOLD = 0.5
MISMATCH, GAP = 0.5, 0.5
# Words by which a copy may be longer or shorter than its item, as a share of the item.
SLACK = 0.5
# Words of test items that are sent to the tasks at once.
BLOCK_WORDS = 500_000
# Very long items are matched in windows of this many words, so that an item never exceeds a block.
ITEM_WORDS = 4096

# Signs do not count, so a copy with other punctuation is a copy.
_HASHER = WordHasher(61, letters_only=True)


class Items:
    """A block of test items: their words, and their n-grams in order of the hash."""

    def __init__(self, ids: list, texts: list[str | None]):
        at, raw = text_buffer(pa.array(texts, pa.string()))
        h, _, _, text = _HASHER.words(at, raw)
        edges = np.searchsorted(text, np.arange(len(texts) + 1))
        self.ids, self.words = [], []
        for i, item in enumerate(ids):
            own = h[edges[i]:edges[i + 1]]
            for k in range(0, len(own), ITEM_WORDS):
                self.ids.append(item)
                self.words.append(own[k:k + ITEM_WORDS])
        owner = np.repeat(np.arange(len(self.words)), [len(w) for w in self.words])
        flat = np.concatenate(self.words) if self.words else np.zeros(0, np.uint64)
        grams, first = word_grams(flat, owner, SEED_WORDS)
        heads = np.searchsorted(owner, np.arange(len(self.words)))
        item = owner[first] if len(first) else np.zeros(0, np.int64)
        place = first - heads[item] if len(first) else np.zeros(0, np.int64)
        order = np.argsort(grams, kind="stable")
        self.gram, self.item, self.place = grams[order], item[order], place[order]
        self.seed = np.unique(self.gram)
        self.size = np.array([len(w) for w in self.words], np.int64)


def alignment(item: np.ndarray, passage: np.ndarray) -> tuple[float, int]:
    """(score, end) of the best local alignment; a match counts 1, end is a word of the passage."""
    drop = GAP * np.arange(len(passage) + 1)
    row = np.zeros(len(passage) + 1)
    best, end = 0.0, 0
    for word in item:
        base = np.maximum(row - GAP, 0)
        base[1:] = np.maximum(base[1:], row[:-1] + np.where(passage == word, 1.0, -MISMATCH))
        row = np.maximum.accumulate(base + drop) - drop
        top = int(row.argmax())
        if row[top] > best:
            best, end = float(row[top]), top
    return best, end


def _windows(items: Items, grams: np.ndarray, first: np.ndarray, text: np.ndarray, edges: np.ndarray):
    """(text, item, first word, end word) of the passages that share seeds with an item; those of one text and item do not overlap."""
    low = np.searchsorted(items.gram, grams, "left")
    many = np.searchsorted(items.gram, grams, "right") - low
    hit = np.flatnonzero(many)
    if not len(hit):
        return
    many, low = many[hit], low[hit]
    at = np.repeat(first[hit], many)
    entry = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
    item, row, begin = items.item[entry], text[at], at - items.place[entry]  # where the item would begin
    order = np.lexsort((begin, item, row))
    item, row, begin = item[order], row[order], begin[order]
    size = items.size[item]
    slack = np.maximum(2, SLACK * size).astype(np.int64)
    new = np.ones(len(item), bool)
    new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (begin[1:] - begin[:-1] > slack[1:])
    heads = np.flatnonzero(new)
    ends = np.append(heads[1:], len(item))
    fit = (ends - heads >= LEAST_SEEDS) | (size[heads] <= SEED_WORDS + 1)
    heads, ends = heads[fit], ends[fit]
    row, item, size, slack = row[heads], item[heads], size[heads], slack[heads]
    lo = np.maximum(edges[row], begin[heads] - slack)
    hi = np.minimum(edges[row + 1], begin[ends - 1] + size + slack)
    # Passages that overlap are searched as one, so that no copy is found twice.
    k = 0
    while k < len(row):
        end, j = hi[k], k + 1
        while j < len(row) and row[j] == row[k] and item[j] == item[k] and lo[j] < end:
            end, j = max(end, hi[j]), j + 1
        yield int(row[k]), int(item[k]), int(lo[k]), int(end)
        k = j


def _copies(want: np.ndarray, words: np.ndarray, lo: int, hi: int, threshold: float):
    """(score, first word, end word) of all copies of an item in words[lo:hi], the best first, then those beside it."""
    todo = [(lo, hi)]
    while todo:
        lo, hi = todo.pop()
        passage = words[lo:hi]
        # No alignment scores more than the item's words that the passage has.
        if len(passage) < threshold * len(want) or np.isin(want, passage).sum() < threshold * len(want):
            continue
        score, stop = alignment(want, passage)
        if score < threshold * len(want):
            continue
        _, back = alignment(want[::-1], passage[:stop][::-1])
        yield score / len(want), lo + stop - back, lo + stop
        todo += [(lo, lo + stop - back), (lo + stop, hi)]


def matches(items: Items, batch_text: pa.Array, threshold: float):
    """(row, item, score, start byte, end byte) of all contaminated passages of a column of texts."""
    if not len(items.seed):
        return
    at, raw = text_buffer(batch_text)
    for a, b in text_groups(at):
        h, start, end, text = _HASHER.words(at[a:b + 1], raw)
        grams, first = word_grams(h, text, SEED_WORDS)
        # Most n-grams are no seeds; they are put aside together.
        place = np.minimum(np.searchsorted(items.seed, grams), len(items.seed) - 1)
        found = items.seed[place] == grams
        edges = np.searchsorted(text, np.arange(b - a + 1))
        for i, item, lo, hi in _windows(items, grams[found], first[found], text, edges):
            for score, first_word, end_word in _copies(items.words[item], h, lo, hi, threshold):
                yield a + i, item, score, int(start[first_word] - at[a + i]), int(end[end_word - 1] - at[a + i])


def item_blocks(items: DataFrame, item_id: str = "item_id", item_text: str = "text"):
    """Broadcast blocks of test items with their seeds."""
    spark = items.sparkSession
    slim = items.select(F.col(item_id).cast("bigint").alias("item"), F.coalesce(item_text, F.lit("")).alias("text"))
    words = F.size(F.split("text", r"\s+"))
    total = slim.agg(F.sum(words).alias("n")).first()["n"] or 0
    n = -(-total // BLOCK_WORDS)
    for k in range(n):
        rows = slim.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k).orderBy("item", "text").toArrow()
        block = Items(rows["item"].to_pylist(), rows["text"].to_pylist())
        if len(block.seed):
            yield spark.sparkContext.broadcast(block)


def contaminated_passages(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
                          text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, score, start_byte, end_byte), one row per passage that copies a test item.

    The score is the alignment's over the item's length in words; bytes count within the UTF-8 text.
    Words are runs of letters and digits with A-Z lower-cased.

    - NULL and empty texts, and items without words, match nothing. Items of fewer than three words are one seed.
    - NULL and repeated ids are kept: each row is searched by itself, and equal items each report their matches.
    - An empty table on either side gives no rows. Other columns, whatever their names, are not read.
    """
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id bigint, item_id bigint, score double, start_byte bigint, end_byte bigint"

    def search(sent):
        def run(batches):
            block = sent.value
            for batch in batches:
                rows = list(matches(block, batch.column("text"), threshold))
                row, item, score, start, end = zip(*rows) if rows else ([],) * 5
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array([block.ids[i] for i in item], pa.int64()),
                     pa.array(score, pa.float64()), pa.array(start, pa.int64()), pa.array(end, pa.int64())],
                    ["doc_id", "item_id", "score", "start_byte", "end_byte"],
                )

        return run

    out = docs.sparkSession.createDataFrame([], schema)
    for sent in item_blocks(items, item_id, item_text):
        out = out.unionByName(slim.mapInArrow(search(sent), schema))
    return out


def drop_contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, text_col: str = "text",
                      item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that copy no test item. No shuffle."""

    def keep(sent):
        def run(batches):
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                clean[[m[0] for m in matches(sent.value, batch.column(text_col), threshold)]] = False
                yield batch.filter(pa.array(clean))

        return run

    out = docs
    for sent in item_blocks(items, item_id, item_text):
        out = out.mapInArrow(keep(sent), docs.schema)
    return out
