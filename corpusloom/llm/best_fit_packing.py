"""Best-fit packing of token sequences by exact-complement hashing.

The plan is made on how many pieces there are of each length, which is a table of at most
``capacity`` numbers whatever the corpus. It lists combinations of lengths with how often each is
used, and the pieces find their places by (length, rank within the length) alone: no piece passes
through the driver, and a length that a third of the pieces have is only a long run of ranks.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.byte_words import text_buffer, text_groups
from corpusloom.llm.word_tokens import WordEncoder
from corpusloom.session import materialize

CAPACITY = 4096
END_ID = 1


def _exact(left: np.ndarray, gap: int) -> list[int] | None:
    """One, two or three available lengths that add up to ``gap``, or None."""
    if left[gap] > 0:
        return [gap]
    pair = _pair(left, gap)
    if pair:
        return pair
    # Sums of two available lengths, as an index; then the third length by its complement.
    there = (left[:gap + 1] > 0).astype(float)
    size = 1 << (2 * gap + 1).bit_length()
    sums = np.fft.irfft(np.fft.rfft(there, size) ** 2, size)[:gap + 1] > 0.5
    third = np.flatnonzero((left[:gap] > 0) & sums[gap - np.arange(gap)])
    for c in third[::-1]:
        left[c] -= 1
        pair = _pair(left, gap - c)
        left[c] += 1
        if pair:
            return [int(c), *pair]
    return None


def _pair(left: np.ndarray, gap: int) -> list[int] | None:
    a = np.arange(1, gap // 2 + 1)
    both = np.minimum(left[a], left[gap - a])
    if gap % 2 == 0 and len(a):
        both[-1] //= 2
    if not len(a) or both.max() <= 0:
        return None
    best = int(a[both.argmax()])  # the pair that is there most often
    return [gap - best, best]


def pack_lengths(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """(times, lengths) of sequences that use up ``counts[length]`` pieces of each length 1..capacity.

    Each step starts from the longest length left and fills its gap with an exact complement of one,
    two or three pieces; where there is none, the longest piece that fits goes in and the search goes
    on with the smaller gap. The combination is used as often as the counts allow, so the number of
    steps follows the number of different lengths, not of pieces.
    """
    left = np.zeros(capacity + 1, np.int64)
    left[:len(counts)] = counts
    left[0] = 0
    out = []
    while True:
        there = np.flatnonzero(left)
        if not len(there):
            return out
        chosen, gap, free = [int(there[-1])], capacity - int(there[-1]), left.copy()
        free[chosen[0]] -= 1
        while gap:
            rest = _exact(free, gap)
            if rest is None:
                fits = np.flatnonzero(free[:gap + 1])
                if not len(fits):
                    break
                rest = [int(fits[-1])]
            for length in rest:
                free[length] -= 1
            chosen += rest
            gap -= sum(rest)
        used = np.bincount(chosen, minlength=capacity + 1)
        times = int((left[used > 0] // used[used > 0]).min())
        left -= times * used
        out.append((times, chosen))


def _pieces(tokenizer: str, capacity: int, end_id: int):
    def run(batches):
        encoder = WordEncoder.load(tokenizer)
        part = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            at, raw = text_buffer(batch.column("text"))
            row, piece, start, length, crc = [], [], [], [], []
            for a, b in text_groups(at, 1 << 21):
                ids, counts = encoder.encode(at[a:b + 1], raw)
                edges = np.concatenate([[0], np.cumsum(counts)])
                for i in range(b - a):
                    own = np.append(ids[edges[i]:edges[i + 1]], end_id).astype("<u4")
                    for k in range(-(-len(own) // capacity)):
                        cut = own[k * capacity:(k + 1) * capacity]
                        row.append(a + i)
                        piece.append(k)
                        start.append(k * capacity)
                        length.append(len(cut))
                        crc.append(zlib.crc32(cut.tobytes()))
            lengths = np.array(length, np.int64)
            order = np.argsort(lengths, kind="stable")
            heads = np.flatnonzero(np.diff(lengths[order], prepend=-1))
            rank = np.empty(len(lengths), np.int64)
            rank[order] = np.arange(len(lengths)) - np.repeat(heads, np.diff(np.append(heads, len(lengths))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(lengths), pa.array(crc, pa.int64()), pa.array(np.full(len(row), (part << 32) + number, np.int64)), pa.array(rank)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "_block", "_rank"],
            )

    return run


def best_fit_packing(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents with their places: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is the ids of its text and ``end_id``. Only a document longer than ``capacity`` is cut,
    into pieces of ``capacity`` ids and a last one that may be shorter. ``tokenizer`` is the path of a
    tokenizer file whose tokens never span white space (see ``WordEncoder``).

    - NULL, empty and blank texts are one piece that holds ``end_id`` alone.
    - NULL and repeated ids are kept as they are; each row is a document of its own.
    - An empty table gives no rows. Other columns, whatever their names, are not read.
    """
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = materialize(slim.mapInArrow(
        _pieces(tokenizer, capacity, end_id),
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, _block bigint, _rank bigint",
    ), "pieces")
    blocks = materialize(pieces.groupBy("length", "_block").agg(F.count("*").alias("_rows")), "blocks")
    sizes = blocks.groupBy("length").agg(F.sum("_rows").alias("rows")).toArrow()  # at most `capacity` rows
    counts = np.zeros(capacity + 1, np.int64)
    counts[sizes["length"].to_numpy()] = sizes["rows"].to_numpy()

    # Where each run of ranks of a length goes.
    runs, base, taken = [], 0, np.zeros(capacity + 1, np.int64)
    for times, lengths in pack_lengths(counts, capacity):
        offset = 0
        for n in lengths:
            runs.append((n, int(taken[n]), base, offset))
            taken[n] += times
            offset += n
        base += times
    runs = np.array(sorted(runs), np.int64).reshape(-1, 4)
    plan = docs.sparkSession.sparkContext.broadcast(runs)

    def place(batches):
        length, first, sequence, offset = plan.value.T
        bound = 1 << 48  # ranks are below
        for batch in batches:
            rank = batch.column("_rank").to_numpy()
            run = np.searchsorted(length * bound + first, batch.column("length").to_numpy() * bound + rank, "right") - 1
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence[run] + rank - first[run]), pa.array(offset[run])],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    # A window over the blocks of a length: one row per block, however often the length occurs in it.
    before = Window.partitionBy("length").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("length", "_block", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    ranked = pieces.join(starts, ["length", "_block"]).withColumn("_rank", F.col("_rank") + F.col("_before"))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "_rank").mapInArrow(
        place, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    )
