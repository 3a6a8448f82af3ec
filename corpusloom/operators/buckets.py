"""Nearest vectors by cosine through random-projection buckets, several tables of them.

In each table a vector falls into the bucket named by the sides of ``bits`` random hyperplanes it lies on. A query
looks into its own bucket and into those it would fall into if the hyperplanes nearest to it had it on
their other side, in order of the distance it is off, and every row of these buckets is scored exactly. The number of
bits follows the index, so that buckets keep their size: what is scored per query hardly grows with the index.

Query and row meet by their (table, bucket). While a query looks into few buckets, the index is not shuffled for it: the buckets that a block of
queries looks into go to every task, so a bucket that holds a third of the index is simply spread over the tasks that read it. Where it looks into a
large share, as vectors without near neighbours need, blocks of queries and rows meet in a grid of tasks, and nothing passes through the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.vectors import unit_rows
from corpusloom.operators.neighbours import CELLS, HIT_SCHEMA, QUERY_BLOCK, _all, _blocks, _grid, _query_blocks, _top, vector_top_k
from corpusloom.session import materialize

TABLES, SEED = 4, 7
# Rows that a bucket holds on average, and rows on which the hyperplanes are placed.
BUCKET_ROWS, SAMPLE_ROWS = 128, 4096
# Queries whose exact hits settle how many buckets to look into, and the share of hits to be found.
SAMPLE_QUERIES, WANTED_RECALL = 128, 0.95
MAX_BITS = 16
# Bytes of index vectors that a task scores together, and of query vectors that go to every task at once.
SCAN_BYTES, QUERY_BYTES = 32 << 20, 32 << 20
# Where a query looks into this share of all buckets or more, its block is scored with all rows at once.
GRID_SHARE = 1 / 8
# Bytes of lists of buckets to look into that go to every task at once.
LOOKED_BYTES = 128 << 20


class Buckets(NamedTuple):
    """Hyperplanes of all tables: ``normals`` (tables * bits, dim) and what the projections are compared with."""

    tables: int
    bits: int
    normals: np.ndarray
    offsets: np.ndarray

    def margins(self, vectors) -> np.ndarray:
        """(rows, tables, bits): how far the vectors lie from each hyperplane, with the side as sign."""
        unit = unit_rows(vectors)
        if not unit.size:
            return np.zeros((len(unit), self.tables, self.bits))
        return (unit @ self.normals.T - self.offsets).reshape(len(unit), self.tables, self.bits)

    def numbers(self, margins: np.ndarray) -> np.ndarray:
        """(rows, tables): number of the bucket in each table."""
        return (margins > 0) @ (1 << np.arange(self.bits))


def plan_buckets(index: DataFrame, tables: int = TABLES, seed: int = SEED, bucket_rows: int = BUCKET_ROWS,
                 bits: int | None = None) -> Buckets:
    """Hyperplanes for an index (id, vector): random directions, each placed at the median of a sample of rows.

    The sample has ``SAMPLE_ROWS`` rows at most, those with the smallest hashes of their id, whatever the size of the index.
    """
    n = index.count()
    if bits is None:
        bits = max(1, min(MAX_BITS, math.ceil(math.log2(max(n, 2) / bucket_rows))))
    order = F.xxhash64(F.lit(seed), F.col("id"))
    sample = index.select("id", "vector").orderBy(order, "id").limit(SAMPLE_ROWS).toPandas()
    unit = unit_rows(sample["vector"])
    dim = unit.shape[1] if unit.size else 1
    normals = np.random.default_rng(seed).standard_normal((tables * bits, dim))
    offsets = np.median(unit @ normals.T, axis=0) if unit.size else np.zeros(tables * bits)
    return Buckets(tables, bits, normals, offsets)


def bucket_vectors(index: DataFrame, plan: Buckets) -> DataFrame:
    """Add ``buckets``: the number of the vector's bucket in every table. Meant to be stored with the index."""
    spark = index.sparkSession
    shared = spark.sparkContext.broadcast(plan)

    @F.pandas_udf("array<int>")
    def numbers(vectors: pd.Series) -> pd.Series:
        return pd.Series(list(shared.value.numbers(shared.value.margins(vectors)).astype(np.int32)))

    return index.withColumn("buckets", numbers(F.col("vector")))


def _with_looked(queries: DataFrame, plan: Buckets, probes: int) -> DataFrame:
    """Add ``looked``: the numbers of the buckets that the query looks into, table by table, as bytes."""

    @F.pandas_udf("binary")
    def looked(vectors: pd.Series) -> pd.Series:
        return pd.Series([x.tobytes() for x in probed_buckets(plan, vectors, probes).astype(np.int32)])

    return queries.withColumn("looked", looked("vector"))


def _costs(margins: np.ndarray) -> np.ndarray:
    """(tables, 2 ** bits) per query: squared distance to be moved to lie in a bucket other than one's own, by flipped bits."""
    costs = np.zeros((*margins.shape[:-1], 1))
    for bit in range(margins.shape[-1]):
        costs = np.concatenate([costs, costs + margins[..., bit:bit + 1] ** 2], axis=-1)
    return costs


def probed_buckets(plan: Buckets, vectors, probes: int) -> np.ndarray:
    """(queries, tables, probes): the buckets that each query looks into, the nearest first."""
    margins = plan.margins(vectors)
    own = plan.numbers(margins)
    probes = min(probes, 1 << plan.bits)
    out = np.empty((len(own), plan.tables, probes), np.int64)
    for i in range(len(own)):
        costs = _costs(margins[i])
        flips = np.argsort(costs, axis=-1, kind="stable")[:, :probes]
        out[i] = own[i][:, None] ^ flips
    return out


def fit_probes(index: DataFrame, plan: Buckets, k: int, wanted: float = WANTED_RECALL, sample: int = SAMPLE_QUERIES,
               seed: int = SEED) -> int:
    """How many buckets a query must look into in each table to find the share ``wanted`` of its ``k`` exact hits.

    Measured on a bounded sample: at most ``sample`` rows of the index, those with the smallest hashes, are searched for exactly.
    """
    chosen = index.select("id", "vector").orderBy(F.xxhash64(F.lit(seed + 1), F.col("id")), "id").limit(sample)
    asked = materialize(chosen.withColumnRenamed("id", "query_id"), "sample")
    hits = vector_top_k(index, asked, k).select("query_id", "id")
    # At most ``sample * k`` rows.
    pairs = hits.join(index.select("id", "vector"), "id").join(asked.withColumnRenamed("vector", "query"), "query_id").toPandas()
    if pairs.empty:
        return 1
    margins = plan.margins(pairs["query"])
    flipped = plan.numbers(margins) ^ plan.numbers(plan.margins(pairs["vector"]))
    place = np.empty(len(pairs), np.int64)
    for i in range(len(pairs)):
        costs = _costs(margins[i])
        place[i] = min(int((c < c[f]).sum()) for c, f in zip(costs, flipped[i]))
    needed = np.sort(place)[max(0, math.ceil(wanted * len(place)) - 1)]
    return int(needed) + 1


class _Hits:
    """The best ``k`` (score, then smaller id) rows of each query, kept up while blocks of scores arrive."""

    def __init__(self, n_queries: int, k: int, hold: int = 1 << 20):
        self.k, self.hold, self.n = k, hold, 0
        self.floor = np.full(n_queries, -np.inf)
        self.parts: list[tuple] = []

    def add(self, queries: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        scores = np.round(scores, 6)
        if scores.shape[1] > 4 * self.k:  # at most k rows of a block can be among the best k
            own = -np.partition(-scores, self.k - 1, axis=1)[:, self.k - 1]
            q, row = np.nonzero(scores >= np.maximum(own, self.floor[queries])[:, None])
        else:
            q, row = np.nonzero(scores >= self.floor[queries][:, None])
        self.parts.append((queries[q], ids[row], scores[q, row]))
        self.n += len(q)
        if self.n > self.hold:
            self.compact()

    def compact(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        q, ids, scores = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((ids, -scores, q))
        q, ids, scores = q[order], ids[order], scores[order]
        new = np.ones(len(q), bool)  # a row met in several tables has the same score each time
        new[1:] = (q[1:] != q[:-1]) | (ids[1:] != ids[:-1])
        q, ids, scores = q[new], ids[new], scores[new]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        best = place < self.k
        last = place == self.k - 1
        self.floor[q[last]] = scores[last]
        q, ids, scores = q[best], ids[best], scores[best]
        self.parts, self.n = [(q, ids, scores)], len(q)
        self.hold = max(self.hold, 4 * self.n)
        return q, ids, scores


def _search(index: DataFrame, local: pd.DataFrame, plan: Buckets, k: int) -> DataFrame:
    """Hits of one block of queries with the buckets they look into: each task scores, bucket by bucket, the rows it reads."""
    spark = index.sparkSession
    looked = np.frombuffer(b"".join(local["looked"]), np.int32).reshape(len(local), plan.tables, -1)
    lists = []  # per table: queries in order of the bucket they look into, and those buckets
    for t in range(plan.tables):
        bucket = looked[:, t].ravel()
        order = np.argsort(bucket, kind="stable")
        lists.append((bucket[order], order // looked.shape[2]))
    shared = spark.sparkContext.broadcast((local["query_id"].to_numpy(), unit_rows(local["vector"]), lists))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        qids, q, lists = shared.value
        hits = _Hits(len(qids), k)
        for frame in _gathered(batches, q.shape[1]):
            rows, ids = unit_rows(frame["vector"]), frame["id"].to_numpy()
            numbers = np.stack(frame["buckets"].to_list())
            for (bucket, asking), mine in zip(lists, numbers.T):
                order = np.argsort(mine, kind="stable")
                held, start = np.unique(mine[order], return_index=True)
                low, high = np.searchsorted(bucket, held), np.searchsorted(bucket, held, "right")
                for a, b, x, y in zip(start, np.append(start[1:], len(mine)), low, high):
                    if x < y:
                        at, step = order[a:b], max(1, CELLS // (b - a))
                        for first in range(x, y, step):  # a bucket that everyone asks for is scored in slices
                            who = asking[first:min(y, first + step)]
                            hits.add(who, ids[at], q[who] @ rows[at].T)
        at, ids, scores = hits.compact()
        yield pd.DataFrame({"query_id": qids[at], "id": ids, "score": scores})

    return index.select("id", "vector", "buckets").mapInPandas(scan, HIT_SCHEMA)


def _limits(margins: np.ndarray, probes: int) -> np.ndarray:
    """(queries, tables, 2): the cost of the last bucket that each query looks into, and the bits flipped to get there, which settle equal costs."""
    out = np.empty((*margins.shape[:2], 2))
    step = max(1, CELLS // 2 // (margins.shape[1] << margins.shape[2]))
    for first in range(0, len(margins), step):
        costs = _costs(margins[first:first + step])
        last = np.partition(costs, probes - 1, axis=-1)[..., probes - 1]
        place = probes - (costs < last[..., None]).sum(axis=-1)
        flips = np.argmax(np.cumsum(costs == last[..., None], axis=-1) == place[..., None], axis=-1)
        out[first:first + step] = np.stack([last, flips], axis=-1)
    return out


def _search_grid(index: DataFrame, queries: DataFrame, plan: Buckets, probes: int, k: int, query_block: int) -> DataFrame:
    """Hits of all queries where each looks into much of the index: blocks of queries and of rows meet in a grid of tasks.

    A block's scores are worked out together; of the pairs that could be among the best those count whose row lies in a bucket that the query looks into.
    With all buckets looked into every pair counts, and is scored once however many tables there are.
    """
    sides = plan.tables, plan.bits
    if probes >= 1 << plan.bits:
        asked, held, met = _blocks(queries, "query_id", query_block), _blocks(index.select("id", "vector"), "id", max(1, CELLS // query_block)), None
    else:
        asked = _blocks(queries, "query_id", query_block, {
            "margins": lambda frame, unit: plan.margins(frame["vector"]), "limits": lambda frame, unit: _limits(plan.margins(frame["vector"]), probes),
        })
        held = _blocks(index.select("id", "vector", "buckets"), "id", max(1, CELLS // query_block), {
            "buckets": lambda frame, unit: np.stack(frame["buckets"].to_list()).astype(np.int32),
        })

        def met(margins: bytes, limits: bytes):
            margins, limits = np.frombuffer(margins).reshape(-1, *sides), np.frombuffer(limits).reshape(-1, sides[0], 2)
            own, squares = plan.numbers(margins), margins ** 2

            def of_rows(buckets: bytes):
                numbers = np.frombuffer(buckets, np.int32).reshape(-1, sides[0])

                def counts(q: np.ndarray, row: np.ndarray) -> np.ndarray:
                    out, rest = np.zeros(len(q), bool), np.arange(len(q))
                    for t in range(sides[0]):
                        who = q[rest]
                        flips, cost = own[who, t] ^ numbers[row[rest], t], np.zeros(len(rest))
                        for bit in range(sides[1]):  # in the order of _costs, so that equal costs are equal
                            cost += np.where(flips >> bit & 1, squares[who, t, bit], 0.0)
                        last, upto = limits[who, t, 0], limits[who, t, 1]
                        looked = (cost < last) | ((cost == last) & (flips <= upto))
                        out[rest[looked]] = True
                        rest = rest[~looked]
                    return out

                return counts

            return of_rows

    return _grid(asked, held, k, met)


def _gathered(batches: Iterator[pd.DataFrame], dim: int) -> Iterator[pd.DataFrame]:
    """Batches joined to frames of about ``SCAN_BYTES`` of vectors, so that a bucket's rows are scored together."""
    limit = max(1, SCAN_BYTES // (8 * max(dim, 1)))
    held, n = [], 0
    for batch in batches:
        if len(batch):
            held.append(batch)
            n += len(batch)
        if n >= limit:
            yield pd.concat(held, ignore_index=True)
            held, n = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def vector_top_k_buckets(index: DataFrame, queries: DataFrame, k: int, plan: Buckets | None = None, probes: int | None = None,
                         query_block: int | None = None, **planned) -> DataFrame:
    """Approximate cosine top-k: (query_id, id, score, rank) with exact scores to six places, ties by id.

    ``index`` has id, vector and, if they are stored, ``buckets`` of the same ``plan``; ``queries`` have query_id, vector.
    Without ``probes`` their number is fitted to a recall of ``WANTED_RECALL``; with all ``2 ** bits`` of them the
    result is the exact one. Queries for which fewer than ``k`` rows were met are searched for exactly, so none comes back short.
    """
    n = index.count()
    if not n:
        return _top(_all([], index.sparkSession), k)
    plan = plan or plan_buckets(index, **planned)
    if "buckets" not in index.columns:
        index = materialize(bucket_vectors(index.select("id", "vector"), plan), "buckets")
    if probes is None:
        probes = fit_probes(index, plan, k)
    queries = queries.select("query_id", "vector")
    probes = min(probes, 1 << plan.bits)
    if plan.tables * probes >= GRID_SHARE * (1 << plan.bits):
        hits = _top(_search_grid(index, queries, plan, probes, k, min(query_block or QUERY_BLOCK, QUERY_BLOCK)), k)
    else:
        looked = 16 * plan.tables * probes  # bytes per query
        query_block = query_block or max(1, min(QUERY_BYTES // (8 * plan.normals.shape[1]), LOOKED_BYTES // looked))
        asked = materialize(_with_looked(queries, plan, probes), "asked")
        parts = [materialize(_search(index, local, plan, k), "hits") for local in _query_blocks(asked, query_block)]
        hits = _top(_all(parts, index.sparkSession), k)
    if probes >= 1 << plan.bits:
        return hits
    hits = materialize(hits, "hits")
    full = hits.filter(F.col("rank") == min(k, n)).select("query_id")
    short = materialize(queries.join(full, "query_id", "left_anti"), "short")
    if not short.take(1):
        return hits
    return hits.join(full, "query_id", "left_semi").unionByName(vector_top_k(index, short, k))


def rows_met(index: DataFrame, queries: DataFrame, plan: Buckets, probes: int) -> DataFrame:
    """(query_id, n_rows): how many different index rows each query meets, as an equi-join on (table, bucket)."""
    spark = index.sparkSession
    shared = spark.sparkContext.broadcast(plan)

    @F.pandas_udf("array<array<int>>")
    def looked(vectors: pd.Series) -> pd.Series:
        return pd.Series([[t.tolist() for t in x] for x in probed_buckets(shared.value, vectors, probes).astype(np.int32)])

    held = index.select("id", F.posexplode("buckets").alias("table", "bucket"))
    asked = (
        queries.select("query_id", F.posexplode(looked("vector")).alias("table", "_looked"))
        .select("query_id", "table", F.explode("_looked").alias("bucket"))
    )
    met = held.join(asked, ["table", "bucket"]).select("query_id", "id").distinct()
    return met.groupBy("query_id").agg(F.count("*").alias("n_rows"))
