"""Nearest vectors by cosine: exact and approximate top-k.

No pair of query and row ever becomes a row of its own. Each task scores blocks of the
index against all queries by a matrix product and hands on k rows per query.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.vectors import unit_rows
from corpusloom.session import materialize, small_enough

# Queries sent to every task at once; more are split into blocks with a scan of the index each.
QUERY_BLOCK = 2048

# Scores that a task works out at once.
CELLS = 1 << 22

# Blocks of queries and of rows meet in a grid of tasks of this size, or of as many as leave each task this many blocks.
QUERY_SLOTS, ROW_SLOTS = 16, 4
QUERIES_HELD, ROWS_HELD = 32, 128

# Fixed value: rows looked at per query in an approximate search.
CANDIDATES = 500
CODE_BITS = 512
SEED = 7

HIT_SCHEMA = "query_id bigint, id bigint, score double"


def _top(partial: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return partial.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def _merge(parts: list[pd.DataFrame], k: int) -> pd.DataFrame:
    rows = pd.concat(parts, ignore_index=True)
    rows = rows.sort_values(["query_id", "score", "id"], ascending=[True, False, True])
    return rows.groupby("query_id", sort=False).head(k)


def _scan(index: DataFrame, local: pd.DataFrame, k: int) -> DataFrame:
    """Top-k of every partition against a small, size-checked list of queries.

    A column ``wanted`` holds, for each row, the queries it is to be scored for, each once. No other scores are worked out.
    """
    shared = index.sparkSession.sparkContext.broadcast((local["query_id"].to_numpy(), unit_rows(local["vector"])))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        qids, q = shared.value
        place, step = pd.Index(qids), max(1, CELLS // max(1, q.shape[1]))
        kept = None
        for batch in batches:
            if batch.empty:
                continue
            rows, ids = unit_rows(batch["vector"]), batch["id"].to_numpy()
            at_row = np.repeat(np.arange(len(batch)), batch["wanted"].map(len))
            at_query = place.get_indexer(np.concatenate(batch["wanted"].to_list()))
            for first in range(0, len(at_row), step):
                who, row = at_query[first:first + step], at_row[first:first + step]
                scores = np.round(np.einsum("ij,ij->i", q[who], rows[row]), 6)
                new = pd.DataFrame({"query_id": qids[who], "id": ids[row], "score": scores})[np.isfinite(scores)]
                kept = _merge([new] if kept is None else [kept, new], k)
        if kept is not None:
            yield kept

    return index.mapInPandas(scan, HIT_SCHEMA)


def _query_blocks(queries: DataFrame, block: int) -> Iterator[pd.DataFrame]:
    """The queries in lists of about ``block`` rows, dealt by a hash of their id."""
    n_blocks = math.ceil(queries.count() / block)
    for number in range(n_blocks):
        local = queries.filter(F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)) == number).toPandas()
        if len(local):
            yield local


def _all(parts: list[DataFrame], spark) -> DataFrame:
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], HIT_SCHEMA)


def _blocks(rows: DataFrame, key: str, n: int, more: dict[str, Callable[[pd.DataFrame, np.ndarray], np.ndarray]] = {}) -> DataFrame:
    """(block, ids, vectors): up to ``n`` rows of a partition as one, with their vectors at length 1 as bytes.

    ``more`` has further columns of bytes, made of the rows and these vectors.
    """

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def packed(frame: pd.DataFrame) -> pd.DataFrame:
            ids = [None if pd.isna(x) else int(x) for x in frame[key]]
            unit = unit_rows(frame["vector"])
            return pd.DataFrame({"ids": [ids], "vectors": [unit.tobytes()]} | {c: [f(frame, unit).tobytes()] for c, f in more.items()})

        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            while len(held) >= n:
                yield packed(held.iloc[:n])
                held = held.iloc[n:]
        if held is not None and len(held):
            yield packed(held)

    blocks = rows.mapInPandas(pack, ", ".join(["ids array<bigint>, vectors binary", *(f"{c} binary" for c in more)]))
    return materialize(blocks.withColumn("block", F.monotonically_increasing_id()), "blocks")


class TopRows:
    """The best ``k`` rows (score, then smaller id) of each of a block of queries, kept up while blocks of rows arrive.

    All scores of a block are worked out in single precision. Those that may be among the best, by more than that can be off, are
    worked out again in double precision, rounded to six places and compared exactly.
    """

    # Rows with which queries that have found nothing begin where not every pair counts.
    FIRST = 128

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.single = vectors.astype(np.float32)
        self.slack = np.float32(2e-6 + 1.2e-7 * max(1, vectors.shape[1]))
        self.floor = np.full(len(ids), -np.inf)
        self.parts, self.n, self.hold = [], 0, max(1 << 14, len(ids) * k)

    def add(self, ids: np.ndarray, vectors: np.ndarray, met: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> None:
        """Rows of the index; ``met`` tells of pairs of places (query, row) whether they count."""
        if met is not None and len(ids) > 2 * self.FIRST and np.isneginf(self.floor).any():
            self._add(0, ids[:self.FIRST], vectors[:self.FIRST], met)
            self.compact()
            ids, vectors, first = ids[self.FIRST:], vectors[self.FIRST:], self.FIRST
        else:
            first = 0
        self._add(first, ids, vectors, met)
        if self.n > self.hold:
            self.compact()

    def _add(self, first: int, ids: np.ndarray, vectors: np.ndarray, met) -> None:
        if not len(ids) or not len(self.ids):
            return
        scores = self.single @ vectors.astype(np.float32).T
        least = self.floor.astype(np.float32) - self.slack
        fresh = np.flatnonzero(np.isneginf(self.floor))
        if len(fresh) and len(ids) > self.k:  # the k-th best of this block is a floor, where there is none yet
            own = np.where(np.isnan(scores[fresh]), -np.inf, scores[fresh])
            if met is not None:
                own[~met(np.repeat(fresh, len(ids)), np.tile(np.arange(len(ids)) + first, len(fresh))).reshape(own.shape)] = -np.inf
            least[fresh] = np.partition(own, len(ids) - self.k, axis=1)[:, len(ids) - self.k] - 2 * self.slack
        q, row = np.divmod(np.flatnonzero(scores >= least[:, None]), len(ids))
        if met is not None:
            counts = met(q, row + first)
            q, row = q[counts], row[counts]
        step = max(1, CELLS // max(1, vectors.shape[1]))
        for at in range(0, len(q), step):
            who, which = q[at:at + step], row[at:at + step]
            exact = np.round(np.einsum("ij,ij->i", self.vectors[who], vectors[which]), 6)
            kept = exact >= self.floor[who]
            self.parts.append((who[kept], ids[which[kept]], exact[kept]))
            self.n += int(kept.sum())

    def compact(self) -> None:
        if not self.parts:
            return
        q, ids, scores = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((ids, -scores, q))
        q, ids, scores = q[order], ids[order], scores[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        last = place == self.k - 1
        self.floor[q[last]] = scores[last]
        best = place < self.k
        self.parts, self.n = [(q[best], ids[best], scores[best])], 0

    def hits(self) -> pd.DataFrame:
        self.compact()
        q, ids, scores = self.parts[0] if self.parts else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return pd.DataFrame({"query_id": self.ids[q], "id": ids, "score": scores})


def vector_top_k(index: DataFrame, queries: DataFrame, k: int, query_block: int = QUERY_BLOCK) -> DataFrame:
    """Exact cosine top-k: (query_id, id, score, rank), scores to six places, ties by id.

    ``index`` has columns id, vector and ``queries`` query_id, vector. Both are packed into blocks, ``query_block`` queries to one,
    and every pair of blocks is scored in the one task of a grid where it meets; nothing passes through the driver. ``k`` rows per query leave a task.
    """
    asked = _blocks(queries.select("query_id", "vector"), "query_id", query_block)
    held = _blocks(index.select("id", "vector"), "id", max(1, CELLS // query_block))
    return _top(_grid(asked, held, k), k)


def _grid(asked: DataFrame, held: DataFrame, k: int, met: Callable | None = None) -> DataFrame:
    """Hits of every pair of blocks (block, ids, vectors, ...) of queries and rows, ``k`` rows per query and task.

    A task gets its blocks of queries first and keeps them; then each of its blocks of rows is scored for all of them. No pair of blocks is a row
    of its own. ``met`` makes of the further columns of a block of queries, and then of a block of rows, what tells which pairs count.
    """
    slots = max(QUERY_SLOTS, math.ceil(asked.count() / QUERIES_HELD)), max(ROW_SLOTS, math.ceil(held.count() / ROWS_HELD))

    def dealt(blocks: DataFrame, side: int) -> DataFrame:
        """The blocks once for each slot of the other side, in the order of the tasks' work."""
        own = F.pmod(F.xxhash64("block"), F.lit(slots[side])).cast("int")
        others = F.explode(F.sequence(F.lit(0), F.lit(slots[1 - side] - 1)))
        more = F.array(*[c for c in blocks.columns if c not in ("block", "ids", "vectors")]).cast("array<binary>")
        rows = blocks.select("block", "ids", "vectors", more.alias("more"), F.lit(side).alias("side"), own.alias("_own"), others.alias("_other"))
        at, to = (F.col("_own"), F.col("_other")) if side == 0 else (F.col("_other"), F.col("_own"))
        return rows.withColumn("cell", at * slots[1] + to).drop("_own", "_other")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell, tops = None, []
        for batch in batches:
            for at, side, ids, vectors, more in zip(batch["cell"], batch["side"], batch["ids"], batch["vectors"], batch["more"]):
                if at != cell:
                    yield from (top.hits() for top, _ in tops)
                    cell, tops = at, []
                ids = np.asarray(ids)
                vectors = np.frombuffer(vectors).reshape(len(ids), -1)
                if side == 0:
                    tops.append((TopRows(ids, vectors, k), None if met is None else met(*more)))
                else:
                    for top, of_queries in tops:
                        top.add(ids, vectors, None if of_queries is None else of_queries(*more))
        yield from (top.hits() for top, _ in tops)

    cells = dealt(asked, 0).unionByName(dealt(held, 1)).repartitionById(slots[0] * slots[1], F.col("cell"))
    return cells.sortWithinPartitions("cell", "side", "block").mapInPandas(scan, HIT_SCHEMA)


def hyperplanes(dim: int, bits: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((bits, dim))


def sign_bits(vectors, dim: int, bits: int, seed: int) -> np.ndarray:
    """On which side of each random hyperplane the vectors lie, as 0 and 1."""
    return (unit_rows(vectors) @ hyperplanes(dim, bits, seed).T > 0).astype(np.uint8)


def code_vectors(index: DataFrame, dim: int, bits: int = CODE_BITS, seed: int = SEED) -> DataFrame:
    """Add ``code``: the packed sign bits of the vector, a small fraction of its size."""

    @F.pandas_udf("binary")
    def code(vectors: pd.Series) -> pd.Series:
        return pd.Series([row.tobytes() for row in np.packbits(sign_bits(vectors, dim, bits, seed), axis=1)])

    return index.withColumn("code", code(F.col("vector")))


def _distances(q_signs: np.ndarray, codes: pd.Series, bits: int) -> np.ndarray:
    """Differing bits of every query and row."""
    packed = np.frombuffer(b"".join(codes), dtype=np.uint8).reshape(len(codes), -1)
    signs = np.unpackbits(packed, axis=1)[:, :bits].astype(np.float32) * 2 - 1
    return ((bits - q_signs @ signs.T) / 2).astype(np.int64)


def near_rows(coded: DataFrame, local: pd.DataFrame, dim: int, candidates: int, bits: int, seed: int) -> DataFrame:
    """(query_id, id) of the ``candidates`` rows per query whose codes are nearest, ties by id.

    A first pass over the codes counts rows by distance, which is a few hundred numbers
    per query however large the index; a second pass hands on the rows within reach. Of
    many rows at the same distance, such as copies, each task hands on the first ids only.
    """
    spark = coded.sparkSession
    q_signs = sign_bits(local["vector"], dim, bits, seed).astype(np.float32) * 2 - 1
    shared = spark.sparkContext.broadcast((local["query_id"].to_numpy(), q_signs))
    codes = coded.select("id", "code")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        qids, q = shared.value
        width = bits + 1
        total = np.zeros(len(qids) * width, dtype=np.int64)
        for batch in batches:
            if len(batch):
                d = _distances(q, batch["code"], bits) + np.arange(len(qids))[:, None] * width
                total += np.bincount(d.ravel(), minlength=len(total))
        at = np.flatnonzero(total)
        yield pd.DataFrame({"query_id": qids[at // width], "distance": at % width, "n": total[at]})

    counted = codes.mapInPandas(count, "query_id bigint, distance int, n bigint")
    upto = Window.partitionBy("query_id").orderBy("distance")
    reach = (
        counted.groupBy("query_id", "distance").agg(F.sum("n").alias("n"))
        .withColumn("before", F.sum("n").over(upto) - F.col("n"))
        .filter(F.col("before") < candidates)
        .groupBy("query_id").agg(F.max("distance").alias("distance"))
    )
    # One number per query of the size-checked list.
    limits = {r["query_id"]: r["distance"] for r in reach.collect()}
    limit = np.array([limits.get(int(n), -1) for n in local["query_id"]])

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        qids, q = shared.value
        for batch in batches:
            if not len(batch):
                continue
            ids = batch["id"].to_numpy()
            d = _distances(q, batch["code"], bits)
            near = d <= limit[:, None]
            for i in np.flatnonzero(near.sum(axis=1) > candidates):
                tied = np.flatnonzero(d[i] == limit[i])
                near[i, tied[np.argsort(ids[tied])[candidates:]]] = False
            at_query, at_row = np.nonzero(near)
            yield pd.DataFrame({"query_id": qids[at_query], "id": ids[at_row], "distance": d[at_query, at_row]})

    picked = codes.mapInPandas(pick, "query_id bigint, id bigint, distance int")
    nearest = Window.partitionBy("query_id").orderBy("distance", "id")
    return picked.withColumn("n", F.row_number().over(nearest)).filter(F.col("n") <= candidates).select("query_id", "id")


def vector_top_k_ann(index: DataFrame, queries: DataFrame, k: int, dim: int, candidates: int = CANDIDATES,
                     bits: int = CODE_BITS, seed: int = SEED, query_block: int = QUERY_BLOCK) -> DataFrame:
    """Approximate cosine top-k: nearest sign codes first, then exact scores of those rows.

    An index stored with its ``code`` column has only codes read in the first step. The
    queries are worked on in blocks; a query's result does not depend on its block.
    """
    # Codes are made once, not in both passes of every block.
    coded = index if "code" in index.columns else materialize(code_vectors(index.select("id", "vector"), dim, bits, seed).drop("vector"), "codes")
    parts = []
    for local in _query_blocks(queries.select("query_id", "vector"), query_block):
        # One entry per query in each list, also where rows share an id.
        wanted = materialize(
            near_rows(coded, local, dim, candidates, bits, seed)
            .groupBy("id").agg(F.collect_set("query_id").alias("wanted")), "candidates",
        )
        parts.append(_scan(index.select("id", "vector").join(small_enough(wanted), "id"), local, k))
    return _top(_all(parts, index.sparkSession), k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact hits that were found."""
    hits = found.select("query_id", "id").withColumn("_hit", F.lit(1))
    return exact.join(hits, ["query_id", "id"], "left").agg(
        F.avg(F.coalesce("_hit", F.lit(0))).alias("recall"), F.count("*").alias("n_exact"),
    )
