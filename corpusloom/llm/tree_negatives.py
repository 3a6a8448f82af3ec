"""Hard negatives for anchors, with scores bounded along a spanning tree of the anchors.

Anchors of one label that lie near each other form a block, and each block gets a minimum spanning tree. A
candidate's score at an anchor differs from its score at the anchor's parent by at most the length of the
edge times the candidate's norm (Cauchy and Schwarz), so going down the tree every candidate carries an
interval, and only those whose interval meets the anchor's window are scored exactly.

The anchors are a stated set of queries against all rows. They go to the tasks in blocks of bounded bytes, with one scan
of the rows per block; a task hands on a few rows per anchor.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.ordering import group_position
from corpusloom.session import materialize, scratch_path

# Anchors in one tree, and bytes of anchors that go to every task for one scan.
TREE_ANCHORS = 512
SCAN_BYTES = 8 << 20
# Anchors that attract others into blocks, and candidates that a task works on at once.
PIVOTS = 64
CHUNK = 4096

_LONG = (1 << 63) - 1


def usable_vectors(rows: DataFrame, row_id: str, label: str, vector: str) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part, one per id."""
    part = rows.select(
        F.col(row_id).cast("bigint").alias("vec_id"), F.col(label).cast("bigint").alias("label"),
        F.col(vector).cast("array<double>").alias("vector"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = part.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)
    repeated = materialize(good.groupBy("vec_id").count().filter("count > 1").select("vec_id"), "repeated")
    if not repeated.take(1):
        return good
    one = good.join(repeated, "vec_id", "left_semi").groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("_row"))
    return materialize(
        good.join(repeated, "vec_id", "left_anti").unionByName(one.select("vec_id", "_row.label", "_row.vector")), "vectors",
    )


def matrix(column: pa.Array, width: int, scale: float) -> np.ndarray:
    """Vectors as rows of whole numbers floor(scale * x); shorter ones end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = np.diff(column.offsets.to_numpy())
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    if (size == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width))
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def products(rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Exact inner products as 64-bit numbers; beyond their range the nearest one."""
    if not rows.size:
        return np.zeros(len(rows), np.int64)
    if float(np.abs(rows).max()) * float(np.abs(anchor).max()) * rows.shape[1] < 1 << 53:
        return (rows @ anchor).astype(np.int64)
    a = [int(x) for x in anchor]
    exact = [sum(int(x) * y for x, y in zip(row, a)) for row in rows]
    return np.array([max(-_LONG, min(_LONG, s)) for s in exact], np.int64)


def norms(m: np.ndarray) -> np.ndarray:
    """Lengths of the rows, with what rounding may have taken."""
    top = np.abs(m).max(axis=1, keepdims=True, initial=1.0)
    return np.sqrt(((m / top) ** 2).sum(axis=1)) * top[:, 0] * (1 + 1e-9)


def spanning_tree(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, edge) of a minimum spanning tree from row 0; parents are places in the order and come first."""
    n = len(m)
    near, parent = np.full(n, np.inf), np.zeros(n, np.int64)
    order, parents, edges = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
    free = np.ones(n, bool)
    at = 0
    for place in range(n):
        order[place], parents[place], edges[place] = at, parent[at], 0.0 if place == 0 else near[at]
        free[at] = False
        d = norms(m - m[at])
        closer = free & (d < near)
        near[closer], parent[closer] = d[closer], place
        if free.any():
            at = int(np.argmin(np.where(free, near, np.inf)))
    return order, parents, edges


def anchor_trees(anchors: DataFrame, n: int, width: int, scale: float, size: int = TREE_ANCHORS) -> DataFrame:
    """(label, pivot, part, place, parent, edge, vec_id, vector): every anchor's place in the tree of its block.

    A block holds at most ``size`` anchors of one label that share their nearest pivot.
    """
    n_pivots = max(1, min(PIVOTS, n // size))
    rows = anchors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(n_pivots).select("vector").toArrow()
    pivots = matrix(rows["vector"], width, scale)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = matrix(batch["vector"], width, scale)
            best, at = np.full(len(m), np.inf), np.zeros(len(m), np.int64)
            for i, p in enumerate(pivots):
                d = norms(m - p)
                closer = d < best
                best[closer], at[closer] = d[closer], i
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], batch["label"], batch["vector"], pa.array(at), pa.array(best)],
                ["vec_id", "label", "vector", "pivot", "distance"],
            )

    near = anchors.mapInArrow(nearest, "vec_id bigint, label bigint, vector array<double>, pivot bigint, distance double")
    placed = group_position(materialize(near, "anchors"), ["label", "pivot"], ["distance", "vec_id"], "_at")
    blocks = placed.withColumn("part", F.expr(f"(_at - 1) div {size}"))

    def tree(block: pa.Table) -> pa.Table:
        block = block.sort_by("vec_id")
        order, parent, edge = spanning_tree(matrix(block["vector"], width, scale))
        return block.select(["label", "pivot", "part", "vec_id", "vector"]).take(pa.array(order)).append_column(
            "place", pa.array(np.arange(len(order))),
        ).append_column("parent", pa.array(parent)).append_column("edge", pa.array(edge))

    return materialize(blocks.drop("distance", "_at").groupBy("label", "pivot", "part").applyInArrow(
        tree, "label bigint, pivot bigint, part bigint, vec_id bigint, vector array<double>, place bigint, parent bigint, edge double",
    ), "trees")


class Trees:
    """The trees of one scan, in order of their label."""

    def __init__(self, rows: pa.Table, width: int, scale: float):
        rows = rows.sort_by([(c, "ascending") for c in ("label", "pivot", "part", "place")])
        take = lambda c: rows[c].to_numpy()
        self.ids, self.labels, self.parent, self.edge = take("vec_id"), take("label"), take("parent"), take("edge")
        self.vectors = matrix(rows["vector"], width, scale)
        self.starts = np.append(np.flatnonzero(take("place") == 0), len(self.ids))

    def walk(self, start: int, end: int, rows: np.ndarray, length: np.ndarray, need: Callable, take: Callable) -> None:
        """Go down one tree. ``need(anchor, low, high)`` says which rows must be scored, ``take`` gets their scores."""
        low, high = np.empty((end - start, len(rows))), np.empty((end - start, len(rows)))
        for place, anchor in enumerate(range(start, end)):
            if place == 0:
                picked = np.arange(len(rows))
            else:
                above = self.parent[anchor]
                # With what rounding may have taken from the bounds above.
                reach = self.edge[anchor] * length * (1 + 1e-9) + 1 + 1e-12 * np.maximum(np.abs(low[above]), np.abs(high[above]))
                np.subtract(low[above], reach, out=low[place])
                np.add(high[above], reach, out=high[place])
                picked = np.flatnonzero(need(anchor, low[place], high[place]))
            if len(picked):
                # Most rows: one product without copying them first.
                scores = products(rows, self.vectors[anchor])[picked] if 2 * len(picked) > len(rows) else products(
                    rows[picked], self.vectors[anchor])
                low[place, picked] = high[place, picked] = scores
                take(anchor, picked, scores)


class Best:
    """The first ``k`` (score, then smaller id) of every list, kept up with arriving candidates."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.scores, self.ids = np.full((n, k), -_LONG - 1), np.full((n, k), _LONG)
        self.held = np.zeros(n, np.int64)
        self.least = np.full(n, -np.inf)  # a lower score cannot enter any more

    def add(self, at: int, scores: np.ndarray, ids: np.ndarray) -> None:
        n = self.held[at]
        if n == self.k:
            last = self.scores[at, -1]
            enter = (scores > last) | ((scores == last) & (ids < self.ids[at, -1]))
            scores, ids = scores[enter], ids[enter]
        if not len(scores):
            return
        if len(scores) > 4 * self.k:
            floor = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            scores, ids = scores[scores >= floor], ids[scores >= floor]
        scores, ids = np.append(self.scores[at, :n], scores), np.append(self.ids[at, :n], ids)
        first = np.lexsort((ids, -scores))[:self.k]
        self.held[at] = n = len(first)
        self.scores[at, :n], self.ids[at, :n] = scores[first], ids[first]
        if n == self.k:
            self.least[at] = self.scores[at, -1]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(list, id, score) of all that is held."""
        at = np.repeat(np.arange(len(self.held)), self.held)
        place = np.arange(len(at)) - np.repeat(np.cumsum(self.held) - self.held, self.held)
        return at, self.ids[at, place], self.scores[at, place]


def _chunks(batches: Iterator[pa.RecordBatch], width: int, scale: float):
    """(ids, labels, vectors, norms) of about ``CHUNK`` rows at a time."""
    held, n = [], 0

    def joined():
        t = pa.Table.from_batches(held)
        for a in range(0, len(t), CHUNK):
            part = t.slice(a, CHUNK)
            m = matrix(part["vector"], width, scale)
            yield part["vec_id"].to_numpy(), part["label"].to_numpy(), m, norms(m)

    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n >= CHUNK:
            yield from joined()
            held, n = [], 0
    if n:
        yield from joined()


def _positives(rows: DataFrame, trees, width: int, scale: float, k: int) -> DataFrame:
    """(anchor_id, id, score): per task the first ``k`` other rows of an anchor's own label."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = trees.value
        best = Best(len(t.ids), k)
        for ids, labels, m, length in _chunks(batches, width, scale):
            for start, end in zip(t.starts[:-1], t.starts[1:]):
                mine = np.flatnonzero(labels == t.labels[start])
                if not len(mine):
                    continue
                of = ids[mine]

                def take(anchor, picked, scores):
                    other = of[picked] != t.ids[anchor]
                    best.add(anchor, scores[other], of[picked][other])

                t.walk(start, end, m[mine], length[mine], lambda anchor, low, high: high >= best.least[anchor], take)
        at, found, scores = best.rows()
        yield pa.RecordBatch.from_arrays([pa.array(t.ids[at]), pa.array(found), pa.array(scores)], ["anchor_id", "id", "score"])

    return rows.mapInArrow(scan, "anchor_id bigint, id bigint, score bigint")


def _negatives(rows: DataFrame, trees, windows, width: int, scale: float, k: int) -> DataFrame:
    """(anchor_id, positive_id, positive_score, negative_id, negative_score): per task the first ``k`` rows in each window.

    ``windows`` holds positives, upper and lower ends in the order of their anchors, and where each anchor's begin.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, (positive, top, bottom, first) = trees.value, windows.value
        best = Best(len(positive), k)

        def need(anchor, low, high):
            a, b = first[anchor], first[anchor + 1]
            if a == b:
                return np.zeros(len(low), bool)
            return (high >= np.maximum(bottom[a:b], best.least[a:b]).min()) & (low <= top[a:b].max())

        for ids, labels, m, length in _chunks(batches, width, scale):
            for label in np.unique(t.labels):
                mine = np.flatnonzero(labels != label)
                if not len(mine):
                    continue
                of, rows_of, length_of = ids[mine], m[mine], length[mine]

                def take(anchor, picked, scores):
                    for w in range(first[anchor], first[anchor + 1]):
                        inside = (scores >= bottom[w]) & (scores <= top[w])
                        if inside.any():
                            best.add(w, scores[inside], of[picked[inside]])

                for start, end in zip(t.starts[:-1], t.starts[1:]):
                    if t.labels[start] == label:
                        t.walk(start, end, rows_of, length_of, need, take)
        at, found, scores = best.rows()
        owner = np.searchsorted(first, at, "right") - 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(t.ids[owner]), pa.array(positive[at]), pa.array(top[at]), pa.array(found), pa.array(scores)],
            ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"],
        )

    return rows.mapInArrow(scan, "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint")


def mine_hard_negatives(vectors: DataFrame, is_anchor: Column, row_id: str = "vec_id", label: str = "label", vector: str = "embedding",
                        scale: float = 256.0, n_positives: int = 5, n_negatives: int = 5, least_percent: int = 80,
                        tree_anchors: int = TREE_ANCHORS, scan_bytes: int = SCAN_BYTES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for every anchor and positive.

    ``is_anchor`` is a condition on ``vec_id``. A score is the inner product of the vectors floor(scale * x); higher ones come first,
    ties by smaller id. Positives are an anchor's first other rows of its label, negatives its first rows of
    other labels whose score lies between ``least_percent`` percent of the positive's and the positive's score,
    both included; there are none below a negative positive. All rows are candidates, whatever their number.

    Rows take no part if their id, label or vector is NULL or the vector has a NULL or non-finite component. Of several rows
    with one id the smallest (label, vector) counts. Shorter vectors count as ending in zeros, so an empty one scores 0. Scores beyond
    64 bits count as the largest or smallest 64-bit number. Empty tables, tables without anchors and anchors alone in their label give no rows;
    other columns do not matter.
    """
    spark = vectors.sparkSession
    rows = usable_vectors(vectors, row_id, label, vector)
    anchors = rows.filter(is_anchor)
    counted = anchors.agg(F.count("*").alias("n")).first()
    width = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    trees = anchor_trees(anchors, counted["n"], width, scale, tree_anchors)
    per_scan = max(tree_anchors, scan_bytes // (8 * max(width, 1)))
    n_scans = -(-counted["n"] // per_scan)
    scan = F.pmod(F.xxhash64("label", "pivot", "part"), F.lit(max(n_scans, 1)))

    def shared_trees(number: int):
        return spark.sparkContext.broadcast(Trees(trees.filter(scan == number).toArrow(), width, scale))

    positives, negatives = scratch_path(spark, "positives"), scratch_path(spark, "negatives")
    for number in range(n_scans):
        shared = shared_trees(number)
        _positives(rows, shared, width, scale, n_positives).write.parquet(f"{positives}/scan={number}")
        shared.unpersist()
    if not n_scans:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    first = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    chosen = materialize(
        spark.read.schema("anchor_id bigint, id bigint, score bigint, scan int").parquet(positives)
        .withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= n_positives).drop("_n"), "positives",
    )
    for number in range(n_scans):
        shared = shared_trees(number)
        ids = shared.value.ids
        # At most ``n_positives`` rows for each anchor of this scan.
        mine = chosen.filter(F.col("scan") == number).toPandas()
        by_id = np.argsort(ids)
        at = by_id[np.searchsorted(ids, mine["anchor_id"], sorter=by_id)]
        mine = mine.assign(at=at).sort_values("at")
        top = mine["score"].to_numpy()
        bottom = np.array([-(-least_percent * int(s) // 100) for s in top], np.int64)
        first_of = np.searchsorted(mine["at"], np.arange(len(ids) + 1))
        windows = spark.sparkContext.broadcast((mine["id"].to_numpy(), top, bottom, first_of))
        _negatives(rows, shared, windows, width, scale, n_negatives).write.parquet(f"{negatives}/scan={number}")
        shared.unpersist()
        windows.unpersist()
    in_order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    found = spark.read.schema(
        "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint, scan int",
    ).parquet(negatives)
    return found.withColumn("rank", F.row_number().over(in_order)).filter(F.col("rank") <= n_negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score",
    )
