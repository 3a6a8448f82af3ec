"""Shards of near equal bytes as the leaves of a k-d tree over document metadata.

Every node that stands for several shards is cut in two at the weighted median (by bytes) along the
dimension in which it is widest, until each leaf stands for one shard. All nodes of a level are cut
together, and no step sorts or gathers the rows of a node: the median is found by histograms of at most
``bins`` numbers per node, narrowed until few rows are left around it, and only those are put in order.
DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.operators.ordering import group_position
from corpusloom.session import materialize

N_SHARDS = 16
BINS = 1024
# Rows around a median that one task puts in order.
FEW = 4096
# Part of a shard's bytes by which a cut may miss the median so as not to part equal texts.
SLACK = 1 / 128
# Columns of ``documents`` that are dimensions beside the size.
METADATA = ("lang", "source")

_EDGE = 1 << 61


def coordinate(c: Column, kind: T.DataType) -> Column:
    """A column as whole numbers in its own order: NULL first; text by its first seven UTF-8 bytes."""
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        number = c.cast("double") if isinstance(kind, T.FractionalType) else c.cast("bigint")
        held = F.greatest(F.lit(-_EDGE), F.least(F.lit(_EDGE), number)).cast("bigint")
        return F.coalesce(held, F.lit(-_EDGE - 1))
    if isinstance(kind, (T.TimestampType, T.DateType)):
        return F.coalesce(F.unix_micros(c.cast("timestamp")), F.lit(-_EDGE - 1))
    front = F.hex(F.substring(c.cast("string").cast("binary"), 1, 7))
    return F.coalesce(F.conv(F.rpad(front, 14, "0"), 16, 10).cast("bigint"), F.lit(-1))


def _unsigned_hash(c: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(c), 1)


def _narrow(docs: DataFrame, dims: tuple[str, ...], text: str, doc_id: str) -> DataFrame:
    """One row of numbers per document: coordinates ``c``, and what orders rows that share them.

    Equal texts get the coordinates of one of them (the smallest of each), so that they lie together.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    kinds = {f.name: f.dataType for f in docs.schema.fields}
    size = (F.octet_length(body) + 1).cast("bigint")
    rows = materialize(docs.select(
        F.col(doc_id).alias("doc_id"), size.alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"),
        F.array(size, *[coordinate(F.col(d), kinds[d]) for d in dims]).alias("c"), _unsigned_hash(body).alias("h"),
        _unsigned_hash(F.col(doc_id)).alias("d"), F.monotonically_increasing_id().alias("r"),
    ), "narrow")
    if not dims:
        return rows
    at = range(1, len(dims) + 1)
    low = F.array(F.min("size"), *[F.min(F.col("c")[i]) for i in at])
    high = F.array(F.min("size"), *[F.max(F.col("c")[i]) for i in at])
    mixed = rows.groupBy("h").agg(low.alias("_low"), high.alias("_high")).filter("_low <> _high").select("h", "_low")
    together = F.when(F.col("_low").isNotNull(), F.concat(F.array("size"), F.slice("_low", 2, len(dims)))).otherwise(F.col("c"))
    return rows.join(mixed, "h", "left").withColumn("c", together).drop("_low")


def _key() -> Column:
    """The order of rows in a node: its dimension, then the text, then the document, then the stored row."""
    return F.concat(F.array(F.get("c", F.col("dim"))), F.array("h", "d", "r"))


def _depth() -> Column:
    """How many parts of the key the rows around the median have in common."""
    return F.size("prefix")


def _in_box(rows: DataFrame, state: DataFrame) -> DataFrame:
    """Rows that may hold a node's median, with their key; ``state`` has one row per node."""
    keyed = rows.join(F.broadcast(state), ["s", "k"]).withColumn("key", _key())
    x = F.get("key", _depth())
    return keyed.filter((F.slice("key", 1, _depth()) == F.col("prefix")) & x.between(F.col("lo"), F.col("hi")))


def _first_state(rows: DataFrame, extent: list[float], n_dims: int) -> DataFrame:
    """Per node its widest dimension and the weight wanted left of the cut."""
    cols = [F.col("c")[i] for i in range(n_dims)]
    nodes = rows.filter("k > 1").groupBy("s", "k").agg(
        F.sum("size").alias("_w"), F.count("*").alias("n"), F.array(*map(F.min, cols)).alias("_low"),
        F.array(*map(F.max, cols)).alias("_high"),
    )
    part = [
        F.struct(((F.col("_high")[i] - F.col("_low")[i]) / F.lit(float(extent[i] or 1))).alias("w"), F.lit(-i).alias("at"))
        for i in range(n_dims)
    ]
    widest = F.negate(F.array_max(F.array(*part))["at"])
    return nodes.withColumn("dim", widest).select(
        "s", "k", "dim", (F.col("_w") * F.floor(F.col("k") / 2) / F.col("k")).alias("goal"),
        F.array().cast("array<bigint>").alias("prefix"), F.get("_low", F.col("dim")).alias("lo"),
        F.get("_high", F.col("dim")).alias("hi"), F.lit(0).cast("bigint").alias("before"), "n",
        F.lit(None).cast("array<bigint>").alias("cut"), F.lit(None).cast("boolean").alias("inclusive"),
    )


def _narrower(rows: DataFrame, state: DataFrame, bins: int, slack: float) -> DataFrame:
    """One round: for every node the bin that its median lies in, or the cut between two groups of texts."""
    known = ("s", "k", "dim", "goal", "prefix", "lo", "hi", "before")
    x, after = F.get("key", _depth()), F.get("key", _depth() + 1)
    width = F.expr(f"(hi - lo) div {bins} + 1")
    hist = (
        _in_box(rows, state.select(*known)).withColumn("x", x).withColumn("w", width)
        .withColumn("bin", F.expr("(x - lo) div w"))
        .groupBy(*known, "bin").agg(
            F.sum("size").alias("w"), F.count("*").alias("n"), F.min("x").alias("x0"), F.max("x").alias("x1"),
            F.min(after).alias("y0"), F.max(after).alias("y1"),
        )
    )
    upto = Window.partitionBy("s").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    opened = (
        hist.withColumn("until", F.col("before") + F.sum("w").over(upto)).withColumn("before", F.col("until") - F.col("w"))
        .filter("until >= goal AND before < goal")
    )
    single = F.col("x0") == F.col("x1")
    inside = single & (_depth() == 1)  # all that is left is one group of equal texts
    group = F.concat("prefix", F.array("x0"))
    missed, over = F.col("goal") - F.col("before"), F.col("until") - F.col("goal")
    whole = inside & (F.least(missed, over) <= slack)
    return opened.select(
        "s", "k", "dim", "goal", F.when(single, group).otherwise(F.col("prefix")).alias("prefix"),
        F.when(single, F.col("y0")).otherwise(F.col("x0")).alias("lo"), F.when(single, F.col("y1")).otherwise(F.col("x1")).alias("hi"),
        "before", "n", F.when(whole, group).alias("cut"), F.when(whole, over < missed).alias("inclusive"),
    )


def _last_cuts(rows: DataFrame, state: DataFrame, slack: float) -> DataFrame:
    """Cuts of the nodes with few rows left: between texts if near enough to the median, else between rows."""
    few = _in_box(rows, state.drop("cut", "inclusive")).withColumn("depth", _depth())
    order = Window.partitionBy("s").orderBy("key")
    between = F.col("depth") < 2
    ranked = (
        few.withColumn("until", F.col("before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("next", F.lead("key").over(order))
        .withColumn("ends", between & (F.col("next").isNull() | (F.col("next")[1] != F.col("key")[1])))
    )

    def candidate(ends: Column, weight: Column, key: Column, inclusive: bool) -> Column:
        off = F.abs(weight - F.col("goal"))
        return F.struct(
            F.when(ends & (off <= slack), 0).otherwise(1).alias("kind"), off.alias("off"), weight.alias("weight"), key.alias("cut"),
            F.lit(inclusive).alias("inclusive"),
        )

    best = ranked.withColumn("_at", candidate(F.col("ends"), F.col("until"), F.col("key"), True)).groupBy(
        "s", "k", "dim", "goal", "before", "depth",
    ).agg(F.min("_at").alias("_at"), F.min("key").alias("_first"))
    start = candidate(between, F.col("before"), F.col("_first"), False)
    return best.withColumn("_at", F.least("_at", start)).select("s", "k", "dim", "_at.cut", "_at.inclusive")


def _cuts(rows: DataFrame, state: DataFrame, bins: int, few: int, slack: float) -> DataFrame:
    """(s, k, dim, cut, inclusive) of all nodes; as many rows as there are nodes, so at most as the shards."""
    found = []
    state = materialize(state, "kd-nodes")
    while state.filter(F.col("n") > few).take(1):
        found.append(state.filter(F.col("n") <= few))
        state = materialize(_narrower(rows, state.filter(F.col("n") > few), bins, slack), "kd-nodes")
        found.append(state.filter("cut IS NOT NULL"))
        state = state.filter("cut IS NULL")
    found.append(state)
    states = found[0]
    for more in found[1:]:
        states = states.unionByName(more)
    decided = states.filter("cut IS NOT NULL").select("s", "k", "dim", "cut", "inclusive")
    return materialize(_last_cuts(rows, states.filter("cut IS NULL"), slack).unionByName(decided), "kd-cuts")


def _apply(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Rows with the child node they fall into."""
    joined = rows.join(F.broadcast(cuts), ["s", "k"], "left")
    mine = F.slice(_key(), 1, F.size("cut"))
    left = (mine < F.col("cut")) | (F.col("inclusive") & (mine == F.col("cut")))
    half = F.floor(F.col("k") / 2).cast("int")
    return joined.select(
        *[c for c in rows.columns if c not in ("s", "k")],
        F.when(F.col("cut").isNull() | left, F.col("s")).otherwise(F.col("s") + half).alias("s"),
        F.when(F.col("cut").isNull(), F.col("k")).when(left, half).otherwise(F.col("k") - half).alias("k"),
    )


def kd_shards(docs: DataFrame, n_shards: int | None = None, target_bytes: int | None = None, dims: tuple[str, ...] | None = None,
              text: str = "text", doc_id: str = "doc_id", bins: int = BINS, few: int = FEW, slack: float = SLACK) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row, by the law ``bytes``.

    The tree has ``n_shards`` leaves, or as many as give about ``target_bytes`` each (16 if neither is given). Its
    dimensions are the size of the text and ``dims``, by default ``lang`` and ``source`` where the table has
    them; other columns, whatever their names, do not matter. A node of k shards is cut so that its left side
    gets floor(k / 2) / k of its bytes, along the dimension in which it spans the largest part of the whole
    table's extent (ties: the first). A cut falls between two groups of equal texts if one of these places is
    within ``slack`` of a shard's bytes from the median (ties: the smaller side), so copies stay together; else
    it falls at the nearest place between two rows, so that a group larger than that is parted too. Shards
    therefore differ by about that slack and one document.

    Sizes are UTF-8 bytes plus 1; a NULL text counts as empty. Rows with the same dimension, text and id, NULL
    or repeated ids included, are parted by their stored place. Slots count from 0 in each shard in order of
    doc_id, NULL first. ``grown_shard`` is NULL, because under this law a further shard changes all places. An empty table
    gives no rows, and a table with fewer rows than shards leaves some shards empty. Very long texts are
    measured and hashed whole, and only numbers are moved.
    """
    if dims is None:
        dims = tuple(c for c in METADATA if c in docs.columns)
    rows = materialize(_narrow(docs, dims, text, doc_id), "kd-rows")
    n_dims = len(dims) + 1
    cols = [F.col("c")[i] for i in range(n_dims)]
    whole = rows.agg(F.sum("size").alias("w"), *[(F.max(c) - F.min(c)).alias(f"e{i}") for i, c in enumerate(cols)]).first()
    total = whole["w"] or 0
    if n_shards is None:
        n_shards = max(1, math.ceil(total / target_bytes)) if target_bytes else N_SHARDS
    extent = [whole[f"e{i}"] or 0 for i in range(n_dims)]
    loose = slack * total / n_shards
    rows = rows.withColumn("s", F.lit(0)).withColumn("k", F.lit(n_shards))
    for _ in range(math.ceil(math.log2(n_shards)) if total else 0):
        rows = materialize(_apply(rows, _cuts(rows, _first_state(rows, extent, n_dims), bins, few, loose)), "kd-rows")
    placed = rows.select("doc_id", "size", "text_crc32", F.col("s").alias("shard"), "r")
    # Every shard is numbered over range-partitioned slices, since one alone may be far larger than a task.
    numbered = group_position(placed, ["shard"], ["doc_id", "r"], "slot", hot_rows=0)
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("slot") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
