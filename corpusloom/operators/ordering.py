"""Order-dependent work that stays balanced when one key holds much of the data.

A plain window keeps every row of a key in one task. The functions here use it for
keys of ordinary size and cut larger keys into contiguous slices by range
partitioning; slices are joined up again through one small row per (slice, key).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import materialize

# Rows of one key that a single task may sort.
DEFAULT_HOT_ROWS = 1_000_000


def _columns(order) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def slice_rows(df: DataFrame, keys: list[str], order, slices: int | None = None) -> DataFrame:
    """Write ``df`` range-partitioned and sorted by (keys, order), with slice and row numbers.

    The written table fixes the slice bounds, so later passes over it agree with each
    other even when a task or an executor is lost in between.
    """
    n = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(k) for k in keys] + _columns(order)
    ranged = (
        df.repartitionByRange(n, *by)
        .sortWithinPartitions(*by)
        .withColumn("_slice", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    return materialize(ranged, "slices")


def global_position(df: DataFrame, order, out: str = "position", slices: int | None = None) -> DataFrame:
    """Number all rows 1..n in the given (unique) order without gathering them in one task."""
    sliced = slice_rows(df, [], order, slices)
    # One row per slice, so the list is as long as the number of partitions asked for.
    sizes = sorted((r["_slice"], r["n"]) for r in sliced.groupBy("_slice").agg(F.count("*").alias("n")).collect())
    starts, total = [], 0
    for number, size in sizes:
        starts.append((number, total))
        total += size
    offsets = df.sparkSession.createDataFrame(starts, "_slice int, _start bigint")
    return (
        sliced.join(F.broadcast(offsets), "_slice")
        .withColumn(out, F.col("_start") + F.col("_row") + 1)
        .drop("_slice", "_row", "_start")
    )


def _same_key(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int | None) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows, or None. At most count(df)/hot_rows of them exist.

    Without ``hot_rows`` the caller knows that there are none, and nothing is counted.
    """
    if hot_rows is None:
        return None
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > hot_rows).drop("_n")
    if not counts.take(1):
        return None
    return materialize(counts.select([F.col(k).alias(f"_hot_{k}") for k in keys]), "hot-keys")


def _split(df: DataFrame, hot: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_hot_{k}"))
    # No broadcast hint: adaptive execution measures the written key list and decides.
    return df.join(hot, cond, "left_anti"), df.join(hot, cond, "left_semi")


def _segments(sliced: DataFrame, keys: list[str], **extra: Column) -> DataFrame:
    """One row per (slice, key): first row, size and what precedes it in the key.

    Slices are contiguous in key order, so there are fewer segments than slices + keys.
    """
    seg = sliced.groupBy("_slice", *keys).agg(
        F.min("_row").alias("_first"), F.count("*").alias("_size"),
        *[c.alias(name) for name, c in extra.items()],
    )
    before = Window.partitionBy(*keys).orderBy("_slice")
    seg = seg.withColumn(
        "_before",
        F.coalesce(F.sum("_size").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    )
    for name in extra:
        seg = seg.withColumn(name, F.lag(name).over(before))
    return seg


def _with_segments(sliced: DataFrame, seg: DataFrame, keys: list[str]) -> DataFrame:
    small = seg.select(
        F.col("_slice").alias("_s"), *[F.col(k).alias(f"_k_{k}") for k in keys],
        *[c for c in seg.columns if c not in ("_slice", *keys)],
    )
    cond = F.col("_slice") == F.col("_s")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return sliced.join(small, cond).drop("_s", *[f"_k_{k}" for k in keys])


def group_position(df: DataFrame, keys: list[str], order, out: str = "position",
                   hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Number the rows of every key 1..n in the given order."""
    columns = [*df.columns, out]

    def windowed(part: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*_columns(order))
        return part.withColumn(out, F.row_number().over(w).cast("bigint"))

    hot = hot_keys(df, keys, hot_rows)
    if hot is None:
        return windowed(df)
    cold, large = _split(df, hot, keys)
    sliced = slice_rows(large, keys, order)
    numbered = _with_segments(sliced, _segments(sliced, keys), keys).withColumn(
        out, F.col("_before") + F.col("_row") - F.col("_first") + 1,
    )
    return windowed(cold).select(columns).unionByName(numbered.select(columns))


def group_lag(df: DataFrame, keys: list[str], order, value: str, out: str,
              hot_rows: int | None = DEFAULT_HOT_ROWS) -> DataFrame:
    """``value`` of the preceding row of the same key; NULL on the first row."""
    columns = [*df.columns, out]

    def windowed(part: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*_columns(order))
        return part.withColumn(out, F.lag(value).over(w))

    hot = hot_keys(df, keys, hot_rows)
    if hot is None:
        return windowed(df)
    cold, large = _split(df, hot, keys)
    sliced = slice_rows(large, keys, order)
    seg = _segments(sliced, keys, _carry=F.max_by(value, "_row"))
    inside = Window.partitionBy("_slice", *keys).orderBy("_row")
    joined = _with_segments(sliced.withColumn("_prev", F.lag(value).over(inside)), seg, keys)
    filled = joined.withColumn(
        out, F.when(F.col("_row") == F.col("_first"), F.col("_carry")).otherwise(F.col("_prev")),
    )
    return windowed(cold).select(columns).unionByName(filled.select(columns))


def group_running_sum(df: DataFrame, keys: list[str], order, value: str, out: str,
                      hot_rows: int | None = DEFAULT_HOT_ROWS) -> DataFrame:
    """Sum of ``value`` over the preceding rows of the same key; 0 on the first row."""
    columns = [*df.columns, out]

    def preceding(w: Window) -> Column:
        return F.coalesce(F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    def windowed(part: DataFrame) -> DataFrame:
        return part.withColumn(out, preceding(Window.partitionBy(*keys).orderBy(*_columns(order))))

    hot = hot_keys(df, keys, hot_rows)
    if hot is None:
        return windowed(df)
    cold, large = _split(df, hot, keys)
    sliced = slice_rows(large, keys, order)
    totals = sliced.groupBy("_slice", *keys).agg(F.sum(value).alias("_total"))
    slices = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    seg = totals.withColumn("_carry", F.coalesce(F.sum("_total").over(slices), F.lit(0))).drop("_total")
    inside = Window.partitionBy("_slice", *keys).orderBy("_row")
    joined = _with_segments(sliced.withColumn("_inside", preceding(inside)), seg, keys)
    summed = joined.withColumn(out, F.col("_carry") + F.col("_inside"))
    return windowed(cold).select(columns).unionByName(summed.select(columns))


def parts_by_position(df: DataFrame, keys: list[str], position: Column, order: list[Column], item: Column,
                      out: str = "items", part_size: int = 1000) -> DataFrame:
    """Ordered lists per key and part, where a part covers ``part_size`` positions counted from 0.

    Positions are already in the data, so a key with very many rows is cut without ranking it.
    """
    part = F.floor(position / F.lit(part_size)).cast("int")
    return (
        df.select(*keys, part.alias("part"), F.struct(*order, item.alias("_item")).alias("_at"))
        .groupBy(*keys, "part").agg(F.array_sort(F.collect_list("_at")).alias("_list"))
        .select(*keys, "part", F.transform("_list", lambda x: x["_item"]).alias(out))
    )


def collect_parts(df: DataFrame, keys: list[str], order, item: Column, out: str = "items",
                  part_size: int = 1000, hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Ordered lists per key, in parts of at most ``part_size`` items.

    A key of ordinary size has the single part 0; a larger one has as many parts as it
    needs, so the whole list is kept while no row grows without bound.
    """
    numbered = group_position(df.withColumn("_item", item), keys, order, "_pos", hot_rows)
    return parts_by_position(
        numbered, keys, F.col("_pos") - 1, [F.col("_pos")], F.col("_item"), out, part_size,
    )
