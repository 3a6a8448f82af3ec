"""Shard and endpoint assignment, collision-free result names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import stem
from corpusloom.operators.ordering import global_position

# Fixed value: shards 0..9.
N_SHARDS = 10


def assign_shard(df: DataFrame, n: int = N_SHARDS, order_by: tuple[str, ...] = ("file_name",),
                 mode: str = "exact", out: str = "shard") -> DataFrame:
    """Shard 0..n-1 for every row.

    ``exact`` deals the shards round robin in listing order; ``hash`` needs no ordering
    and no second pass but is only balanced on average.
    """
    if mode == "hash":
        return df.withColumn(out, F.pmod(F.xxhash64(*order_by), F.lit(n)).cast("int"))
    ranked = global_position(df, order_by, "_position")
    return ranked.withColumn(out, F.pmod(F.col("_position") - 1, F.lit(n)).cast("int")).drop("_position")


def assign_endpoint(df: DataFrame, endpoints: list[str], shard: str = "shard") -> DataFrame:
    """Endpoint number ``shard`` while there are that many, else ``shard`` modulo their number."""
    if not endpoints:
        raise ValueError("no endpoint is given")
    table = F.array(*[F.lit(e) for e in endpoints])
    slot = F.pmod(F.col(shard), F.lit(len(endpoints))).cast("int")
    return df.withColumn("endpoint", F.element_at(table, slot + 1))


def resolve_names(files: DataFrame, existing: DataFrame, run_time: Column,
                  name: str = "file_name", arrival: str = "queued_at", key: tuple[str, ...] | None = None) -> DataFrame:
    """Result name and outcome ('primary', 'timestamped', 'failed') for every file.

    Files of one stem compete for ``stem.md`` and then for one name with the minute of
    the run; nobody else of that stem can get a name, so only the first two claimants
    of a stem are ranked and the rest of a large group never moves to one task.
    ``existing`` has a column ``result_name``. Rows with the same ``key`` (by default container
    and name where there is a container column, else the name) are deliveries of one file: they claim
    once, at their first arrival, and all get its outcome.
    """
    if key is None:
        key = tuple(c for c in ("container_name", "container") if c in files.columns and c != name)[:1] + (name,)
    minute = F.date_format(run_time, "yyyy-MM-dd-HH-mm")
    stems = files.groupBy(*key).agg(F.min(arrival).alias(arrival)).withColumn("_stem", stem(F.col(name)))
    claim = Window.partitionBy("_stem").orderBy(arrival, name, *[c for c in key if c != name])
    claims = (
        stems.withColumn("_claim", F.row_number().over(claim))
        .filter(F.col("_claim") <= 2)
        .withColumn("_primary", F.concat("_stem", F.lit(".md")))
        .withColumn("_dated", F.concat_ws("", "_stem", F.lit("-"), minute, F.lit(".md")))
    )
    stored = existing.select("result_name").distinct()
    # Every stem's primary name is taken afterwards, by a stored result or a new one.
    claimed = stems.select(F.concat("_stem", F.lit(".md")).alias("result_name"))
    taken = stored.unionByName(claimed).distinct()
    ranked = (
        claims
        .join(stored.select(F.col("result_name").alias("_primary"), F.lit(True).alias("_p_taken")), "_primary", "left")
        .join(taken.select(F.col("result_name").alias("_dated"), F.lit(True).alias("_d_taken")), "_dated", "left")
    )
    p_free, d_free = F.col("_p_taken").isNull(), F.col("_d_taken").isNull()
    first = F.col("_claim") == 1
    outcome = (
        F.when(first & p_free, "primary")
        .when(first & d_free, "timestamped")
        .when(~first & p_free & d_free, "timestamped")
        .otherwise("failed")
    )
    named = ranked.withColumn("outcome", outcome).select(
        *[F.col(c).alias(f"_key_{c}") for c in key], "outcome",
        F.when(F.col("outcome") == "primary", F.col("_primary"))
        .when(F.col("outcome") == "timestamped", F.col("_dated")).alias("result_name"),
    )
    same = reduce(Column.__and__, [files[c].eqNullSafe(named[f"_key_{c}"]) for c in key])
    return (
        files.join(named, same, "left").drop(*[f"_key_{c}" for c in key])
        .withColumn("outcome", F.coalesce("outcome", F.lit("failed")))
    )
