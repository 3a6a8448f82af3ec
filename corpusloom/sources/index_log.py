"""An index table that grows by appended uploads and is compacted by a job of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import materialize, small_enough
from corpusloom.sources import versions as V

ROWS = "rows"


def append_index(df: DataFrame, path: str, version: int | None = None, files: DataFrame | None = None) -> int:
    """Upload index rows as a new version: the files in ``df`` replace their stored rows when the index is read.

    Nothing that is stored is read or written again. ``files`` (file_name) may name the uploaded files, also ones
    that have no rows any more, which removes them. A caller that may run twice, such as a streaming batch, gives its own
    even ``version``. Of several rows with one id one is kept. Returns the version.
    """
    version = V.next_upload(df.sparkSession, path) if version is None else version
    written = write_rows(_single(df), path, version).select("file_name")
    V.finish(written if files is None else files, path, version)
    return version


def write_rows(df: DataFrame, path: str, version: int) -> DataFrame:
    """The rows of a version, as written; they do not count before ``V.finish``."""
    V.write_version(df, path, ROWS, version)
    return df.sparkSession.read.schema(df.schema).parquet(f"{path}/{ROWS}/version={version}")


def _single(df: DataFrame) -> DataFrame:
    """``df`` with one of the rows of each id. Only rows that share an id are moved, which are found by the ids alone."""
    shared = materialize(df.groupBy("id").agg(F.count("*").alias("_n")).filter("_n > 1").select(F.col("id").alias("_id")), "shared-ids")
    if not shared.take(1):
        return df
    shared, same = small_enough(shared), F.col("id").eqNullSafe(F.col("_id"))
    return df.join(shared, same, "left_anti").unionByName(df.join(shared, same, "left_semi").dropDuplicates(["id"]))


def read_current(spark: SparkSession, path: str, ids: DataFrame | None = None) -> DataFrame:
    """The rows that count: those of each file's newest version. With ``ids`` (id) only theirs, which are looked for first."""
    rows = V.read_part(spark, path, ROWS)
    if rows is None:
        raise ValueError(f"no index at {path}")
    if ids is not None:
        rows = rows.join(small_enough(ids.select("id").distinct()), "id", "left_semi")
    return rows.join(V.outdated(spark, path), ["file_name", "version"], "left_anti").drop("version")


def compact_index(spark: SparkSession, path: str) -> int:
    """Write the rows that count once more, as one version, so that reading need not leave out others.

    Uploads may go on meanwhile: they are newer than the compacted version. Returns that version, or the only one that counts.
    """
    newest = V.newest_version(spark, path)
    if V.current_versions(spark, path) == [newest] and not V.outdated(spark, path).filter(f"version = {newest}").take(1):
        return newest
    files = V.current_files(spark, path).filter(f"version <= {newest}").select("file_name")
    V.write_version(read_current(spark, path), path, ROWS, newest + 1)
    V.finish(files, path, newest + 1)
    return newest + 1


def unread_versions(spark: SparkSession, path: str) -> list[int]:
    """Versions whose folders no reader needs any more and that may be dropped."""
    files = V.listed_files(spark, path)
    if files is None:
        return []
    everything = {r["version"] for r in files.select("version").distinct().collect()}
    return sorted(everything - set(V.current_versions(spark, path)))
