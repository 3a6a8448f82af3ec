"""Uploads that are only ever appended, and a small table that says which version of a file counts.

A collection is a folder with one sub-folder per part (rows, postings, ...) and version, and ``files``, which lists the
file names of every version. A version counts once its list is written, which is done last; of a file listed in several versions
the newest counts. So an upload writes its own rows only, a broken one leaves nothing that is read, and the same
version written again changes nothing. Uploads have even numbers; a compaction up to version v is v + 1, so an
upload that arrives meanwhile is newer than it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILES = "files"


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None if nothing has been written there."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def listed_files(spark: SparkSession, path: str) -> DataFrame | None:
    """(file_name, version) of all uploads that were finished."""
    return stored(spark, f"{path}/{FILES}")


def newest_version(spark: SparkSession, path: str) -> int:
    """Number of the newest finished version; -2 before the first."""
    files = listed_files(spark, path)
    newest = None if files is None else files.agg(F.max("version")).first()[0]
    return -2 if newest is None else int(newest)


def next_upload(spark: SparkSession, path: str) -> int:
    """The next even number."""
    return newest_version(spark, path) // 2 * 2 + 2


def write_version(part: DataFrame, path: str, name: str, version: int, by: tuple[str, ...] = ()) -> None:
    part.write.mode("overwrite").partitionBy(*by).parquet(f"{path}/{name}/version={version}")


def finish(names: DataFrame, path: str, version: int) -> None:
    """List the files of a version, which makes it count."""
    names.select("file_name").distinct().write.mode("overwrite").parquet(f"{path}/{FILES}/version={version}")


def current_files(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, version): every file with the version that counts."""
    return listed_files(spark, path).groupBy("file_name").agg(F.max("version").alias("version"))


def current_versions(spark: SparkSession, path: str) -> list[int]:
    """Versions that some file counts in; as many as there were uploads since the last compaction."""
    if listed_files(spark, path) is None:
        return []
    return sorted(r["version"] for r in current_files(spark, path).select("version").distinct().collect())


def outdated(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, version) of files that a newer version replaces."""
    files = listed_files(spark, path)
    return files.join(current_files(spark, path), ["file_name", "version"], "left_anti")


def read_part(spark: SparkSession, path: str, name: str) -> DataFrame | None:
    """Rows of a part in the versions that count, with column ``version``; folders of other versions are not read."""
    rows, versions = stored(spark, f"{path}/{name}"), current_versions(spark, path)
    if rows is None or not versions:
        return None
    return rows.filter(F.col("version").isin(versions))
