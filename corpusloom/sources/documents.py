"""Listing and reading documents, storing extracted text."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.schemas import CATALOG
from corpusloom.session import local_path, materialize, small_enough
from corpusloom.sources.tree import compressed, list_tree, local_folder, read_files


def _relative(file_path: Column, spark: SparkSession, root: str) -> Column:
    """A file's path below ``root``. Both are compared as plain text with one slash after the scheme."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(root)
    full = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()
    tidy = F.regexp_replace(file_path, "^file:/+", "file:/")
    start = re.sub("^file:/+", "file:/", full).rstrip("/") + "/"
    return F.when(tidy.startswith(start), F.substring(tidy, len(start) + 1, 1 << 20)).otherwise(F.substring_index(tidy, "/", -1))


def list_documents(spark: SparkSession, path: str, container: str = "documents", glob: str | None = None,
                   fmt: str = "binaryFile") -> DataFrame:
    """Names below ``path``, sizes and times of the files; their content is never read.

    Tasks list a local folder; Spark's file index, which the driver keeps, lists other paths.
    ``fmt='parquet'`` reads a stored catalogue (file_name, container, metadata) instead.
    """
    if fmt == "parquet":
        return spark.read.schema(CATALOG).parquet(path)
    root = local_folder(spark, path)
    if root is not None:
        listed = list_tree(spark, root, glob)
    else:
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        if glob:
            reader = reader.option("pathGlobFilter", glob)
        listed = reader.load(path).withColumnRenamed("modificationTime", "modified")
    return listed.select(
        F.col("path"), _relative(F.col("path"), spark, path).alias("file_name"), F.lit(container).alias("container"),
        F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")).alias("metadata"),
        F.col("modified"), F.col("length"),
    )


def read_texts(spark: SparkSession, path: str, fmt: str = "text", name: str = "processed_name",
               text: str = "text", glob: str | None = None) -> DataFrame:
    """(processed_name, text), each file or row read whole as UTF-8. The name is the file's path below ``path``.

    Tasks list and read a local folder. Spark's text reader, whose list of files the driver keeps, reads other paths and folders with compressed files.
    """
    if fmt == "parquet":
        return spark.read.parquet(path).select(name, text)
    root = local_folder(spark, path)
    if root is not None:
        files = list_tree(spark, root, glob)
        if not compressed(spark, files).take(1):
            return read_files(files).select(_relative(F.col("path"), spark, path).alias("processed_name"), "text")
    reader = spark.read.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(path, wholetext=True).select(
        # The stored path is URL-encoded except for plus signs.
        _relative(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), spark, path).alias("processed_name"),
        F.col("value").alias("text"),
    )


# What Spark's writers escape in the names of folders.
_ESCAPED = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")


def write_files(df: DataFrame, path: str, folder: str = "name", text: str = "text") -> None:
    """Each text as a line of a text file in the folder of its row, with the names and rows of ``partitionBy(folder).text(path)``.

    Meant for very many small files. Spark's writer does it on other file systems; on the local one (or a shared mount) it would
    start a ``chmod`` process for each folder, file and checksum, so there the tasks write their files themselves. A file
    appears under its final name once it is whole, and a repeated task writes the same names.
    """
    root = local_path(df.sparkSession, path)
    if root is None:
        df.select(folder, text).write.partitionBy(folder).text(path)
        return

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}.txt"
        rows = ((value.as_py(), line.as_py()) for batch in batches for value, line in zip(batch.column("folder"), batch.column("text")))
        n = 0
        for value, lines in groupby(rows, key=lambda row: row[0]):
            escaped = _ESCAPED.sub(lambda found: f"%{ord(found[0]):02X}", value) if value else "__HIVE_DEFAULT_PARTITION__"
            at = os.path.join(root, f"{folder}={escaped}")
            os.makedirs(at, exist_ok=True)
            part = os.path.join(at, f".{name}.{task.taskAttemptId()}")
            with open(part, "wb") as out:
                for _, line in lines:
                    out.write((line or b"") + b"\n")
            os.replace(part, os.path.join(at, name))
            n += 1
        yield pa.RecordBatch.from_pydict({"n": [n]}, pa.schema([("n", pa.int64())]))

    # The rows of a folder come one after another; an empty name is the same folder as none.
    rows = df.select(F.nullif(F.col(folder).cast("string"), F.lit("")).alias("folder"), F.col(text).cast("binary").alias("text"))
    os.makedirs(root, exist_ok=True)
    rows.sortWithinPartitions("folder").mapInArrow(write, "n bigint").write.format("noop").mode("overwrite").save()


def stored_names(spark: SparkSession, path: str, name: str = "processed_name") -> DataFrame:
    """Names already stored under ``path``; none where nothing has been written yet."""
    try:
        return spark.read.parquet(path).select(name)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND" and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return spark.createDataFrame([], f"{name} string")


def write_texts(df: DataFrame, path: str, name: str = "processed_name", mode: str = "create") -> None:
    """Append the texts whose name is not stored yet, one write and no per-row I/O.

    ``mode='overwrite'`` replaces the whole store.
    """
    if mode == "overwrite":
        df.write.mode("overwrite").parquet(path)
        return
    known = stored_names(df.sparkSession, path, name)
    # Clashes are found on the names alone; usually they are few and the bodies stay where they are.
    clashes = materialize(df.select(name).join(known.distinct(), name, "left_semi").distinct(), "clashes")
    df.join(small_enough(clashes), name, "left_anti").write.mode("append").parquet(path)
