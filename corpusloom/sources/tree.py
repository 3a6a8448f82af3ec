"""Very many files below a local folder (or a shared mount), listed and read by tasks.

Spark's own file index keeps a status of every file in the driver. Here folders are listed level by level, each level as one job, and
what is found is a stored table.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import local_path, materialize

# Entries that a task hands on at once, and bytes of texts.
BATCH_ROWS, BATCH_BYTES = 4096, 8 << 20

ENTRY = "path binary, is_folder boolean, modified bigint, length bigint"


def local_folder(spark: SparkSession, path: str) -> str | None:
    """``path`` as tasks can open it, if it is one existing folder on the local file system."""
    if re.search(r"[{}\[\]*?\\]", path):
        return None
    root = local_path(spark, path)
    return root if root is not None and os.path.isdir(root) else None


def _entries(folders: DataFrame, pattern: str | None) -> DataFrame:
    """What lies in the folders (path): sub-folders, and the files that Spark's readers would read and whose name fits ``pattern``."""
    fits = re.compile(os.fsencode(pattern), re.DOTALL).fullmatch if pattern is not None else None

    def hidden(name: bytes) -> bool:
        return name.startswith(b".") or name.startswith(b"_") and b"=" not in name or name.endswith(b"._COPYING_")

    def found(at: bytes) -> Iterator[tuple]:
        with os.scandir(at) as entries:
            for entry in entries:
                folder = entry.is_dir()
                # Spark looks into folders with the names of Parquet's summary files.
                if hidden(entry.name) and not (folder and entry.name.startswith((b"_metadata", b"_common_metadata"))):
                    continue
                if folder:
                    yield entry.path, True, None, None
                elif fits is None or fits(entry.name):
                    try:
                        status = entry.stat()
                    except FileNotFoundError:  # a link to nothing
                        continue
                    if status.st_size:  # empty files are not read
                        yield entry.path, False, status.st_mtime_ns // 1_000_000 * 1000, status.st_size

    schema = pa.schema([("path", pa.binary()), ("is_folder", pa.bool_()), ("modified", pa.int64()), ("length", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for folder in batch.column("path") for row in found(folder.as_py()))
        held = []
        for row in rows:
            held.append(row)
            if len(held) == BATCH_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    return folders.select("path").mapInArrow(scan, ENTRY)


def _spread(rows: DataFrame, n: int = 0) -> DataFrame:
    spark = rows.sparkSession
    return rows.repartition(max(n, spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def list_tree(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """(path, modified, length) of the files in and below the local folder ``root``, with paths as Spark's readers give them.

    The list is that of the time of the call. One folder is listed by one task, which holds few entries at a time.
    """
    pattern = spark._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern() if glob else None
    levels, folders = [], spark.createDataFrame([(bytearray(os.fsencode(root)),)], "path binary")
    while not levels or folders.take(1):
        found = materialize(_entries(folders if not levels else _spread(folders), pattern), "files")
        levels.append(found.filter("NOT is_folder"))
        folders = found.filter("is_folder")
    files = reduce(DataFrame.unionByName, levels)
    return files.select(
        F.concat(F.lit("file:"), F.col("path").cast("string")).alias("path"), F.timestamp_micros("modified").alias("modified"), "length",
    )


def compressed(spark: SparkSession, files: DataFrame) -> DataFrame:
    """The files that Spark's text reader would unpack, by their names."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory.getCodecClasses(spark._jsc.hadoopConfiguration())
    none, nothing = gateway.new_array(jvm.java.lang.Class, 0), gateway.new_array(jvm.java.lang.Object, 0)
    made = [codecs.get(i).getDeclaredConstructor(none).newInstance(nothing) for i in range(codecs.size())]
    return files.filter(reduce(lambda a, b: a | b, [F.col("path").endswith(codec.getDefaultExtension()) for codec in made]))


def read_files(files: DataFrame) -> DataFrame:
    """(path, text): each of the listed files whole, in tasks of about equal numbers of files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, texts, held = [], [], 0
            for at in batch.column("path"):
                with open(at.as_py().removeprefix("file:").encode(), "rb") as file:
                    texts.append(file.read())
                names.append(at)
                held += len(texts[-1])
                if held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.binary())], names=["path", "text"])
                    names, texts, held = [], [], 0
            if names:
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.binary())], names=["path", "text"])

    size = files.agg(F.sum("length").alias("n")).first()["n"] or 0
    at_once = files.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    found = _spread(files.select("path"), -(-size // at_once)).mapInArrow(read, "path string, text binary")
    return found.withColumn("text", F.col("text").cast("string"))
