"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Rows that may be sent to every task: short keys and numbers, or rows with a question's text.
BROADCAST_ROWS = 500_000
BROADCAST_TEXTS = 20_000


def build_session(app: str = "corpusloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; cluster settings win over these defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A temporary folder is used only where the setting is missing and Spark runs
    in one process; on a cluster the setting is required.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    made = tempfile.mkdtemp(prefix="corpusloom-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in a folder of this application, which may be dropped once the application is over."""
    return f"{scratch_dir(spark)}/corpusloom/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def local_path(spark: SparkSession, path: str) -> str | None:
    """``path`` as tasks can open it, if it is on the local file system or a shared mount; else None."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toUri()
    return full.getPath() if full.getScheme() == "file" else None


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Cut lineage by writing ``df`` to the shared scratch folder and reading it back."""
    path = scratch_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_enough(df: DataFrame, n_rows: int | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it is known to be short, else left to adaptive execution."""
    n = df.count() if n_rows is None else n_rows
    return F.broadcast(df) if n <= limit else df


def spread(scan: DataFrame) -> DataFrame:
    """Deal the rows of a small scan over all cores; a scan with enough splits is left alone.

    Meant for file scans ahead of heavy per-row work: one file with a single row group
    would otherwise be read and processed by one task.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
