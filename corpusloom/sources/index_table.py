"""The keyed index table and the list of indexes."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.schemas import INDEX_ROW
from corpusloom.session import small_enough

N_BUCKETS = 64


def with_bucket(df: DataFrame, n_buckets: int = N_BUCKETS) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64("file_name"), F.lit(n_buckets)).cast("int"))


def _placed(df: DataFrame, n_buckets: int, pieces: int) -> DataFrame:
    """Bring a bucket's rows together in ``pieces`` tasks, so that one file's many chunks are spread too."""
    piece = F.pmod(F.xxhash64("id"), F.lit(pieces)).cast("int")
    return df.withColumn("_piece", piece).repartition(n_buckets * pieces, "bucket", "_piece")


def write_index(df: DataFrame, path: str, n_buckets: int = N_BUCKETS, pieces: int | None = None,
                files: DataFrame | None = None, version: str | None = None) -> None:
    """Upload index rows: the files in ``df`` replace their stored rows, other files stay.

    Rows are stored in folders by a hash of the file name and only folders with an
    uploaded file are rewritten. Uploading the same rows again changes nothing.
    ``files`` may name the uploaded files (file_name) where ``df`` is costly to read twice.
    Each folder is written by ``pieces`` tasks or, if that is more, as many as the shuffle has to spare.
    The number of folders is stored with the rows; a table that exists keeps its own. Of several rows
    with one id in ``df`` the one with the greatest ``version`` (a column, which is not stored) stays.
    """
    spark = df.sparkSession
    try:
        old = spark.read.parquet(path)
        stored = old.select("n_buckets").first()
        n_buckets = stored["n_buckets"] if stored else n_buckets
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        old = None
    if version is not None:
        rows = [c for c in df.columns if c != version]
        df = df.groupBy("id").agg(F.max_by(F.struct(*rows), version).alias("_row")).select("_row.*")
    pieces = max(pieces or 1, int(spark.conf.get("spark.sql.shuffle.partitions")) // n_buckets)
    new = with_bucket(df, n_buckets).withColumn("n_buckets", F.lit(n_buckets))
    names = with_bucket((df if files is None else files).select("file_name").distinct(), n_buckets)
    merged = new
    if old is not None:
        # As many bucket numbers as folders, so this list has a fixed bound.
        touched = [r["bucket"] for r in names.select("bucket").distinct().collect()]
        kept = old.filter(F.col("bucket").isin(touched)).join(
            small_enough(names.select("file_name")), "file_name", "left_anti",
        )
        merged = kept.select(new.columns).unionByName(new)
    # Rows of one id already lie together, so removing repeats needs no further shuffle.
    unique = _placed(merged, n_buckets, pieces).dropDuplicates(["bucket", "_piece", "id"]).drop("_piece")
    (
        unique.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("bucket").parquet(path)
    )


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("bucket", "n_buckets")


def ensure_index(spark: SparkSession, name: str, location: str | None = None,
                 schema: T.StructType = INDEX_ROW) -> bool:
    """Create the index table if it is not there; an existing one is left as it is. True if created."""
    if spark.catalog.tableExists(name):
        return False
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet{where}")
    return True


def list_indexes(spark: SparkSession, quoted: bool = True) -> DataFrame:
    """Names of the tables of the current database, in double quotes unless told otherwise."""
    names = spark.sql("SHOW TABLES").filter("NOT isTemporary").select(F.col("tableName").alias("name"))
    return names.select(F.concat(F.lit('"'), "name", F.lit('"')).alias("name")) if quoted else names
