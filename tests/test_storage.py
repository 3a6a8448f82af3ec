"""Stored tables and streams: nothing doubled, nothing lost."""

import pathlib

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.messages import decode_messages
from corpusloom.operators.tracking import fold_state, fold_tracking, merge_state, state_record
from corpusloom.registry.base import tracking
from corpusloom.schemas import MESSAGE
from corpusloom.session import materialize, scratch_dir, scratch_path
from corpusloom.sources import documents as D
from corpusloom.sources import index_table as X
from corpusloom.sources import queues as Q
from corpusloom.sources import tracking_log as L
from corpusloom.streaming import stages as S


def rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr)


def test_scratch_is_the_named_folder(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    assert scratch_dir(spark) == (before or spark.conf.get("spark.checkpoint.dir")).rstrip("/")
    df = spark.range(5)
    kept = materialize(df)
    assert rows(kept) == rows(df) and kept.inputFiles()[0].replace("file://", "").startswith(
        scratch_dir(spark).replace("file://", ""),
    )


def test_listing_and_reading(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.txt").write_text("één\ntwo")
    (tmp_path / "sub" / "b.txt").write_text("b")
    (tmp_path / "c.bin").write_bytes(b"\x00\x01")
    listed = D.list_documents(spark, str(tmp_path))
    assert sorted(r["file_name"] for r in listed.collect()) == ["a.txt", "c.bin", "sub/b.txt"]
    read = {r["processed_name"]: r["text"] for r in D.read_texts(spark, str(tmp_path), glob="*.txt").collect()}
    assert read == {"a.txt": "één\ntwo", "sub/b.txt": "b"}


def test_text_store_keeps_the_first(spark):
    path = scratch_path(spark, "texts")
    make = lambda *r: spark.createDataFrame(list(r), "processed_name string, text string")
    D.write_texts(make(("a", "1"), ("b", "1")), path)
    D.write_texts(make(("b", "2"), ("c", "2")), path)
    D.write_texts(make(("b", "2"), ("c", "2")), path)
    assert rows(spark.read.parquet(path).select("processed_name", "text")) == [("a", "1"), ("b", "1"), ("c", "2")]


def test_index_upload_replaces_a_file(spark):
    path = scratch_path(spark, "index")
    make = lambda *r: spark.createDataFrame(list(r), "id string, file_name string, text string")
    X.write_index(make(("1", "a", "x"), ("2", "a", "y"), ("3", "b", "z")), path, 4)
    X.write_index(make(("1", "a", "new")), path, 4)
    X.write_index(make(("1", "a", "new"), ("1", "a", "new")), path, 4)
    assert rows(X.read_index(spark, path)) == [("a", "1", "new"), ("b", "3", "z")]


def test_index_table(spark):
    spark.sql("DROP TABLE IF EXISTS loom_test_index")
    assert X.ensure_index(spark, "loom_test_index", scratch_path(spark, "index"))
    assert not X.ensure_index(spark, "loom_test_index")
    assert ('"loom_test_index"',) in rows(X.list_indexes(spark))
    assert ("loom_test_index",) in rows(X.list_indexes(spark, quoted=False))
    spark.sql("DROP TABLE loom_test_index")


def test_log_replay(spark, sf):
    path = scratch_path(spark, "tracking")
    events = tracking(spark, sf)
    for _ in range(2):
        L.upsert_tracking(events.filter("seq % 2 = 0"), path, "a", 0)
        L.upsert_tracking(events, path, "b", 0)
    assert rows(fold_tracking(L.read_tracking(spark, path))) == rows(fold_tracking(events))


def test_merge_equals_fold(spark, sf):
    events = tracking(spark, sf).repartition(7)
    parts = [fold_state(events.filter(F.pmod(F.xxhash64("seq"), F.lit(3)) == i)) for i in range(3)]
    merged = merge_state(merge_state(parts[0], parts[2]), parts[1])
    assert rows(state_record(merged)) == rows(fold_tracking(events))


def test_blank_ids_are_filled_the_same_way(spark):
    df = spark.createDataFrame([("", "a", "c"), ("x", "b", "c"), (None, "a", "c")],
                               "id string, source_file_name string, container_name string")
    got = [r["id"] for r in L.assign_ids(df).orderBy("id").collect()]
    assert "x" in got and len(set(got)) == 2 and all(got)


def test_stream_stage(spark):
    """Two deliveries, bad messages, and a second run over the same checkpoint."""
    waiting, done, bad, ck = (scratch_path(spark, n) for n in ("queue", "done", "bad", "ck"))
    sent = spark.range(20).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("recognizer_index"))
    Q.send(sent, waiting)
    spark.createDataFrame([("{oops",)], "value string").write.mode("append").text(waiting)

    def once():
        S.stage_stream(Q.queue_source(spark, waiting, max_files=2), lambda b: decode_messages(b, MESSAGE),
                       S.batch_folder(done), ck, S.batch_folder(bad)).awaitTermination()

    once()
    once()
    assert spark.read.parquet(done).count() == 20
    Q.send(sent, waiting)
    once()
    assert spark.read.parquet(done).count() == 40
    assert S.dedupe_messages(spark.read.parquet(done)).count() == 20
    dead = S.dead_letter(spark.read.parquet(bad), ("value",)).collect()
    assert [(r["value"], r["attempts"], r["dead"]) for r in dead] == [("{oops", 1, False)]


def test_stream_dedupe_with_watermark(spark):
    path, out, ck = (scratch_path(spark, n) for n in ("in", "out", "ck"))
    df = spark.range(30).select((F.col("id") % 10).cast("string").alias("id"), F.lit("2024-01-01").cast("timestamp").alias("at"))
    df.write.parquet(path)
    stream = spark.readStream.schema(df.schema).parquet(path)
    S.dedupe_messages(stream, "id", "at").writeStream.format("parquet").option("path", out) \
        .option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(out).count() == 10


@pytest.mark.parametrize("bad", [None])
def test_scratch_needs_a_shared_folder_on_a_cluster(bad):
    class Context:
        master = "spark://host:7077"

    class Conf:
        def get(self, key, default):
            return bad

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        scratch_dir(Session())


def test_small_files_are_those_of_the_text_writer_and_nothing_else(spark, tmp_path):
    """Names with escapes, none at all, texts that are missing, empty, repeated; no checksum files, each of which would cost a process."""
    rows = [("a b+c", "x\ny"), ("a b+c", None), ("é=%/:?", "ü 漢"), (None, "none"), ("", "empty"), ("t{[]^'\"#*\\}\x7f\x01", ""), ("z", "last")]
    df = spark.createDataFrame(rows, "name string, text string").coalesce(1)
    df.write.partitionBy("name").text(str(tmp_path / "spark"))
    D.write_files(df, str(tmp_path / "own"))

    def found(at):
        read = D.read_texts(spark, str(tmp_path / at), glob="*.txt").collect()
        return sorted((r.processed_name.rsplit("/", 1)[0], sorted(r.text.split("\n"))) for r in read)

    assert found("own") == found("spark")
    assert {x.name for x in (tmp_path / "own").rglob("*") if x.is_file()} == {"part-00000.txt"}


def test_file_queries_store_no_checksums(spark, sf):
    from corpusloom.registry.storage_queries import _files

    root = pathlib.Path(_files(spark, sf).removeprefix("file:"))
    names = [x.name for x in root.rglob("*") if x.is_file()]
    assert len(names) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(name.endswith(".txt") and not name.startswith(".") for name in names)
