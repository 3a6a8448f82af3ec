"""Files below a local folder, listed and read by tasks as Spark's readers would."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from corpusloom.sources import documents as D
from corpusloom.sources import tree


def rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr)


@pytest.fixture
def folder(tmp_path):
    names = ["a.txt", "b c+d%20.txt", "é漢😀.md", "x=1/y=2/p.txt", "_x=1/q.txt", "_hidden/r.txt", ".hidden/s.txt", "deep/er/and/deeper/t.txt", "_u.txt",
             "_v=1.txt", ".w.txt", "z.txt._COPYING_", "_metadata", "empty.txt", "many[1]{2}*?.txt", "sub/_metadata/m.txt"]
    for i, name in enumerate(names):
        at = tmp_path / "in put" / name
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_bytes(b"" if name.startswith("empty") else f"text {i}\r\nü\n".encode() + b"\xff\x00")
        os.utime(at, ns=(10**18, 10**18 + 123_456_789 + i * 10**6))
    (tmp_path / "in put" / "no files").mkdir()
    (tmp_path / "in put" / "link").symlink_to(tmp_path / "in put" / "deep")
    (tmp_path / "in put" / "broken.txt").symlink_to(tmp_path / "nothing")
    return tmp_path / "in put"


@pytest.mark.parametrize("glob", [None, "*.txt", "{a,q,t}.t?t", "[^a]*.txt"])
def test_tasks_find_what_spark_finds(spark, folder, glob, monkeypatch):
    found = [(rows(D.list_documents(spark, at, glob=glob).drop("metadata")), rows(D.read_texts(spark, at, glob=glob).withColumn("text", F.hex("text")))) for at in (str(folder), f"file://{folder}/")]
    monkeypatch.setattr(D, "local_folder", lambda *_: None)
    want = rows(D.list_documents(spark, str(folder), glob=glob).drop("metadata")), rows(D.read_texts(spark, str(folder), glob=glob).withColumn("text", F.hex("text")))
    assert want[0] and found == [want, want]


def test_the_driver_keeps_no_list_of_files(spark, folder):
    for df in (D.list_documents(spark, str(folder)), D.read_texts(spark, str(folder))):
        plan = df._jdf.queryExecution().toString()
        assert "binaryFile" not in plan and "FileScan text" not in plan


def test_batches_lose_no_file(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tree, "BATCH_ROWS", 3)
    monkeypatch.setattr(tree, "BATCH_BYTES", 20)
    for i in range(50):
        (tmp_path / f"{i}.txt").write_text("x" * (i + 1))
    assert rows(D.read_texts(spark, str(tmp_path))) == sorted([(f"{i}.txt", "x" * (i + 1)) for i in range(50)], key=repr)
    assert D.list_documents(spark, str(tmp_path)).agg(F.sum("length")).first()[0] == 51 * 25


def test_compressed_files_and_other_paths(spark, tmp_path):
    (tmp_path / "a.txt.gz").write_bytes(gzip.compress(b"packed"))
    (tmp_path / "b.txt").write_text("plain")
    assert rows(D.read_texts(spark, str(tmp_path))) == [("a.txt.gz", "packed"), ("b.txt", "plain")]
    assert [r["length"] for r in D.list_documents(spark, f"{tmp_path}/b.txt").collect()] == [5]
    assert D.list_documents(spark, f"{tmp_path}/*.txt").count() == 1
    (tmp_path / "none").mkdir()
    assert D.list_documents(spark, str(tmp_path / "none")).count() == 0 == D.read_texts(spark, str(tmp_path / "none")).count()
