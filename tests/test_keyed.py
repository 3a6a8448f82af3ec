"""Keyed tracking state: equal to the fold, and gone some time after the closing status."""

import datetime
import time

from pyspark.sql import functions as F

from corpusloom.operators.tracking import fold_tracking
from corpusloom.session import scratch_path
from corpusloom.streaming import keyed as K
from corpusloom.streaming import stages as S

SCHEMA = """id string, seq bigint, source string, status string, event_time timestamp, source_file_name string, recognizer_index int,
  processed_file_name string, container_name string, custom_fields array<string>"""


def event(id_, seq, status="Processing"):
    at = datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=seq)
    return (id_, seq, "stage", status, at, f"{id_}-{seq}.pdf", seq if seq % 2 else None, None if seq % 3 else f"r{seq}", "c", ["f", None] if seq % 2 else None)


class Flow:
    def __init__(self, spark, keep):
        self.spark, self.keep, self.n, self.events = spark, keep, 0, []
        self.waiting, self.out, self.checkpoint = (scratch_path(spark, x) for x in ("waiting", "records", "checkpoint"))

    def run(self, *events):
        """Deliver one batch; the number of rows in the state store after it."""
        self.spark.createDataFrame(list(events), SCHEMA).coalesce(1).write.parquet(f"{self.waiting}/{self.n}")
        self.n += 1
        self.events += events
        stream = self.spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(self.waiting)
        query = K.tracking_records_stream(stream, S.batch_folder(self.out), self.checkpoint, keep_seconds=self.keep)
        query.awaitTermination()
        assert query.exception() is None
        return query.lastProgress["stateOperators"][0]["numRowsTotal"]

    def changed(self):
        return self.spark.read.parquet(self.out)

    def check(self):
        once = self.spark.createDataFrame(self.events, SCHEMA).dropDuplicates(["id", "seq"])
        want = fold_tracking(once)
        got = K.merge_records(self.changed()).select(want.columns)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_records_equal_the_fold(spark):
    flow = Flow(spark, 3600)
    flow.run(event("a", 3), event("a", 1), event("b", 7), event("b", 7))
    flow.run(event("a", 2), event("b", 7), event("a", 5, None))  # late, redelivered, without a status
    flow.run(event("a", 3), event("b", 7))  # nothing new
    flow.check()
    assert flow.changed().groupBy("id").count().collect() != []
    newest = flow.changed().filter("id = 'a'").orderBy(F.desc("n_events")).first()
    assert [x["seq"] for x in newest["history"]] == [1, 2, 3, 5] and newest["closed"] is False
    assert flow.changed().filter("id = 'b'").count() == 1


def test_closed_documents_are_forgotten(spark):
    flow = Flow(spark, 0.5)
    names = [f"d{i}" for i in range(20)]
    opened = flow.run(*[event(n, s) for n in names for s in range(3)])
    flow.run(*[event(n, 3, "Successfully moved the file") for n in names[:15]], event(names[15], 3, "Successfully moved"))
    time.sleep(1)
    after = flow.run(event("z", 1))
    assert after < opened / 2
    flow.run(event("d0", 9), event("d0", 1))  # long forgotten: opened anew, and an old event delivered once more
    flow.check()


def test_settings_are_put_back(spark):
    before = {name: spark.conf.get(name) for name in K.SETTINGS}
    Flow(spark, 1).run(event("a", 1))
    assert {name: spark.conf.get(name) for name in K.SETTINGS} == before
