"""Messages that fail come back, are counted, and are given up in the end."""

from pyspark.sql import functions as F

from corpusloom.operators.messages import decode_messages
from corpusloom.session import scratch_path
from corpusloom.sources import queues as Q
from corpusloom.streaming import redelivery as R
from corpusloom.streaming import stages as S

SCHEMA = "id int, fails int"


def stage(batch):
    """Fails as many times as the message says; unreadable ones always."""
    from pyspark.sql import types as T

    read = decode_messages(batch, T.StructType.fromDDL(SCHEMA), required="id")
    late = F.when(F.col("attempt") <= F.col("fails"), "not yet")
    return read.withColumn("reject_reason", F.coalesce("reject_reason", late))


def test_messages_come_back_until_they_pass(spark):
    queue, done, dead, checkpoint = (scratch_path(spark, x) for x in ("queue", "done", "dead", "checkpoint"))
    sent = spark.createDataFrame([(i, i % 4) for i in range(40)], SCHEMA)
    Q.send(sent, queue)
    spark.createDataFrame([("broken {",)], "value string").write.mode("append").text(queue)
    args = (spark, queue, stage, S.batch_folder(done), checkpoint, dead, 3)
    assert R.drain(*args) == 3
    passed = sorted((r["id"], r["attempt"]) for r in spark.read.parquet(done).select("id", "attempt").collect())
    assert passed == [(i, i % 4 + 1) for i in range(40) if i % 4 < 3]  # as the batch would give, each once
    gone = sorted((r["value"], r["attempt"], r["reject_reason"]) for r in spark.read.parquet(dead).collect())
    assert len(gone) == 11 and gone[0] == ("broken {", 3, "unreadable message") and {g[1:] for g in gone[1:]} == {(3, "not yet")}
    # Nothing waits any more; a message sent later is taken up where the checkpoint stands.
    assert R.drain(*args) == 0
    Q.send(spark.createDataFrame([(99, 1)], SCHEMA), queue)
    assert R.drain(*args) == 2 and spark.read.parquet(done).filter("id = 99").select("attempt").first()[0] == 2


def test_a_message_that_looks_like_an_envelope(spark):
    rows = spark.createDataFrame([('{"body":"x"}',), ('{"body":"{\\"id\\":1}","attempt":4}',), ("",), (None,)], "value string")
    assert [tuple(r) for r in R.opened(rows).collect()] == [('{"body":"x"}', 1), ('{"id":1}', 4), ("", 1), (None, 1)]
