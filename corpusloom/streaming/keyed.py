"""Tracking records kept per document while it is being worked on, and forgotten some time after it is done.

Each open document has its folded record (a value) and its history (a list) in the state store. The event with a closing status
sets a timer; when it runs out, both are dropped, so the state holds the open documents and those lately closed, however
long the stream runs. Every batch hands on the records that changed. An event that comes after its document was forgotten opens
a record anew, and ``merge_records`` puts the records of a document together again.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from corpusloom.operators.tracking import FIRST_WINS, ITEM, LAST_WINS
from corpusloom.streaming.stages import Sink

ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# The store that keeps lists and timers; and no batches without data, which timers on the clock would ask for without end.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": ROCKS_DB, "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
# What a finished document's last status begins with.
CLOSING = "Successfully moved"
KEEP_SECONDS = 3600

_LAST = (*LAST_WINS, "last_source", "last_status", "last_time")


def _schemas(events: DataFrame) -> tuple[T.StructType, T.StructType, T.StructType]:
    """(record, history item, output) with the column types of ``events``."""
    kind = {f.name: f.dataType for f in events.schema.fields}
    record = T.StructType([
        T.StructField("first_seq", kind["seq"]), T.StructField("last_seq", kind["seq"]), T.StructField("n_events", T.LongType()),
        T.StructField("closed", T.BooleanType()), *[T.StructField(c, kind[c]) for c in FIRST_WINS],
        *[T.StructField(name, kind[c]) for name, c in zip(_LAST, (*LAST_WINS, *ITEM))],
    ])
    item = T.StructType([T.StructField("seq", kind["seq"]), *[T.StructField(c, kind[c]) for c in ITEM]])
    out = T.StructType([
        T.StructField("id", kind["id"]), *record.fields, T.StructField("history", T.ArrayType(item)),
    ])
    return record, item, out


def _plain(value):
    """A pandas cell as what the state store takes."""
    if hasattr(value, "tolist"):
        value = value.tolist()
    if isinstance(value, (list, tuple)):
        return [_plain(x) for x in value]
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime()
    return None if value is None or value is pd.NaT or value != value else value


class Record(StatefulProcessor):
    """Folds the events of one document into its record, each (id, seq) once."""

    def __init__(self, record: T.StructType, item: T.StructType, closing: str, keep_ms: int):
        self.record, self.item, self.closing, self.keep_ms = record, item, closing, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.value = handle.getValueState("record", self.record)
        self.history = handle.getListState("history", self.item)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        names = self.record.fieldNames()
        held = dict(zip(names, self.value.get())) if self.value.exists() else None
        seen = {x[0] for x in self.history.get()} if held else set()
        fresh = []
        for batch in rows:
            for row in batch.to_dict("records"):
                row = {c: _plain(v) for c, v in row.items()}
                if row["seq"] in seen:  # delivered before
                    continue
                seen.add(row["seq"])
                fresh.append(row)
        if not fresh:
            return
        for row in fresh:
            if held is None or row["seq"] < held["first_seq"]:
                first = {"first_seq": row["seq"], **{c: row[c] for c in FIRST_WINS}}
                held = {**(held or {"last_seq": None, "n_events": 0, "closed": False}), **first}
            if held["last_seq"] is None or row["seq"] > held["last_seq"]:
                held.update({name: row[c] for name, c in zip(_LAST, (*LAST_WINS, *ITEM))}, last_seq=row["seq"])
            held["n_events"] += 1
        closed = (held["last_status"] or "").startswith(self.closing)
        if closed and not held["closed"]:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.keep_ms)
        held["closed"] = closed
        self.value.update(tuple(held[c] for c in names))
        self.history.appendList([(row["seq"], *[row[c] for c in ITEM]) for row in fresh])
        items = sorted(self.history.get(), key=lambda x: x[0])
        yield pd.DataFrame({
            "id": [key[0]], **{c: pd.Series([held[c]], dtype=object) for c in names},
            "history": [[dict(zip(self.item.fieldNames(), x)) for x in items]],
        })

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.value.exists() and self.value.get()[self.record.fieldNames().index("closed")]:  # not opened again since
            self.value.clear()
            self.history.clear()
        return iter([])

    def close(self) -> None:
        pass


def tracking_records_stream(events: DataFrame, sink: Sink, checkpoint: str, closing: str = CLOSING,
                            keep_seconds: float = KEEP_SECONDS) -> StreamingQuery:
    """Hand the changed records of every batch to ``sink`` and forget a document ``keep_seconds`` after its closing status.

    Redeliveries are told by (id, seq) for as long as the document is remembered. Timers are looked at with the next batch of events.
    """
    spark = events.sparkSession
    record, item, out = _schemas(events)
    columns = ("id", "seq", *ITEM, *FIRST_WINS, *LAST_WINS)
    changed = events.select(*columns).groupBy("id").transformWithStateInPandas(
        Record(record, item, closing, int(keep_seconds * 1000)), out, "update", "ProcessingTime",
    )
    before = {name: spark.conf.get(name) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    try:
        return (
            changed.writeStream.outputMode("update").foreachBatch(sink)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def merge_records(changed: DataFrame) -> DataFrame:
    """Handed-on records to one flat record per id, equal to ``fold_tracking`` over all events.

    A document that was forgotten in between has several records; their ends and their different events are put together.
    """
    events = changed.select("id", F.explode("history.seq").alias("_seq")).groupBy("id").agg(F.count_distinct("_seq").alias("n_events"))
    first = F.struct(*[F.col(c) for c in FIRST_WINS])
    last = F.struct(*[F.col(c) for c in _LAST])
    ends = changed.groupBy("id").agg(F.min_by(first, "first_seq").alias("_first"), F.max_by(last, "last_seq").alias("_last"))
    return ends.join(events, "id").select("id", "_first.*", "_last.*", "n_events")
