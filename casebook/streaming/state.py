"""Streams that keep their state in Spark's state store instead of rewriting a table (ST2).

``LastWrite`` holds one row for each key as a value state (RocksDB): the row that arrived last. Rows of one micro-batch
are ordered by their arrival columns, a later micro-batch always replaces an earlier one; the stream emits each changed
key once a batch. With ``idle``, a processing-time timer drops a key's state when nothing has come for that long; the
emitted rows are then the only copy, and a late-comer starts a new state, which changes no result, since the last
arrival wins whatever came before.

``replay_filter`` drops replayed records with a bound on its state: a record is remembered until the watermark passes
its event time by the window. ``late_rows`` counts what the watermark dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues
from pyspark.sql.types import StructType

STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


class LastWrite(StatefulProcessor):
    """Keeps, and emits when it changes, the row of each key that arrived last."""

    def __init__(self, schema: StructType, arrival: list[str], idle_ms: int | None = None):
        self.schema, self.arrival, self.idle_ms = schema, arrival, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", self.schema)
        self.due = handle.getValueState("due", "at long") if self.idle_ms is not None else None

    def _order(self, row: Row) -> tuple:
        """Arrival columns first, then the other values; NULL before every value."""
        rest = [n for n in self.schema.names if n not in self.arrival]
        return tuple((row[n] is not None, _comparable(row[n])) for n in [*self.arrival, *rest])

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        best = max(rows, key=self._order)
        values = tuple(best[n] for n in self.schema.names)
        self.last.update(values)
        if self.due is not None:
            if self.due.exists():
                self.handle.deleteTimer(self.due.get()[0])
            at = timerValues.getCurrentProcessingTimeInMs() + self.idle_ms
            self.handle.registerTimer(at)
            self.due.update((at,))
        yield Row(**dict(zip(self.schema.names, values)))

    def handleExpiredTimer(self, key: Any, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        self.last.clear()
        if self.due is not None:
            self.due.clear()
        return iter([])

    def close(self) -> None:
        pass


def _comparable(value: Any) -> Any:
    if value is None:
        return 0
    return tuple((v is not None, _comparable(v)) for v in value) if isinstance(value, (tuple, list)) else value


def start_last_write(stream: DataFrame, key: str, arrival: list[str], out_path: str, checkpoint: str, idle_ms: int | None = None,
                     every: str | None = None) -> StreamingQuery:
    """Append every changed row to ``out_path`` (Parquet, exactly once); the whole table is the state (``read_last_write``).

    Without ``every`` the stream takes what is there and ends. One with ``idle_ms`` has timers to wait for, so it needs
    ``every`` (say, '1 minute') and runs until it is stopped."""
    if idle_ms is not None and every is None:
        raise ValueError("a stream that drops idle keys needs a trigger interval")
    spark = stream.sparkSession
    rows = stream.groupBy(key).transformWithState(
        LastWrite(stream.schema, arrival, idle_ms), stream.schema, "Append", "None" if idle_ms is None else "ProcessingTime")
    w = rows.writeStream.outputMode("append").format("parquet").option("path", out_path).option("checkpointLocation", checkpoint)
    w = w.trigger(processingTime=every) if every else w.trigger(availableNow=True)
    with _settings(spark, STATE_CONF):  # a stream keeps the settings it was started with
        return w.start()


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def read_last_write(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The newest row of every key, read from the state of the stream's checkpoint."""
    with _settings(spark, STATE_CONF):
        df = spark.read.format("statestore").option("stateVarName", "last").load(checkpoint)
    return df.select("value.*")


def replay_filter(stream: DataFrame, event_time: str, keys: list[str], window: str) -> DataFrame:
    """The stream's records, each once: copies (equal ``keys``) that come within ``window`` of event time are dropped."""
    return stream.withWatermark(event_time, window).dropDuplicatesWithinWatermark(keys)


def late_rows(query: StreamingQuery) -> int:
    """Rows that the watermark dropped in the progress reports Spark still holds for this run (the newest hundred batches)."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
