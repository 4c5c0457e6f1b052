"""Streaming jobs: upsert sync (ST1, ST2), log tail (ST3), work queue (ST4).

All run with ``trigger(availableNow=True)`` in the catalogue (process what is
there, then stop) and with a processing-time trigger in production. State
that must survive restarts lives in the query checkpoint and in the snapshot
table, both under the shared folder.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from casebook.operators import backfill, merge, writeback
from casebook.streaming.mergeonread import MergeOnReadTable
from casebook.streaming.snapshot import BucketedSnapshot


def start_upsert_stream(stream: DataFrame, table: BucketedSnapshot | MergeOnReadTable, order: str, checkpoint: str,
                        available_now: bool = True, by_order: bool = False) -> StreamingQuery:
    """Upsert every micro-batch into ``table`` (idempotent on replay).

    Last write wins, as in ``jobs.ingest``: a key of the batch replaces its stored row whatever either holds, and
    ``order`` decides within the batch only (NULL before every value). ``by_order`` compares with the stored row too:
    the greatest ``order`` wins in whatever order rows arrive."""
    key = table.key

    def upsert(current: DataFrame, batch: DataFrame) -> DataFrame:
        if by_order:
            return merge.upsert_latest(current, batch, key, order)
        return merge.replace_rows(current, merge.latest_by_arrival(batch, key, [order]), key)

    def each(batch: DataFrame, batch_id: int) -> None:
        batch = batch.select(*[f.name for f in table.schema.fields])
        if isinstance(table, BucketedSnapshot) and not by_order:
            table.put(batch, [order])  # the same rows as ``upsert``, without rewriting the table for each batch
        else:
            table.merge(batch, upsert)

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def start_log_tail(lines: DataFrame, out_path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Stateless tail of a text log: ids of empty migrations appended to parquet."""
    ids = backfill.log_empty_ids(lines)
    w = ids.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint) \
        .outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def start_work_queue(pending: DataFrame, table: BucketedSnapshot, send: writeback.Send, run_ts: _dt.datetime,
                     checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Every micro-batch of pending rows is written back, and the rows whose
    write succeeded are marked processed in ``table``. At-least-once: a replayed
    batch sends the same idempotent payloads again and marks the same rows."""
    key = table.key

    def each(batch: DataFrame, batch_id: int) -> None:
        # Checkpoint the outcomes so the writer runs once per batch attempt,
        # however often the merge below reads them.
        outcomes = writeback.write_back(batch, send, key=key).checkpoint(eager=True)
        table.merge(outcomes, lambda cur, o: merge.mark_updated(cur, o, key, run_ts), batch_key="id")

    w = pending.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
