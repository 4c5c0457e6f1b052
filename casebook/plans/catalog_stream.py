"""Streaming twins (ST1-ST4): each runs a Structured Streaming query with
``availableNow`` over files Spark derives from the driver tables, then
returns the resulting table. Same oracles as their batch twins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from casebook import schemas
from casebook.operators import writeback
# The batch twins register the oracles reused below.
from casebook.plans import catalog_classify, catalog_fields, catalog_merge  # noqa: F401
from casebook.plans import doubles
from casebook.plans.catalog_merge import RUN_TS, _dated
from casebook.plans.common import CFG, Fixture
from casebook.plans.fixture_sql import with_
from casebook.plans.registry import ORACLES, query
from casebook.session import scratch_path
from casebook.sources import fixtures as fx
from casebook.streaming import jobs
from casebook.streaming.snapshot import BucketedSnapshot


def _run_dir(spark, name):
    return scratch_path(spark, f"casebook-runs/{name}-{uuid.uuid4().hex}")


def _stage(df, path, slices, slice_col):
    """Write ``df`` as ``slices`` appends (separate files) for a file stream to pick up."""
    for i in range(slices):
        df.where(F.pmod(F.col(slice_col), F.lit(slices)) == i).drop(slice_col) \
            .write.mode("append").parquet(path)


@query("stream_upsert", ORACLES["upsert_latest"])
def q_stream_upsert(spark, sf_dir):
    run = _run_dir(spark, "upsert")
    ev = Fixture(spark, sf_dir).t.events.select("user_id", "event_id", "ts", "event_type", "value", "props")
    _stage(ev.withColumn("_s", F.col("event_id")), f"{run}/in", 3, "_s")
    snap = BucketedSnapshot(f"{run}/snapshot", "user_id", ev.schema, buckets=16)
    src = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 8).parquet(f"{run}/in")
    jobs.start_upsert_stream(src, snap, "event_id", f"{run}/checkpoint", by_order=True).awaitTermination()
    return snap.read(spark)


@query("stream_sync", with_("t") + """
SELECT id, strftime(upd, '%Y-%m-%d') || 'T12:00:00.000Z' AS updatedAt FROM t""")
def q_stream_sync(spark, sf_dir):
    run = _run_dir(spark, "sync")
    docs = Fixture(spark, sf_dir).tickets_raw().select(
        "id", F.get_json_object("data", "$.updatedAt").alias("updatedAt"), "data")
    # An older version of every fourth ticket arrives first (latest must win).
    old = docs.where(F.col("id").cast("long") % 4 == 0).select(
        "id", F.get_json_object("data", "$.createdAt").alias("updatedAt"), "data")
    old.write.mode("append").parquet(f"{run}/in")
    _stage(docs.withColumn("_s", F.col("id").cast("long")), f"{run}/in", 2, "_s")
    snap = BucketedSnapshot(f"{run}/snapshot", "id", docs.schema, buckets=16)
    src = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 8).parquet(f"{run}/in")
    jobs.start_upsert_stream(src, snap, "updatedAt", f"{run}/checkpoint").awaitTermination()
    return snap.read(spark).select("id", "updatedAt")


@query("stream_log_tail", ORACLES["log_empty_ids"])
def q_stream_log_tail(spark, sf_dir):
    run = _run_dir(spark, "logtail")
    f = Fixture(spark, sf_dir)
    fx.migration_log(f.t.orders, f.t.customer, CFG).write.mode("overwrite").text(f"{run}/in")
    src = spark.readStream.text(f"{run}/in")
    jobs.start_log_tail(src, f"{run}/out", f"{run}/checkpoint").awaitTermination()
    return spark.read.schema("conversation_id string").parquet(f"{run}/out")


@query("stream_work_queue", ORACLES["mark_updated"])
def q_stream_work_queue(spark, sf_dir):
    run = _run_dir(spark, "queue")
    f = Fixture(spark, sf_dir)
    classes = f.classes()
    snap = BucketedSnapshot(f"{run}/snapshot", "conversation_id", schemas.CLASSIFICATION, buckets=16)
    snap.write_all(classes)
    pend = writeback.pending_updates(snap.read(spark), f.clusters(), limit=None) \
        .withColumn("payload", F.to_json(F.struct("category", "resolution"))) \
        .select("conversation_id", "payload")
    _stage(pend.withColumn("_s", F.col("conversation_id").cast("long")), f"{run}/in", 2, "_s")
    src = spark.readStream.schema("conversation_id string, payload string").option("maxFilesPerTrigger", 8) \
        .parquet(f"{run}/in")
    jobs.start_work_queue(src, snap, doubles.KeyModuloFailures(17), RUN_TS, f"{run}/checkpoint") \
        .awaitTermination()
    return _dated(snap.read(spark))

