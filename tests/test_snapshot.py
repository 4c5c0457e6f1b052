"""The snapshot table: one read per batch, no lost rows, last write wins, errors are not emptiness."""

import os
import random
import re
import uuid

import pytest
from pyspark.sql import functions as F

from casebook import jobs
from casebook.operators import merge
from casebook.session import scratch_path
from casebook.streaming.snapshot import BucketedSnapshot

HERE = os.path.dirname(os.path.abspath(__file__))
SCHEMA = "id string, updatedAt string, data string"


def snapshot(spark, name, buckets=8):
    schema = spark.createDataFrame([], SCHEMA).schema
    return BucketedSnapshot(scratch_path(spark, f"{name}-{uuid.uuid4().hex}"), "id", schema, buckets)


def replace(cur, new):
    return merge.replace_rows(cur, merge.latest_by_arrival(new, "id", ["updatedAt"]), "id")


def test_later_write_wins_over_null_and_equal_times(spark):
    snap = snapshot(spark, "later")
    for name in ("Zoe", "Amy"):
        snap.merge(spark.createDataFrame([("1", None, name), ("2", "2024-01-01", name)], SCHEMA), replace)
    assert {(r.id, r.data) for r in snap.read(spark).collect()} == {("1", "Amy"), ("2", "Amy")}


def test_a_source_that_changes_between_reads_loses_nothing(spark):
    snap = snapshot(spark, "changing")
    snap.write_all(spark.range(200).selectExpr("cast(id as string) id", "'a' updatedAt", "'x' data"))

    def batches(it):
        for b in it:
            yield b.assign(id=[str(random.randrange(200)) for _ in range(len(b))])

    snap.merge(spark.createDataFrame([("0", "b", "y")], SCHEMA).mapInPandas(batches, SCHEMA), replace)
    rows = snap.read(spark).collect()
    assert len(rows) == len({r.id for r in rows}) == 200 and sum(r.data == "y" for r in rows) == 1


def test_only_touched_buckets_are_read(spark):
    snap = snapshot(spark, "touched", 16)
    snap.write_all(spark.range(200).selectExpr("cast(id as string) id", "'a' updatedAt", "'x' data"))
    seen = []

    def probe(cur, new):
        seen.append((cur.count(), cur._jdf.queryExecution().executedPlan().toString()))
        return replace(cur, new)

    snap.merge(spark.createDataFrame([("7", "b", "y")], SCHEMA), probe)
    filters = re.search(r"PartitionFilters: \[(.*?)\], Pushed", seen[0][1])[1]
    assert 0 < seen[0][0] < 200 and "bucket" in filters
    assert snap.read(spark).count() == 200
    assert snap.vacuum(spark) == 0
    snap.write_all(snap.read(spark).checkpoint())
    assert snap.vacuum(spark) == 2 and snap.read(spark).count() == 200


def test_a_broken_table_raises(spark, tmp_path):
    snap = snapshot(spark, "broken")
    snap.path = str(tmp_path)
    (tmp_path / "manifest").mkdir()
    (tmp_path / "manifest" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        snap.read(spark).count()


def test_bucket_count_is_stored(spark):
    snap = snapshot(spark, "count", 4)
    snap.merge(spark.createDataFrame([("1", "a", "x")], SCHEMA), replace)
    other = BucketedSnapshot(snap.path, "id", snap.schema, 64)
    other.merge(spark.createDataFrame([("1", "b", "z"), ("2", "b", "z")], SCHEMA), replace)
    assert other.buckets == 4 and other.read(spark).count() == 2


def test_ingest_downloads_once(spark, tmp_path):
    spark.sparkContext.addPyFile(os.path.join(HERE, "fake_feed.py"))
    path = scratch_path(spark, f"once-{uuid.uuid4().hex}")
    jobs.ingest(spark, str(tmp_path), "fake_feed:fetch_logged", path, num_partitions=1)
    calls = [x for p in tmp_path.iterdir() for x in p.read_text().split()]
    assert len(calls) == len(set(calls)) == 1


def test_conversations_with_details_and_messages(spark):
    spark.sparkContext.addPyFile(os.path.join(HERE, "fake_feed.py"))
    root = scratch_path(spark, f"conv-{uuid.uuid4().hex}")
    counts = {r.kind: r.n for r in jobs.ingest_conversations(spark, "fake_feed:fetch_threads", root, num_partitions=2).collect()}
    assert counts == {"conversations": 9, "messages": 16, "dead_letters": 3}
    snap = BucketedSnapshot(f"{root}/messages", "id", spark.createDataFrame([], SCHEMA).schema)
    assert {r.id for r in snap.read(spark).collect()} == {f"c{c}-m{m}" for c in range(9) if c != 8 for m in range(2)}
    dead = {(r.kind, r.id) for r in spark.read.parquet(f"{root}/dead_letters").collect()}
    assert dead == {("conversation", "c9"), ("messages", "c8"), ("listing", None)}
    tickets = BucketedSnapshot(f"{root}/conversations", "id", spark.createDataFrame([], SCHEMA).schema).read(spark)
    assert tickets.where(F.col("data").contains("detail")).count() == 9
