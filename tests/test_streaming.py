"""Bucketed snapshot merges: only touched buckets change, and a replayed batch is harmless."""

import datetime as dt
import uuid

from casebook.operators import fields, merge
from casebook.session import scratch_path
from casebook.streaming.snapshot import BucketedSnapshot


def _upsert(cur, new):
    return merge.upsert_latest(cur, merge.latest_per_key(new, "id", "v"), "id", "v")


def test_replayed_batch_is_idempotent(spark):
    schema = "id string, name string, v int"
    snap = BucketedSnapshot(scratch_path(spark, f"snap-{uuid.uuid4().hex}"), "id",
                            spark.createDataFrame([], schema).schema, buckets=4)
    snap.write_all(spark.createDataFrame([(str(i), f"n{i}", 0) for i in range(40)], schema))
    batch = spark.createDataFrame([("3", "x", 1), ("41", "new", 1), ("3", "y", 2)], schema)
    snap.merge(batch, _upsert)
    first = sorted(tuple(r) for r in snap.read(spark).collect())
    snap.merge(batch, _upsert)  # replay after a failure
    assert sorted(tuple(r) for r in snap.read(spark).collect()) == first
    got = {r.id: (r.name, r.v) for r in snap.read(spark).collect()}
    assert got["3"] == ("y", 2) and got["41"] == ("new", 1) and got["7"] == ("n7", 0) and len(got) == 41


def test_modified_between_id_takes_precedence(spark):
    df = spark.createDataFrame([("a", "2024-03-01T10:00:00Z"), ("b", "2024-03-20T00:00:00Z"),
                                ("c", "2024-04-01T00:00:00Z")], "id string, updatedAt string")
    rng = {r.id for r in fields.modified_between(df, "2024-3-1", "2024-3-20").collect()}
    assert rng == {"a", "b"}
    assert {r.id for r in fields.modified_between(df, "2024-3-1", "2024-3-20", ticket_id="c").collect()} == {"c"}
    assert {r.id for r in fields.modified_between(df, lo="2024-03-02").collect()} == {"b", "c"}
    try:
        fields.modified_between(df, "invalid-date")
        raise AssertionError("expected ValueError")
    except ValueError:
        pass
    assert dt.date(2024, 3, 1)


def test_put_writes_the_batch_and_not_the_table(spark):
    schema = spark.createDataFrame([], "id string, v string, n int").schema
    root = scratch_path(spark, f"put-{uuid.uuid4().hex}")
    snap, old = (BucketedSnapshot(f"{root}/{x}", "id", schema, buckets=4) for x in ("put", "merged"))

    def upsert(cur, new):
        return merge.replace_rows(cur, merge.latest_by_arrival(new, "id", ["v"]), "id")

    batches = [[(str(i), "b", 0) for i in range(200)] + [("0", None, 9), (None, "a", 0)],
               [(str(i), "a", 1) for i in range(0, 200, 50)] + [("0", "0", 7), (None, "z", 1), ("new", None, 1)],
               [("50", "x", 2), ("50", "x", 3), ("new", "y", 2)]]
    for k, rows in enumerate([*batches, batches[-1]]):  # the last one comes again
        batch = spark.createDataFrame(rows, schema)
        snap.put(batch, ["v"])
        old.merge(batch, upsert)
        written = spark.read.parquet(f"{snap.path}/data/version={k + 1}").count()
        assert written == len({r[0] for r in rows})
        assert sorted(map(str, snap.read(spark).collect())) == sorted(map(str, old.read(spark).collect()))
    want = sorted(map(str, snap.read(spark).collect()))
    snap.compact(spark)
    assert sorted(map(str, snap.read(spark).collect())) == want
    assert all(len(v) == 1 for v in snap._manifest(spark)[1].values())
    snap.merge(spark.createDataFrame([("7", "m", 5)], schema), upsert)
    assert {(r.v, r.n) for r in snap.read(spark).where("id = '7'").collect()} == {("m", 5)}


def test_upsert_stream_keeps_earlier_files(spark):
    from casebook.streaming import jobs

    root = scratch_path(spark, f"stream-put-{uuid.uuid4().hex}")
    df = spark.range(400).selectExpr("cast(id % 100 as string) id", "cast(id div 100 as string) v")
    for k in range(4):
        df.where(f"v = '{k}'").coalesce(1).write.mode("append").parquet(f"{root}/in")
    snap = BucketedSnapshot(f"{root}/snapshot", "id", df.schema, buckets=4)
    src = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    jobs.start_upsert_stream(src, snap, "v", f"{root}/checkpoint").awaitTermination()
    rows = [spark.read.parquet(f"{root}/snapshot/data/version={k}").count() for k in (1, 2, 3, 4)]
    assert rows == [100] * 4 and {tuple(r) for r in snap.read(spark).collect()} == {(str(k), "3") for k in range(100)}
    assert {len(v) for v in snap._manifest(spark)[1].values()} == {4}  # named, none rewritten
