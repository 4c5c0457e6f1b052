"""The paged feed data source: all pages, retries, id and range pushdown."""

from pyspark.sql import functions as F

from casebook.sources.paged import register, split_range


def _reader(spark, **opts):
    import os

    register(spark)
    # The fetcher is user code: ship it to the Python workers.
    spark.sparkContext.addPyFile(os.path.join(os.path.dirname(os.path.abspath(__file__)), "fake_feed.py"))
    r = spark.read.format("paged_feed").option("fetcher", "fake_feed:fetch").option("pageSize", "10")
    for k, v in opts.items():
        r = r.option(k, v)
    return r.load()


def test_reads_every_page_with_retry(spark):
    df = _reader(spark, entity="users")
    assert df.count() == 57 and df.select("id").distinct().count() == 57


def test_id_filter_is_a_point_lookup(spark):
    df = _reader(spark).where(F.col("id") == "t005")
    assert [r.id for r in df.collect()] == ["t005"]


def test_range_shards(spark):
    df = _reader(spark, modifiedAfter="2024-03-01", modifiedBefore="2024-03-05", numPartitions="3")
    assert df.rdd.getNumPartitions() == 3
    assert df.count() == sum(1 for i in range(57) if i % 20 <= 4)


def test_split_range_covers_days():
    s = split_range("2024-03-01", "2024-03-10", 3)
    assert s[0]["modifiedAfter"] == "2024-03-01" and s[-1]["modifiedBefore"] == "2024-03-10"
    assert len(s) == 3


def test_stream_sync_upserts_every_record(spark):
    import os
    import uuid

    from casebook.session import scratch_path
    from casebook.streaming import jobs
    from casebook.streaming.snapshot import BucketedSnapshot

    register(spark)
    spark.sparkContext.addPyFile(os.path.join(os.path.dirname(os.path.abspath(__file__)), "fake_feed.py"))
    run = scratch_path(spark, f"feed-stream-{uuid.uuid4().hex}")
    src = (spark.readStream.format("paged_feed").option("fetcher", "fake_feed:fetch").option("pageSize", "10")
           .option("startingAfter", "2024-01-01").option("numPartitions", "4").load())
    snap = BucketedSnapshot(f"{run}/snapshot", "id", spark.range(0).selectExpr(
        "cast(null as string) id", "cast(null as string) updatedAt", "cast(null as string) data").schema, buckets=4)
    jobs.start_upsert_stream(src, snap, "updatedAt", f"{run}/checkpoint").awaitTermination()
    out = snap.read(spark)
    assert out.count() == 57 and out.select("id").distinct().count() == 57


def test_pages_per_key_follow_each_chain(spark):
    import os

    from casebook.sources.paged import fetch_pages_per_key

    spark.sparkContext.addPyFile(os.path.join(os.path.dirname(os.path.abspath(__file__)), "fake_feed.py"))
    keys = spark.createDataFrame([("c1",), ("c2",)], "key string")
    out = fetch_pages_per_key(keys, "fake_feed:fetch", page_size=10)
    rows = out.collect()
    assert len(rows) == 2 * 57 and all(r.error is None for r in rows)
    assert {r.key for r in rows} == {"c1", "c2"}


def _times(spark, cond, **opts):
    return _reader(spark, **opts).where(cond).count()


def test_time_bounds_are_exact(spark):
    """Pushed bounds narrow the request to days; Spark still applies them to the rows."""
    at = "updatedAt"
    want = sum(1 for i in range(57) if i % 20 >= 18)
    assert _times(spark, F.col(at) >= "2024-03-19T05:00") == want
    assert _times(spark, F.col(at) >= "2024-03-19T15:00") == sum(1 for i in range(57) if i % 20 >= 19)
    assert _times(spark, F.col(at) <= "2024-03-01T02:00") == 0
    assert _times(spark, (F.col("id") == "t005") & (F.col(at) >= "2024-03-19")) == 0
    assert _times(spark, F.col(at) >= "2024-01-01", modifiedAfter="2024-03-20") == sum(1 for i in range(57) if i % 20 == 19)


def test_shards_of_every_range():
    from casebook.sources.paged import PagedReader

    def shards(lo, hi, **o):
        return PagedReader({"fetcher": "x:y", "numPartitions": "4", **o}).shards(lo, hi)

    assert shards(None, None) == [{}] and shards("2024-03-01", None) == [{"modifiedAfter": "2024-03-01"}]
    day = shards("2024-03-01", "2024-03-01", hours="true")
    assert len(day) == 4 and day[0]["modifiedAfter"] == "2024-03-01T00:00:00.000Z" and day[-1]["modifiedBefore"] == "2024-03-01T23:59:59.999Z"
    assert all(a["modifiedBefore"] < b["modifiedAfter"] for a, b in zip(day, day[1:]))
    for lo, hi in ((None, None), ("2024-03-01", None), (None, "2024-03-09")):
        s = shards(lo, hi, timed="true")
        assert len(s) >= 4 and ("modifiedAfter" in s[0]) == bool(lo) and ("modifiedBefore" in s[-1]) == bool(hi)
        assert all(a["modifiedBefore"] < b["modifiedAfter"] for a, b in zip(s, s[1:]))


def test_open_ranges_read_every_record_once(spark):
    df = _reader(spark, numPartitions="5", timed="true")
    assert df.rdd.getNumPartitions() >= 5 and df.count() == 57 and df.select("id").distinct().count() == 57
