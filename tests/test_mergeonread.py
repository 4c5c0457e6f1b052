"""The merge-on-read table: bytes written, concurrent writers, crashes, compaction, changes."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from casebook.operators import merge, reports
from casebook.streaming import mergeonread as mor
from casebook.streaming.mergeonread import Conflict, MergeOnReadTable

SCHEMA = "k long, v string, n long"


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def batch(spark, lo, hi, tag):
    return spark.range(lo, hi).select(F.col("id").alias("k"), F.concat(F.lit(tag), F.col("id").cast("string")).alias("v"), (F.col("id") % 5).alias("n"))


@pytest.fixture
def table(spark, tmp_path):
    t = MergeOnReadTable(f"file:{tmp_path}/t", "k", spark.createDataFrame([], SCHEMA).schema, buckets=8, rows_per_file=300)
    t.write_all(batch(spark, 0, 2000, "a"))
    return t


def test_merges_and_versions(spark, table):
    assert table.merge(batch(spark, 1990, 2010, "b")) == 2
    assert table.merge(batch(spark, 5, 6, "c")) == 3
    want = {k: f"a{k}" for k in range(2000)} | {k: f"b{k}" for k in range(1990, 2010)} | {5: "c5"}
    assert {r.k: r.v for r in table.read(spark).collect()} == want and table.read(spark).count() == 2010
    assert table.read(spark, 1).count() == 2000 and rows_of(table.read(spark, 2).where("k = 5")) == [(5, "a5", 0)]
    with pytest.raises(ValueError):
        table.read(spark, 9)


def test_merge_fn_sees_current_rows_and_may_delete(spark, table):
    def add(cur, new):
        return cur.join(new.select("k", F.col("n").alias("m")), "k").where("k <> 3").select("k", "v", (F.col("n") + F.col("m")).alias("n"))

    table.merge(batch(spark, 0, 5, "x"), add)
    assert rows_of(table.read(spark).where("k < 6")) == [(0, "a0", 0), (1, "a1", 2), (2, "a2", 4), (4, "a4", 8), (5, "a5", 0)]
    ok = spark.createDataFrame([("7", True), ("8", False)], "id string, ok boolean")
    schema = spark.createDataFrame([], "id string, updated_time timestamp").schema
    marks = MergeOnReadTable(f"{table.path}-marks", "id", schema, buckets=4)
    import datetime as dt

    marks.write_all(spark.createDataFrame([(str(k), None) for k in range(20)], schema))
    marks.merge(ok, lambda cur, o: merge.mark_updated(cur, o, "id", dt.datetime(2025, 1, 1)), batch_key="id")
    assert [r.id for r in marks.read(spark).where("updated_time IS NOT NULL").collect()] == ["7"] and marks.read(spark).count() == 20


def test_small_merge_writes_few_bytes(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.1/events.parquet").select("event_id", "user_id", "event_type", "value", "ts")
    t = MergeOnReadTable(f"file:{tmp_path}/events", "event_id", events.schema, buckets=64, rows_per_file=20_000)
    t.write_all(events)
    size = sum(x["bytes"] for x in t.state(spark).files.values())
    before = {f for f in glob.glob(f"{tmp_path}/events/**", recursive=True) if os.path.isfile(f)}
    some = events.where(F.xxhash64("event_id") % 100 == 0).withColumn("value", F.lit(-1.0).cast(events.schema["value"].dataType))
    n = some.count()
    assert events.count() / 150 < n < events.count() / 66
    t.merge(some)
    after = {f for f in glob.glob(f"{tmp_path}/events/**", recursive=True) if os.path.isfile(f)} - before
    assert sum(os.path.getsize(f) for f in after) < 0.05 * size
    assert t.read(spark).where("value = -1").count() == n and t.read(spark).count() == events.count()


def test_interleaved_merges(spark, table):
    """Two merges that read the same state: disjoint keys both survive, a shared key makes the later one conflict."""
    one, two = table.stage(batch(spark, 0, 10, "one")), table.stage(batch(spark, 10, 20, "two"))
    assert (table.publish(spark, one), table.publish(spark, two)) == (2, 3)
    assert {r.v[:3] for r in table.read(spark).where("k < 10").collect()} == {"one"}
    assert {r.v[:3] for r in table.read(spark).where("k BETWEEN 10 AND 19").collect()} == {"two"}
    for lo in (15, 5000):  # an updated key, and a key that is new in both
        first, second = table.stage(batch(spark, lo, lo + 2, "first")), table.stage(batch(spark, lo + 1, lo + 3, "second"))
        table.publish(spark, first)
        with pytest.raises(Conflict):
            table.publish(spark, second)
    assert table.read(spark).groupBy("k").count().where("count > 1").isEmpty()


def test_conflicting_merge_is_built_anew(spark, table, monkeypatch):
    raced = []
    plain = MergeOnReadTable.publish

    def racing(self, session, change):
        if not raced:
            raced.append(1)
            self.merge(batch(spark, 3, 4, "rival"), lambda cur, new: cur.withColumn("n", F.lit(100).cast("long")))
        return plain(self, session, change)

    monkeypatch.setattr(MergeOnReadTable, "publish", racing)
    seq = table.merge(batch(spark, 3, 4, "x"), lambda cur, new: cur.withColumn("n", F.col("n") + 1))
    assert seq == 3 and rows_of(table.read(spark).where("k = 3")) == [(3, "a3", 101)]


def test_log_names_are_taken_once(spark, table):
    assert not table._put_if_absent(spark, "log", f"{1:020d}.json", {"seq": 1})
    assert table.commits(spark)[0]["kind"] == "merge" and not table._names(spark, "_drafts")


def test_crash_before_the_commit(spark, table):
    want = rows_of(table.read(spark))
    table.stage(batch(spark, 0, 500, "lost"))  # the writer dies here
    assert rows_of(table.read(spark)) == want and table.state(spark).seq == 1
    assert table.vacuum(spark) >= 2 and rows_of(table.read(spark)) == want
    assert table.merge(batch(spark, 0, 500, "b")) == 2


def test_compaction(spark, table):
    for k in range(10):
        table.merge(batch(spark, 100 * k, 100 * k + 60, f"m{k}-"))
    want, files = rows_of(table.read(spark)), len(table.state(spark).files)
    seq = table.state(spark).seq
    stale = table.stage(batch(spark, 0, 2, "stale"))
    assert table.compact(spark) == seq + 1
    assert rows_of(table.read(spark)) == want and len(table.state(spark).files) < files
    with pytest.raises(Conflict):  # its vector names files that are gone
        table.publish(spark, stale)
    assert table.changes(spark, seq).count() == 0
    table.vacuum(spark)
    assert rows_of(table.read(spark)) == want and table.compact(spark, max_dead=1.0, max_files=10**6) is None


def test_checkpointed_log(spark, table, monkeypatch):
    monkeypatch.setattr(mor, "CHECKPOINT", 3)
    for k in range(7):
        table.merge(batch(spark, k, k + 3, f"m{k}-"))
    assert len(table._names(spark, "checkpoints")) == 2
    got = {r.k: r.v for r in table.read(spark).where("k < 9").collect()}
    assert got == {**{k: f"m{k}-{k}" for k in range(7)}, 7: "m6-7", 8: "m6-8"}
    assert table.state(spark, 4).seq == 4 and rows_of(table.read(spark, 2).where("k = 1")) == [(1, "m0-1", 1)]


def test_reports_follow_the_changes(spark, table):
    counts = reports.count_by(table.read(spark), ["n"], "rows")
    plans = [lambda c, b: b, lambda c, b: c.withColumn("n", F.lit(7).cast("long")), lambda c, b: c.where("false")]
    for k, fn in enumerate(plans):
        seq = table.merge(batch(spark, 1900 + k, 2050 + k, "z").withColumn("n", F.lit(k).cast("long")), fn)
        counts = reports.add_counts(counts, reports.count_changes(table.changes(spark, seq - 1, seq), ["n"], "rows"), ["n"], "rows")
        assert rows_of(counts) == rows_of(reports.count_by(table.read(spark), ["n"], "rows"))
    before = table.read(spark).count()
    seq = table.write_all(batch(spark, 0, 10, "new"))
    signs = {r._change: r["count"] for r in table.changes(spark, seq - 1).groupBy("_change").count().collect()}
    assert signs == {"before": before, "after": 10} and table.read(spark).count() == 10


def test_empty(spark, tmp_path):
    t = MergeOnReadTable(f"file:{tmp_path}/e", "k", spark.createDataFrame([], SCHEMA).schema)
    assert t.read(spark).count() == 0 and t.changes(spark, 0).count() == 0 and t.compact(spark) is None
    assert t.merge(batch(spark, 0, 0, "")) == 1 and t.read(spark).count() == 0
