"""Job entry points on small inputs: feed ingest with upsert, detail fetch, dry-run tagging."""

import os
import uuid

from pyspark.sql import functions as F

from casebook import jobs
from casebook.plans import doubles
from casebook.config import FIXTURE_SETTINGS as FX
from casebook.session import scratch_path
from casebook.sources import fixtures as fx
from casebook.sources.paged import fetch_details
from casebook.sources.tables import Tables
from casebook.streaming.mergeonread import MergeOnReadTable

HERE = os.path.dirname(os.path.abspath(__file__))


def _feed_table(spark, path):
    from casebook.streaming.snapshot import BucketedSnapshot

    schema = spark.range(0).selectExpr("'' id", "'' updatedAt", "'' data").schema
    return BucketedSnapshot(path, "id", schema).read(spark, with_bucket=True)


def test_ingest_is_idempotent(spark):
    spark.sparkContext.addPyFile(os.path.join(HERE, "fake_feed.py"))
    path = scratch_path(spark, f"ingest-{uuid.uuid4().hex}")
    for _ in range(2):
        jobs.ingest(spark, "conversations", "fake_feed:fetch", path, num_partitions=2)
    df = _feed_table(spark, path)
    assert df.count() == 57 and df.select("id").distinct().count() == 57
    assert df.select("bucket").distinct().count() > 1


def test_ingest_into_a_merge_on_read_table(spark):
    spark.sparkContext.addPyFile(os.path.join(HERE, "fake_feed.py"))
    path = scratch_path(spark, f"ingest-{uuid.uuid4().hex}")
    for _ in range(2):
        jobs.ingest(spark, "conversations", "fake_feed:fetch", path, num_partitions=2, merge_on_read=True)
    schema = spark.createDataFrame([], "id string, updatedAt string, data string").schema
    table = MergeOnReadTable(path, "id", schema)
    assert table.state(spark).seq == 2 and table.read(spark).count() == 57 == table.read(spark).select("id").distinct().count()


def test_detail_fetch_keeps_failures(spark):
    spark.sparkContext.addPyFile(os.path.join(HERE, "fake_feed.py"))
    ids = spark.createDataFrame([("t001",), ("t002",)], "id string")
    out = fetch_details(ids, "fake_feed:fetch", attempts=1).collect()
    assert {r.id for r in out} == {"t001", "t002"}
    assert all((r.data is None) == (r.error is not None) for r in out)


def test_tag_dry_run_sends_nothing(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    calls = []

    def send(k, b):  # would fail the job if ever called from a task
        raise AssertionError("dry run must not send")

    plan = jobs.tag_open_tickets(fx.ticket_documents(t.orders, t.customer, FX), fx.reactions(t.orders, FX), send, FX)
    statuses = {r.status for r in plan.collect()}
    assert statuses <= {"skipped", "would_add"} and not calls
    assert plan.where(F.col("status") == "would_add").count() > 0


def _fixture_snapshot(spark, t):
    from casebook import schemas
    from casebook.streaming.snapshot import BucketedSnapshot

    snap = BucketedSnapshot(scratch_path(spark, f"classes-{uuid.uuid4().hex}"), "conversation_id",
                            schemas.CLASSIFICATION, buckets=4)
    snap.write_all(fx.classifications(t.orders))
    return snap


def test_write_back_job_marks_successes(spark):
    import datetime as dt

    from casebook.operators import writeback

    t = Tables(spark, "/root/testdata/sf0.001")
    snap = _fixture_snapshot(spark, t)
    run = dt.datetime(2030, 1, 1)
    log = scratch_path(spark, f"outcomes-{uuid.uuid4().hex}")
    out = jobs.write_back_job(snap, fx.clusters(t.orders), doubles.KeyModuloFailures(17), FX, run, limit=None,
                              outcome_log=log, run_id="r1")
    ok = {r.id for r in out.where("ok").collect()}
    marked = {r.conversation_id for r in snap.read(spark).where(F.col("updated_time") == F.lit(run)).collect()}
    assert ok and ok == marked
    logged = spark.read.parquet(log)
    assert logged.where("run_id = 'r1'").count() == out.count()


def test_classify_migrate_backfill_jobs_run(spark):
    import datetime as dt

    from casebook.operators import classify, threads, writeback

    t = Tables(spark, "/root/testdata/sf0.001")
    snap = _fixture_snapshot(spark, t)
    docs = fx.ticket_documents(t.orders, t.customer, FX)
    ex = threads.ticket_extract(docs, fx.message_documents(t.conversations, FX), snap.read(spark), FX)
    n = ex.count()  # the job replaces snapshot buckets this extract reads
    res = jobs.classify_job(ex, snap, doubles.KeywordModel(FX.chat_host), dt.datetime(2030, 1, 1), batch_size=5)
    assert res.count() == n
    stats = jobs.migrate_fields(docs, FX, doubles.KeyModuloFailures(17)).where("batch IS NULL").first()
    assert stats.processed == docs.count() and stats.failed > 0
    assert jobs.migrate_fields(docs, FX, doubles.KeyModuloFailures(17), dry_run=True).count() == 5
    funnel = jobs.backfill_categories(fx.migration_log(t.orders, t.customer, FX), fx.staging(t.orders), docs,
                                      fx.thread_documents(t.conversations, FX), doubles.KeywordModel(FX.chat_host),
                                      doubles.KeyModuloFailures(17), FX).first()
    assert funnel.total_conversations > 0


def test_ingest_all_entities(spark):
    spark.sparkContext.addPyFile(os.path.join(HERE, "fake_feed.py"))
    root = scratch_path(spark, f"all-{uuid.uuid4().hex}")
    jobs.ingest_all(spark, "fake_feed:fetch", root, num_partitions=2)
    for entity in jobs.ENTITIES:
        assert _feed_table(spark, f"{root}/{entity}").count() == 57


class CountingSend:
    """Appends one file per call to a folder that all local workers see."""

    def __init__(self, folder):
        self.folder = folder

    def __call__(self, key, body):
        import uuid as u

        with open(os.path.join(self.folder, u.uuid4().hex), "w") as f:
            f.write(key)
        if key.endswith("3"):
            raise RuntimeError("already_reacted")


def test_jobs_send_once(spark, tmp_path):
    """Results can be read often; the writer runs once, within the job."""
    from casebook.plans import doubles

    spark.sparkContext.addPyFile(os.path.join(HERE, "test_jobs.py"))
    t = Tables(spark, "/root/testdata/sf0.001")
    docs = fx.ticket_documents(t.orders, t.customer, FX)
    calls = lambda d: len(list(d.iterdir()))
    tag, mig, back = (tmp_path / x for x in ("tag", "mig", "back"))
    for d in (tag, mig, back):
        d.mkdir()
    plan = jobs.tag_open_tickets(docs, fx.reactions(t.orders, FX), CountingSend(str(tag)), FX, dry_run=False)
    n = calls(tag)
    status = {r.status: r["count"] for r in plan.groupBy("status").count().collect()}
    assert n > 0 and "failed" not in status and plan.where("status = 'added'").count() == status["added"]
    assert calls(tag) == n
    stats = jobs.migrate_fields(docs, FX, CountingSend(str(mig)))
    n = calls(mig)
    stats.collect(), stats.where("batch IS NULL").collect()
    assert n >= docs.count() and calls(mig) == n
    funnel = jobs.backfill_categories(fx.migration_log(t.orders, t.customer, FX), fx.staging(t.orders), docs,
                                      fx.thread_documents(t.conversations, FX), doubles.KeywordModel(FX.chat_host),
                                      CountingSend(str(back)), FX)
    n = calls(back)
    funnel.collect(), funnel.count()
    assert calls(back) == n


def test_backfill_takes_hex_ids(spark):
    from casebook import schemas
    from casebook.operators import backfill
    from casebook.plans import doubles

    ids = spark.createDataFrame([("0a1b-ff",), ("0a1b-00",), ("dead-01",)], "conversation_id string")
    names = [f.name for f in schemas.STAGING.fields]
    row = {"conversation_id": "0a1b-ff", "ticket_category": "Cat", "ticket_sub_category": "Sub", "ticket_resolution": "Res"}
    staging = spark.createDataFrame([tuple(row.get(c) for c in names)], schemas.STAGING)
    none = spark.createDataFrame([], "id string, data string")
    thread = spark.createDataFrame([("dead-01", '{"messages": [{"content": "the data"}]}')], "id string, data string")
    got = {r.conversation_id: r.source for r in backfill.backfill(ids, staging, none, thread, doubles.KeywordModel("x"), FX).collect()}
    assert got == {"0a1b-ff": "warehouse", "0a1b-00": "none", "dead-01": "model"}
