"""Tables that are kept up to date: merge on read, keyed state, replays, change-fed reports, paged listings, chunked
threads (K1, K3, ST2, G2-G5, L1, L2, W2)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from casebook.functions.columns import strict_date
from casebook.operators import classify, merge, paging, reports, silver, tagging, threads, variants
from casebook.operators.fields import modified_between, with_categories
from casebook.plans import catalog_classify, catalog_core, catalog_fields, catalog_merge, catalog_tagging  # noqa: F401
from casebook.plans.common import CFG, Fixture
from casebook.plans.fixture_sql import with_
from casebook.plans.registry import ORACLES, query
from casebook.session import scratch_path
from casebook.streaming import jobs, state
from casebook.streaming.mergeonread import MergeOnReadTable

BATCH = catalog_classify.BATCH


def _run_dir(spark, name):
    return scratch_path(spark, f"casebook-runs/{name}-{uuid.uuid4().hex}")


def _arrivals(spark, sf_dir):
    """Events as three runs of updates per user; many have a NULL or equal time."""
    n = F.col("event_id")
    return Fixture(spark, sf_dir).t.events.select(
        "user_id", (n % 3).alias("run"),
        F.when(n % 4 == 0, None).when(n % 4 < 3, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
        .otherwise(F.col("ts").cast("timestamp_ntz")).alias("updated"), "event_id", "value", "event_type")


def _merged_runs(spark, sf_dir, name):
    ev = _arrivals(spark, sf_dir)
    table = MergeOnReadTable(f"{_run_dir(spark, name)}/table", "user_id", ev.schema, buckets=16)
    for run in range(3):
        table.merge(merge.latest_by_arrival(ev.where(F.col("run") == run), "user_id", ["updated"]))
    return table


@query("merge_on_read", ORACLES["upsert_arrival"])
def q_merge_on_read(spark, sf_dir):
    """Three merges as delta files and deletion vectors, then a compaction; readers see the newest rows throughout."""
    table = _merged_runs(spark, sf_dir, "mor")
    table.compact(spark)
    return table.read(spark).drop("event_type")


_BY_RUN = """
  SELECT r.run AS as_of, e.user_id, e.event_type, e.value FROM (SELECT unnest([0, 1, 2]) AS run) r JOIN (
    SELECT user_id, event_id % 3 AS run, event_id, value, event_type,
      CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 4 < 3 THEN TIMESTAMP '2024-01-01 00:00:00' ELSE ts END AS updated
    FROM events) e ON e.run <= r.run
  QUALIFY row_number() OVER (PARTITION BY r.run, e.user_id ORDER BY e.run DESC, updated DESC NULLS LAST, event_id DESC) = 1"""


@query("table_changes", f"""
WITH s AS ({_BY_RUN}),
b AS (SELECT a.as_of + 1 AS commit, a.user_id, a.event_type, a.value FROM s a),
o AS (SELECT b.commit + 1 AS commit, b.user_id, b.event_type, b.value FROM b),
u AS (SELECT user_id, event_id % 3 + 1 AS commit FROM events GROUP BY ALL)
SELECT CAST(u.commit AS BIGINT) AS commit, 'after' AS change, b.user_id, b.event_type, b.value FROM u JOIN b USING (user_id, commit)
UNION ALL
SELECT CAST(u.commit AS BIGINT), 'before', o.user_id, o.event_type, o.value FROM u JOIN o USING (user_id, commit)""")
def q_table_changes(spark, sf_dir):
    """Every row that a merge replaced, before and after."""
    changes = _merged_runs(spark, sf_dir, "changes").changes(spark, 0)
    return changes.select(F.col("_seq").alias("commit"), F.col("_change").alias("change"), "user_id", "event_type", "value")


@query("report_upkeep", f"""
WITH s AS ({_BY_RUN})
SELECT CAST(as_of + 1 AS BIGINT) AS commit, event_type, COUNT(*) AS n FROM s GROUP BY ALL""")
def q_report_upkeep(spark, sf_dir):
    """Counts by type after each of three merges, from the changes alone."""
    table = _merged_runs(spark, sf_dir, "reports")
    counts, out = None, None
    for seq in range(1, 4):
        delta = reports.count_changes(table.changes(spark, seq - 1, seq), ["event_type"])
        counts = delta if counts is None else reports.add_counts(counts, delta, ["event_type"])
        now = counts.select(F.lit(seq).cast("long").alias("commit"), "event_type", "n")
        out = now if out is None else out.unionByName(now)
    return out


@query("stream_last_write", ORACLES["upsert_arrival"])
def q_stream_last_write(spark, sf_dir):
    """Keyed state: three runs of one stream, stopped and started again, the last arrival of each key wins."""
    run = _run_dir(spark, "last-write")
    ev = _arrivals(spark, sf_dir).drop("event_type")
    for k in range(3):
        ev.where(F.col("run") == k).write.mode("append").parquet(f"{run}/in")
        src = spark.readStream.schema(ev.schema).parquet(f"{run}/in")
        state.start_last_write(src, "user_id", ["updated"], f"{run}/out", f"{run}/checkpoint").awaitTermination()
    return state.read_last_write(spark, f"{run}/checkpoint")


@query("stream_upsert_arrival", ORACLES["upsert_arrival"])
def q_stream_upsert_arrival(spark, sf_dir):
    """The upsert stream into a merge-on-read table: the same rule as ``jobs.ingest``, with NULL and equal times."""
    run = _run_dir(spark, "upsert-arrival")
    ev = _arrivals(spark, sf_dir).drop("event_type")
    table = MergeOnReadTable(f"{run}/table", "user_id", ev.schema, buckets=16)
    for k in range(3):
        ev.where(F.col("run") == k).write.mode("append").parquet(f"{run}/in")
        src = spark.readStream.schema(ev.schema).parquet(f"{run}/in")
        jobs.start_upsert_stream(src, table, "updated", f"{run}/checkpoint").awaitTermination()
    return table.read(spark)


@query("stream_replays", "SELECT DISTINCT event_id, user_id, event_type, value FROM events")
def q_stream_replays(spark, sf_dir):
    """Events in three slices, each sent again with the next one; a watermark over their whole span keeps every copy known."""
    run = _run_dir(spark, "replays")
    ev = Fixture(spark, sf_dir).t.events.select("event_id", "user_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts"))
    span = ev.agg(F.unix_timestamp(F.max("ts")) - F.unix_timestamp(F.min("ts"))).first()[0] or 0
    slices = [ev.where(F.col("event_id") % 3 == k) for k in range(3)]
    for k in range(3):
        slices[k].unionByName(slices[k - 1] if k else slices[k]).write.mode("append").parquet(f"{run}/in")
        src = spark.readStream.schema(ev.schema).parquet(f"{run}/in")
        once = state.replay_filter(src, "ts", ["event_id"], f"{span + 1} seconds")
        w = once.writeStream.format("parquet").option("path", f"{run}/out").option("checkpointLocation", f"{run}/checkpoint")
        q = w.trigger(availableNow=True).start()
        q.awaitTermination()
        assert state.late_rows(q) == 0
    return spark.read.schema(ev.schema).parquet(f"{run}/out").drop("ts")


@query("prompt_batches_dense", with_("ts", "ms", "c", extra=[*catalog_classify._CLS_CTES[:-1], ("cases", f"""
SELECT *, (rn - 1) // {BATCH} AS batch_id, (rn - 1) % {BATCH} + 1 AS pos FROM (
  SELECT hex, text, row_number() OVER (ORDER BY hex) AS rn
  FROM (SELECT substr(md5(id), 1, 8) || '-' || substr(md5(id), 9, 4) AS hex, allMessages AS text FROM ex) h) n""")]) + """
SELECT CAST(batch_id AS BIGINT) AS batch_id, COUNT(*) AS n_cases, string_agg(hex || ':' || COALESCE(md5(text), ''), ',' ORDER BY pos) AS content
FROM cases GROUP BY batch_id""")
def q_prompt_batches_dense(spark, sf_dir):
    """Batches of exactly ``BATCH`` cases in the order of hex ids, with their content."""
    f = Fixture(spark, sf_dir)
    ex = threads.ticket_extract(f.tickets_raw(), f.messages_raw(), f.classes(), CFG)
    h = F.md5("id")
    ex = ex.select(F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4)).alias("id"), "allMessages")
    cases = classify.case_batches(ex, "id", "allMessages", BATCH, mode="dense")
    item = F.concat("id", F.lit(":"), F.coalesce(F.md5("text"), F.lit("")))
    return cases.withColumn("item", item).groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_cases"), F.expr("listagg(item, ',') WITHIN GROUP (ORDER BY pos)").alias("content"))


@query("tickets_page_seek", ORACLES["tickets_page"])
def q_tickets_page_seek(spark, sf_dir):
    t = with_categories(silver.ticket_fields(Fixture(spark, sf_dir).tickets_raw()), CFG).select("id", "category", "sub_category")
    pages = paging.write_pages(t, [F.col("id")], 50, _run_dir(spark, "tickets-pages"), slice_rows=100)
    return pages.page(spark, 3)


@query("open_chat_page_seek", ORACLES["open_chat_page"])
def q_open_chat_page_seek(spark, sf_dir):
    t = tagging.open_chat_tickets(Fixture(spark, sf_dir).tickets_raw(), CFG)
    pages = paging.write_pages(t, tagging.newest_order(), 50, _run_dir(spark, "open-pages"), slice_rows=100)
    return pages.page(spark, 1).select(*t.columns)


@query("thread_text_chunked", ORACLES["thread_text"])
def q_thread_text_chunked(spark, sf_dir):
    """Threads from ordered chunks: a conversation's messages meet in several tasks, their texts only at the end."""
    m = silver.messages_silver(Fixture(spark, sf_dir).messages_raw(), CFG, drop_empty=False)
    chunks = threads.thread_chunks(m, CFG.thread_separator)
    return threads.thread_texts(chunks, CFG.thread_separator)


@query("ticket_extract_colocated", ORACLES["ticket_extract_full"])
def q_ticket_extract_colocated(spark, sf_dir):
    """The full extract from silver tables bucketed by the conversation: joins and the message aggregate without an exchange."""
    f, run = Fixture(spark, sf_dir), _run_dir(spark, "colocated")
    name = f"casebook_{uuid.uuid4().hex}"
    buckets = 16
    t = threads.write_bucketed(silver.tickets_silver(f.tickets_raw(), CFG), f"{name}_tickets", f"{run}/tickets", "id", buckets)
    m = threads.write_bucketed(silver.messages_silver(f.messages_raw(), CFG, drop_empty=False), f"{name}_messages", f"{run}/messages",
                               "conversationId", buckets)
    c = threads.write_bucketed(threads.classifications_view(f.classes()), f"{name}_classes", f"{run}/classes", "conversationId", buckets)
    return threads.assemble_extract(t, m, c, CFG).withColumn("age", F.col("age").cast("long"))


def _broken(raw):
    """Ticket documents of which some are cut off, some are no objects."""
    k = F.col("id").cast("long")
    data = F.when(k % 40 == 3, F.expr("substr(data, 1, length(data) - 4)")).when(k % 40 == 7, F.lit("[1, 2]")).when(k % 40 == 8, F.lit("nothing")).otherwise(F.col("data"))
    return raw.select("id", data.alias("data"))


@query("tickets_silver_variant", ORACLES["tickets_silver"])
def q_tickets_silver_variant(spark, sf_dir):
    run = _run_dir(spark, "variant")
    variants.store_documents(Fixture(spark, sf_dir).tickets_raw(), run)
    t = variants.tickets_silver(variants.documents(spark, run), CFG)
    return t.withColumn("age", F.col("age").cast("long"))


@query("document_dead_letters", with_("t") + """
SELECT id, CASE k % 40 WHEN 7 THEN 'JSON array' ELSE 'not JSON' END AS reason FROM t WHERE k % 40 IN (3, 7, 8)
UNION ALL SELECT id, NULL FROM t WHERE k % 40 NOT IN (3, 7, 8)""")
def q_document_dead_letters(spark, sf_dir):
    """Stored documents and dead letters, from one parse: every ticket is in one of the two."""
    run = _run_dir(spark, "dead-letters")
    variants.store_documents(_broken(Fixture(spark, sf_dir).tickets_raw()), run)
    dead = variants.dead_letters(spark, run).select("id", "reason")
    return dead.unionByName(variants.documents(spark, run).select("id", F.lit(None).cast("string").alias("reason")))


@query("schema_drift", with_("t") + """
SELECT '$.region' AS path, 'new' AS status, 'OBJECT' AS type, COUNT(*) AS n FROM t WHERE k % 10 = 1 HAVING COUNT(*) > 0
UNION ALL SELECT '$.region.code', 'new', 'STRING', COUNT(*) FROM t WHERE k % 10 = 1 HAVING COUNT(*) > 0
UNION ALL SELECT '$.responseTime', 'retyped', 'BIGINT', COUNT(*) FROM t WHERE k % 6 = 1 HAVING COUNT(*) > 0
UNION ALL SELECT '$.waitingOnCustomerTime', 'new', 'STRING', COUNT(*) FROM t WHERE waitingOnCustomerTime IS NOT NULL HAVING COUNT(*) > 0
UNION ALL SELECT '$.summary', 'gone', 'STRING', COUNT(*) FROM t WHERE k % 2 = 0 AND summary IS NOT NULL HAVING COUNT(*) > 0""")
def q_schema_drift(spark, sf_dir):
    """Odd tickets against even ones: some have a new field, some a number for a text, and none has its summary field."""
    raw = Fixture(spark, sf_dir).tickets_raw()
    k = F.col("id").cast("long")
    data = F.regexp_replace("data", r'"summary":"[^"]*",?', "")
    data = F.when(k % 6 == 1, F.regexp_replace(data, r'"responseTime":"([0-9]+)"', '"responseTime":$1')).otherwise(data)
    data = F.when(k % 10 == 1, F.concat(F.lit('{"region":{"code":"r1"},'), F.substring(data, 2, 1 << 30))).otherwise(data)
    old = variants.with_variant(raw.where(k % 2 == 0))
    new = variants.with_variant(raw.where(k % 2 != 0).select("id", data.alias("data")))
    return variants.schema_drift(variants.path_counts(old), variants.path_counts(new))


@query("silver_write_counts", with_("ts") + """
SELECT COUNT(*) AS tickets, COUNT(*) FILTER (status = 'closed') AS closed, COUNT(*) - COUNT(status) AS without_status,
  COUNT(*) FILTER (age > 100) AS old FROM ts""")
def q_silver_write_counts(spark, sf_dir):
    """Counts over a written table from the pass that wrote it."""
    t = silver.tickets_silver(Fixture(spark, sf_dir).tickets_raw(), CFG)
    counts = {"tickets": F.count(F.lit(1)), "closed": F.count_if(F.col("status") == "closed"),
              "without_status": F.count_if(F.col("status").isNull()), "old": F.count_if(F.col("age") > 100)}
    seen = silver.write_silver_counted(t, f"{_run_dir(spark, 'counted')}/tickets", counts)
    return spark.createDataFrame([seen], ", ".join(f"{n} long" for n in counts))


@query("modified_by_id", with_("t") + """
SELECT id, strftime(upd, '%Y-%m-%d') || 'T12:00:00.000Z' AS updatedAt FROM t WHERE id = (SELECT MAX(id) FROM t)""")
def q_modified_by_id(spark, sf_dir):
    """A ticket id takes precedence over the date bounds, which exclude it here."""
    t = silver.ticket_fields(Fixture(spark, sf_dir).tickets_raw())
    last = t.agg(F.max("id")).first()[0]
    return modified_between(t, "1900-1-1", "1900-1-2", ticket_id=last).select("id", "updatedAt")


@query("strict_dates", """
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN CAST(o_orderdate AS DATE) WHEN 1 THEN CAST(o_orderdate AS DATE) END AS day FROM orders""")
def q_strict_dates(spark, sf_dir):
    """Dates in the forms a bound may have (with and without leading zeros) and in forms it may not."""
    d, k = F.col("o_orderdate").cast("date"), F.col("o_orderkey")
    text = (F.when(k % 5 == 0, F.date_format(d, "yyyy-MM-dd")).when(k % 5 == 1, F.date_format(d, "yyyy-M-d"))
            .when(k % 5 == 2, F.date_format(d, "yyyy/MM/dd")).when(k % 5 == 3, F.concat(F.date_format(d, "yyyy-MM"), F.lit("-32")))
            .otherwise(F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit(" 10:00"))))
    return Fixture(spark, sf_dir).t.orders.select("o_orderkey", strict_date(text).alias("day"))
