"""Merge, pending-selection and join queries."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from casebook import schemas
from casebook.operators import merge, reports, silver, writeback
from casebook.plans import doubles
from casebook.plans.common import CFG, Fixture
from casebook.plans.fixture_sql import with_
from casebook.plans.registry import query
from casebook.sources import fixtures as fx

RUN_TS = _dt.datetime(2025, 1, 1, 0, 0, 0)
_C_OUT = ["conversation_id", "category", "sub_category", "reasoning", "resolution"]


def _dated(df):
    return df.select(*_C_OUT, F.col("created_at").cast("date").alias("created_at"),
                     F.col("updated_time").cast("date").alias("updated_time"))


@query("upsert_latest", """
SELECT user_id, event_id, ts, event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""")
def q_upsert_latest(spark, sf_dir):
    ev = Fixture(spark, sf_dir).t.events.select("user_id", "event_id", "ts", "event_type", "value", "props")
    snapshot = merge.latest_per_key(ev.where(F.col("event_id") % 3 == 0), "user_id", "event_id")
    return merge.upsert_latest(snapshot, ev.where(F.col("event_id") % 3 != 0), "user_id", "event_id")


@query("upsert_arrival", """
SELECT user_id, run, updated, event_id, value FROM (
  SELECT user_id, event_id % 3 AS run, event_id, value,
    CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 4 < 3 THEN TIMESTAMP '2024-01-01 00:00:00' ELSE ts END AS updated
  FROM events)
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY run DESC, updated DESC NULLS LAST, event_id DESC) = 1""")
def q_upsert_arrival(spark, sf_dir):
    """Three runs, each replacing what the ones before stored, though many rows have a NULL or equal time."""
    n = F.col("event_id")
    ev = Fixture(spark, sf_dir).t.events.select(
        "user_id", (n % 3).alias("run"),
        F.when(n % 4 == 0, None).when(n % 4 < 3, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
        .otherwise(F.col("ts").cast("timestamp_ntz")).alias("updated"), "event_id", "value")
    stored = ev.where("false")
    for run in range(3):
        stored = merge.replace_rows(stored, merge.latest_by_arrival(ev.where(F.col("run") == run), "user_id", ["updated"]),
                                    "user_id")
    return stored


@query("upsert_coalesce", with_("c", "upd", extra=[("f", """
SELECT conversation_id,
  arg_max(category, arrival) FILTER (WHERE category IS NOT NULL) AS category,
  arg_max(sub_category, arrival) FILTER (WHERE sub_category IS NOT NULL) AS sub_category,
  arg_max(reasoning, arrival) FILTER (WHERE reasoning IS NOT NULL) AS reasoning,
  arg_max(resolution, arrival) FILTER (WHERE resolution IS NOT NULL) AS resolution
FROM upd GROUP BY conversation_id""")]) + """
SELECT COALESCE(c.conversation_id, f.conversation_id) AS conversation_id,
  COALESCE(f.category, c.category) AS category, COALESCE(f.sub_category, c.sub_category) AS sub_category,
  COALESCE(f.reasoning, c.reasoning) AS reasoning, COALESCE(f.resolution, c.resolution) AS resolution,
  CAST(CASE WHEN c.conversation_id IS NULL THEN TIMESTAMP '2025-01-01 00:00:00' ELSE c.created_at END AS DATE)
    AS created_at,
  CAST(c.updated_time AS DATE) AS updated_time
FROM c FULL OUTER JOIN f ON c.conversation_id = f.conversation_id""")
def q_upsert_coalesce(spark, sf_dir):
    f = Fixture(spark, sf_dir)
    out = merge.upsert_coalesce(f.classes(), fx.classification_updates(f.t.orders), "conversation_id",
                                ["category", "sub_category", "reasoning", "resolution"], "arrival", RUN_TS)
    return _dated(out)


@query("mark_updated", with_("c") + """
SELECT conversation_id, category, sub_category, reasoning, resolution, CAST(created_at AS DATE) AS created_at,
  CAST(CASE WHEN category IS NOT NULL AND resolution IS NOT NULL AND updated_time IS NULL AND k % 17 <> 0
            THEN TIMESTAMP '2025-01-01 00:00:00' ELSE updated_time END AS DATE) AS updated_time
FROM c""")
def q_mark_updated(spark, sf_dir):
    f = Fixture(spark, sf_dir)
    classes = f.classes()
    pend = writeback.pending_updates(classes, f.clusters(), limit=None)
    outcomes = writeback.write_back(pend.withColumn("payload", F.to_json(F.struct("category", "resolution"))),
                                    doubles.KeyModuloFailures(17), key="conversation_id")
    return _dated(merge.mark_updated(classes, outcomes, "conversation_id", RUN_TS))


@query("schema_evolve", with_("c") + """
SELECT conversation_id, category, sub_category, reasoning, resolution, CAST(created_at AS DATE) AS created_at,
  CAST(NULL AS DATE) AS updated_time FROM c""")
def q_schema_evolve(spark, sf_dir):
    old = Fixture(spark, sf_dir).classes().drop("updated_time")
    assert not merge.has_column(old, "updated_time")
    return _dated(merge.evolve(old, schemas.CLASSIFICATION))


@query("update_stats", with_("c") + """
SELECT COUNT(*) AS total, COUNT(updated_time) AS with_value, COUNT(*) - COUNT(updated_time) AS without_value
FROM c""")
def q_update_stats(spark, sf_dir):
    return reports.progress_counts(Fixture(spark, sf_dir).classes(), "updated_time")


_PEND_OUT = "SELECT conversation_id, category, sub_category, resolution, cluster, CAST(created_at AS DATE) AS created_at"
_PEND_ORDER = "ORDER BY created_at DESC NULLS LAST, conversation_id ASC NULLS FIRST, cluster ASC NULLS FIRST LIMIT 100"


def _pending(spark, sf_dir, stale):
    f = Fixture(spark, sf_dir)
    p = writeback.pending_updates(f.classes(), f.clusters(), limit=None if stale else 100, include_stale=stale)
    return p.withColumn("created_at", F.col("created_at").cast("date"))


@query("pending_updates", with_("pend") + f"{_PEND_OUT} FROM pend {_PEND_ORDER}")
def q_pending_updates(spark, sf_dir):
    return _pending(spark, sf_dir, False)


@query("pending_updates_documented", with_("c", "clu") + f"""{_PEND_OUT} FROM (
SELECT c.conversation_id, c.category, c.sub_category, c.resolution, clu.cluster_name AS cluster, c.created_at
FROM c LEFT JOIN clu ON c.conversation_id = clu.ticket_id
WHERE c.category IS NOT NULL AND c.resolution IS NOT NULL
  AND (c.updated_time IS NULL OR c.updated_time < c.created_at))""")
def q_pending_updates_documented(spark, sf_dir):
    return _pending(spark, sf_dir, True)


@query("messages_with_user", with_("ms", "dir") + """
SELECT ms.id, ms.conversationId, ms.sender, dir.user_id, dir.user_name
FROM ms JOIN dir ON ms.sender = dir.email""")
def q_messages_with_user(spark, sf_dir):
    f = Fixture(spark, sf_dir)
    m = silver.message_senders(f.messages_raw()).where(F.col("sender").isNotNull())
    d = f.directory().where(F.col("email").isNotNull())
    return m.join(d, m.sender == d.email, "inner").select("id", "conversationId", "sender", "user_id", "user_name")


@query("staging_with_directory", with_("stg", "t", "dir") + """
SELECT stg.conversation_id, stg.ticket_category, stg.ticket_sub_category, stg.ticket_resolution, stg.version,
  t.submitter AS submitter_email, dir.user_name
FROM stg JOIN t ON stg.conversation_id = t.id JOIN dir ON t.submitter = dir.email""")
def q_staging_with_directory(spark, sf_dir):
    f = Fixture(spark, sf_dir)
    t = silver.ticket_fields(f.tickets_raw()).select("id", F.col("submitterUser.email").alias("submitter_email"))
    s = f.staging()
    d = f.directory()
    j = s.join(t, s.conversation_id == t.id, "inner").join(d, F.col("submitter_email") == d.email, "inner")
    return j.select("conversation_id", "ticket_category", "ticket_sub_category", "ticket_resolution", "version",
                    "submitter_email", "user_name")
