"""Extract, silver and report queries (threads, joins, projections, counts)."""

from __future__ import annotations

from pyspark.sql import functions as F

from casebook.config import SQL_THREAD_SEPARATOR
from casebook.operators import reports, silver, threads
from casebook.plans.common import CFG, Fixture
from casebook.plans.fixture_sql import with_
from casebook.plans.registry import query

_SEP = SQL_THREAD_SEPARATOR
_NONBLANK = "text IS NOT NULL AND trim(text) <> '' AND text <> '\"\"'"

_EXTRACT_COLS = """ts.id, ts.sourceType, ts.status, ts.plan_category, ts.assignedTo,
  ts.dt AS createdAt, ts.upd AS updatedAt, ts.closed AS closedAt, ts.responseTime, ts.resolutionTime,
  ts.waitingOnAgentTime, ts.waitingOnCustomerTime, ts.priority, ts.ticketType, ts.submitter, ts.title,
  ts.summary, ts.sentiment"""

_EXTRACT_SQL = with_("ts", "ms", "c", extra=[("e", f"""
SELECT conversationId, MAX(flag) AS esc,
  string_agg(text, '{_SEP}' ORDER BY ts, id) FILTER (WHERE {_NONBLANK}) AS allMessages
FROM ms GROUP BY conversationId""")]) + f"""
SELECT {_EXTRACT_COLS}, COALESCE(e.esc, false) AS internalEscalation, ts.creation_week, ts.age,
  e.allMessages, c.category AS ai_category, c.sub_category, c.reasoning, c.resolution
FROM ts LEFT JOIN e ON ts.id = e.conversationId LEFT JOIN c ON ts.id = c.conversation_id
WHERE c.resolution IS NULL
"""


def _extract(spark, sf_dir, limit):
    fx = Fixture(spark, sf_dir)
    out = threads.ticket_extract(fx.tickets_raw(), fx.messages_raw(), fx.classes(), CFG, limit=limit)
    return out.withColumn("age", F.col("age").cast("long"))


@query("ticket_extract", _EXTRACT_SQL + "ORDER BY ts.id LIMIT 100")
def q_ticket_extract(spark, sf_dir):
    return _extract(spark, sf_dir, 100)


@query("ticket_extract_full", _EXTRACT_SQL)
def q_ticket_extract_full(spark, sf_dir):
    return _extract(spark, sf_dir, None)


@query("tickets_silver", with_("ts") + f"""
SELECT {_EXTRACT_COLS}, ts.creation_week, ts.age FROM ts""")
def q_tickets_silver(spark, sf_dir):
    t = silver.tickets_silver(Fixture(spark, sf_dir).tickets_raw(), CFG)
    return t.withColumn("age", F.col("age").cast("long"))


@query("messages_silver", with_("ms") + """
SELECT id, conversationId, ts AS timestamp, updatedAt, isPrivateNote, botName, sender, text,
  flag AS internalEscalation
FROM ms WHERE text IS NOT NULL AND text <> ''""")
def q_messages_silver(spark, sf_dir):
    return silver.messages_silver(Fixture(spark, sf_dir).messages_raw(), CFG)


@query("customers_silver", """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, 'cs-' || CAST(c_custkey AS VARCHAR) AS slackChannel,
  (c_custkey % 2 = 0) AS isPrivate,
  CASE WHEN c_custkey % 3 <> 0 THEN 'crm' || CAST(c_custkey AS VARCHAR) END AS crm_id,
  CASE WHEN c_custkey % 5 IN (0, 1) THEN NULL ELSE 'tier' || CAST(c_nationkey % 3 AS VARCHAR) END AS tier
FROM customer""")
def q_customers_silver(spark, sf_dir):
    return silver.customers_silver(Fixture(spark, sf_dir).customers_raw())


@query("status_remap_counts", with_("ts") + """
SELECT sourceType, status, COUNT(*) AS n FROM ts GROUP BY sourceType, status""")
def q_status_remap_counts(spark, sf_dir):
    t = silver.tickets_silver(Fixture(spark, sf_dir).tickets_raw(), CFG)
    return reports.ordered_report(reports.count_by(t, ["sourceType", "status"]), ["sourceType"], tie=["status"])


@query("counts_by_tag", with_("t") + """
SELECT first_tag AS first_tag, COUNT(*) AS n FROM t GROUP BY first_tag""")
def q_counts_by_tag(spark, sf_dir):
    t = silver.ticket_fields(Fixture(spark, sf_dir).tickets_raw())
    counts = reports.count_by(t.select(F.get(F.col("customer.tags"), 0).getField("name").alias("first_tag")),
                              ["first_tag"])
    return reports.ordered_report(counts, [], tie=["first_tag"])


@query("counts_by_category", with_("c") + """
SELECT category, sub_category, COUNT(*) AS cases FROM c GROUP BY category, sub_category""")
def q_counts_by_category(spark, sf_dir):
    counts = reports.count_by(Fixture(spark, sf_dir).classes(), ["category", "sub_category"], name="cases")
    return reports.ordered_report(counts, ["category"], name="cases", tie=["sub_category"])


@query("weekly_created", with_("ts") + """
SELECT creation_week, COUNT(*) AS n FROM ts GROUP BY creation_week""")
def q_weekly_created(spark, sf_dir):
    t = silver.tickets_silver(Fixture(spark, sf_dir).tickets_raw(), CFG)
    return reports.count_by(t, ["creation_week"])


@query("ticket_age_days", with_("ts") + """
SELECT id, status, createdAt, closedAt, age FROM (SELECT id, status, dt AS createdAt, closed AS closedAt, age FROM ts)""")
def q_ticket_age_days(spark, sf_dir):
    t = silver.tickets_silver(Fixture(spark, sf_dir).tickets_raw(), CFG)
    return t.select("id", "status", "createdAt", "closedAt", F.col("age").cast("long").alias("age"))


@query("escalated_conversations", with_("ms") + """
SELECT conversationId, MAX(flag) AS any_flag, COALESCE(MAX(flag), false) AS internalEscalation
FROM ms GROUP BY conversationId""")
def q_escalated_conversations(spark, sf_dir):
    m = silver.messages_silver(Fixture(spark, sf_dir).messages_raw(), CFG, drop_empty=False)
    th = threads.thread_summary(m, CFG.thread_separator, with_text=False)
    return th.select("conversationId", F.col("internalEscalation").alias("any_flag"),
                     F.coalesce("internalEscalation", F.lit(False)).alias("internalEscalation"))


@query("thread_text", with_("ms") + f"""
SELECT conversationId, string_agg(text, '{_SEP}' ORDER BY ts, id) AS allMessages
FROM ms WHERE {_NONBLANK} GROUP BY conversationId""")
def q_thread_text(spark, sf_dir):
    m = silver.messages_silver(Fixture(spark, sf_dir).messages_raw(), CFG, drop_empty=False)
    from casebook.functions.columns import nonblank_text
    th = threads.thread_summary(m.where(nonblank_text("text")), CFG.thread_separator, with_flag=False)
    return th


@query("sql_file", with_("ts") + """
SELECT sourceType, status, COUNT(*) AS n FROM ts GROUP BY sourceType, status""")
def q_sql_file(spark, sf_dir):
    import os

    from casebook.sources.sqlfile import run_sql_file
    t = silver.tickets_silver(Fixture(spark, sf_dir).tickets_raw(), CFG)
    path = os.path.join(os.path.dirname(os.path.abspath(__file__)), "sql", "ticket_counts.sql")
    return run_sql_file(spark, path, {"tickets": t})


@query("summary_inputs", _EXTRACT_SQL.replace(
    "SELECT " + _EXTRACT_COLS + ", COALESCE(e.esc, false) AS internalEscalation, ts.creation_week, ts.age,\n"
    "  e.allMessages, c.category AS ai_category, c.sub_category, c.reasoning, c.resolution",
    "SELECT ts.id AS conversation_id, ts.ticketType, e.allMessages AS message_content"))
def q_summary_inputs(spark, sf_dir):
    fx = Fixture(spark, sf_dir)
    return threads.summary_inputs(threads.ticket_extract(fx.tickets_raw(), fx.messages_raw(), fx.classes(), CFG))
