"""Open-ticket tagging queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from casebook.operators import tagging
from casebook.plans import doubles
from casebook.plans.common import CFG, Fixture
from casebook.plans.fixture_sql import with_
from casebook.plans.registry import query
from casebook.sources import fixtures as fx

_OPEN = f"""
SELECT id AS conversation_id, sourceType AS source_type, raw_status AS status, title, summary,
  strftime(dt, '%Y-%m-%d') || 'T12:00:00.000Z' AS created_at,
  strftime(upd, '%Y-%m-%d') || 'T12:00:00.000Z' AS updated_at,
  initialMessageId AS initial_message_id, channelId AS channel_id, channelId AS chat_channel_id,
  ts AS chat_timestamp, k
FROM t WHERE sourceType = '{CFG.chat_source_type}' AND raw_status <> 'closed' AND channelId IS NOT NULL
  AND ts IS NOT NULL"""
_OPEN_COLS = """conversation_id, source_type, status, title, summary, created_at, updated_at, initial_message_id,
  channel_id, chat_channel_id, chat_timestamp"""
_LINK_TS = ("CASE WHEN regexp_matches(chat_timestamp, '^\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*$') "
            "THEN regexp_replace(regexp_replace(printf('%.6f', CAST(trim(chat_timestamp) AS DOUBLE)), '0+$', ''), "
            "'\\.$', '') ELSE chat_timestamp END")
_REACT = f"""
SELECT 'C' || CAST(o_custkey % 50 AS VARCHAR) AS channel,
  CAST(o_orderkey + 1700000000 AS VARCHAR) || '.' || lpad(CAST(o_orderkey % 1000000 AS VARCHAR), 6, '0') AS ts,
  o_orderkey % 5 = 0 AS has
FROM orders WHERE o_orderkey % 13 <> 0"""
_FLAGS = """
SELECT o.*, COALESCE(r.has, false) AS has_emoji FROM open o
LEFT JOIN react r ON o.chat_channel_id = r.channel AND o.chat_timestamp = r.ts"""


def _open(spark, sf_dir):
    return tagging.open_chat_tickets(Fixture(spark, sf_dir).tickets_raw(), CFG)


def _flags(spark, sf_dir):
    f = Fixture(spark, sf_dir)
    return tagging.reaction_flags(_open(spark, sf_dir), fx.reactions(f.t.orders, CFG), CFG.ticket_emoji)


@query("open_chat_tickets", with_("t", extra=[("open", _OPEN)]) + f"SELECT {_OPEN_COLS} FROM open")
def q_open_chat_tickets(spark, sf_dir):
    return _open(spark, sf_dir)


@query("open_chat_page", with_("t", extra=[("open", _OPEN)]) + f"""
SELECT {_OPEN_COLS} FROM open ORDER BY created_at DESC NULLS LAST, conversation_id ASC LIMIT 50 OFFSET 50""")
def q_open_chat_page(spark, sf_dir):
    return tagging.newest_first(_open(spark, sf_dir), page_no=1, page_size=50)


@query("deep_links", with_("t", extra=[("open", _OPEN)]) + f"""
SELECT conversation_id, '{CFG.link_base}?channel=' || chat_channel_id || '&message_ts=' || {_LINK_TS} AS link
FROM open""")
def q_deep_links(spark, sf_dir):
    return tagging.with_links(_open(spark, sf_dir), CFG).select("conversation_id", "link")


@query("reaction_exists", with_("t", extra=[("open", _OPEN), ("react", _REACT)]) + f"""
SELECT conversation_id, has_emoji FROM ({_FLAGS}) q""")
def q_reaction_exists(spark, sf_dir):
    return _flags(spark, sf_dir).select("conversation_id", "has_emoji")


@query("reaction_plan", with_("t", extra=[("open", _OPEN), ("react", _REACT)]) + f"""
SELECT conversation_id, CASE WHEN has_emoji THEN 'skipped' WHEN k % 19 = 0 THEN 'failed' ELSE 'added' END AS status
FROM ({_FLAGS}) q""")
def q_reaction_plan(spark, sf_dir):
    return tagging.reaction_plan(_flags(spark, sf_dir), doubles.KeyModuloFailures(19)) \
        .select("conversation_id", "status")


_RECORDS = f"""
SELECT conversation_id,
  '{CFG.link_base}?channel=' || chat_channel_id || '&message_ts=' || {_LINK_TS} AS link,
  NOT (NOT has_emoji AND k % 19 = 0) AS success,
  substr(COALESCE(title, 'No title'), 1, 50) || '...' AS title_line
FROM ({_FLAGS}) q"""


def _records(spark, sf_dir):
    plan = tagging.reaction_plan(_flags(spark, sf_dir), doubles.KeyModuloFailures(19))
    return tagging.link_records(plan, CFG)


@query("tagging_links", with_("t", extra=[("open", _OPEN), ("react", _REACT)]) + _RECORDS)
def q_tagging_links(spark, sf_dir):
    return _records(spark, sf_dir)


@query("tagging_summary", with_("t", extra=[("open", _OPEN), ("react", _REACT), ("rec", _RECORDS)]) + """
SELECT COUNT(*) AS total_processed, COUNT(*) FILTER (WHERE success) AS total_successful,
  COUNT(*) FILTER (WHERE NOT success) AS total_failed,
  COALESCE(CAST(COUNT(*) FILTER (WHERE success) AS DOUBLE) * 100.0 / NULLIF(COUNT(*), 0), 0.0) AS success_rate
FROM rec""")
def q_tagging_summary(spark, sf_dir):
    return tagging.tag_summary(_records(spark, sf_dir))


_BUCKET = """((CAST('0x' || substr(h, 1, 8) AS BIGINT) * 6) % 10 + (CAST('0x' || substr(h, 9, 8) AS BIGINT) * 6) % 10
  + (CAST('0x' || substr(h, 17, 8) AS BIGINT) * 6) % 10 + CAST('0x' || substr(h, 25, 8) AS BIGINT) % 10) % 10"""


@query("hash_bucket", with_("t", extra=[("open", _OPEN)]) + f"""
SELECT conversation_id, {_BUCKET} AS bucket FROM (SELECT conversation_id, md5(chat_channel_id || chat_timestamp) AS h
  FROM open) q""")
def q_hash_bucket(spark, sf_dir):
    return tagging.message_bucket(_open(spark, sf_dir)).select("conversation_id", "bucket")


@query("reaction_debug", """
SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS id, NOT bad AS success,
  CASE WHEN NOT bad THEN (CASE WHEN length(COALESCE(text, '')) > 100 THEN substr(text, 1, 100) || '...'
                              ELSE COALESCE(text, '') END) END AS text_preview,
  CASE WHEN NOT bad THEN 'U' || CAST(conv_id % 7 AS VARCHAR) END AS "user",
  CASE WHEN NOT bad THEN 'message' END AS type,
  CASE WHEN NOT bad AND role = 'system' THEN 'bot_message' END AS subtype,
  CASE WHEN NOT bad AND turn % 2 = 0 THEN 1 ELSE 0 END AS n_reactions,
  CASE WHEN bad THEN 'missing_scope' END AS error
FROM (SELECT *, (conv_id + turn) % 19 = 0 AS bad FROM conversations) q""")
def q_reaction_debug(spark, sf_dir):
    return tagging.reaction_debug(fx.reaction_replies(Fixture(spark, sf_dir).t.conversations, CFG))
