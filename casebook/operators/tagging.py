"""Tagging of open chat tickets.

Open chat tickets are read straight from the raw documents with one
``json_tuple`` parse for the top-level fields (plus one path for the nested
message timestamp), filtered, linked, and checked against the stored
reactions; only tickets without the emoji reach the (external) writer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

from casebook.config import PREVIEW_CHARS, TITLE_PREVIEW_CHARS, Settings
from casebook.functions import columns as C
from casebook.operators import writeback

_TOP = ["sourceType", "status", "title", "summary", "createdAt", "updatedAt", "initialMessageId", "channelId"]


def open_chat_tickets(raw: DataFrame, cfg: Settings) -> DataFrame:
    """Chat tickets that are not closed and have a channel and a message
    timestamp (a NULL status drops out, as in SQL)."""
    d = raw.where(F.col("data").isNotNull()).select(
        "id", F.json_tuple("data", *_TOP).alias(*_TOP),
        F.get_json_object("data", "$.initialMessage.ts").alias("ts"))
    d = d.where((F.col("sourceType") == cfg.chat_source_type) & (F.col("status") != "closed")
                & F.col("channelId").isNotNull() & F.col("ts").isNotNull())
    return d.select(
        F.col("id").alias("conversation_id"), F.col("sourceType").alias("source_type"), "status", "title",
        "summary", F.col("createdAt").alias("created_at"), F.col("updatedAt").alias("updated_at"),
        F.col("initialMessageId").alias("initial_message_id"), F.col("channelId").alias("channel_id"),
        F.col("channelId").alias("chat_channel_id"), F.col("ts").alias("chat_timestamp"))


def newest_order() -> list[Column]:
    return [F.col("created_at").desc_nulls_last(), F.col("conversation_id").asc()]


def newest_first(tickets: DataFrame, page_no: int = 0, page_size: int = 50) -> DataFrame:
    """One page of open tickets, newest first (id breaks ties). To walk many pages, store them once (``paging``)."""
    return tickets.orderBy(*newest_order()).offset(page_no * page_size).limit(page_size)


ALREADY_REACTED = "already_reacted"  # the writer's error when somebody else was faster: nothing to do


def with_links(tickets: DataFrame, cfg: Settings) -> DataFrame:
    return tickets.withColumn("link", C.deep_link("chat_channel_id", "chat_timestamp", cfg.link_base))


def reaction_flags(tickets: DataFrame, reactions: DataFrame, emoji: str) -> DataFrame:
    """``has_emoji`` per ticket: is ``emoji`` among the stored reactions of its
    message. Reactions are reduced to one flag per (channel, ts) first, so the
    join cannot fan out and its shuffle reuses that partitioning."""
    r = reactions.groupBy("channel", "ts").agg(
        F.max(F.exists("names", lambda n: n == F.lit(emoji))).alias("_has"))
    j = tickets.join(r, (tickets.chat_channel_id == r.channel) & (tickets.chat_timestamp == r.ts), "left")
    return j.select(*tickets.columns, F.coalesce("_has", F.lit(False)).alias("has_emoji"))


def reaction_plan(flags: DataFrame, send: writeback.Send) -> DataFrame:
    """Every flagged ticket plus ``status``: 'skipped' when the emoji is already
    there, else the writer's outcome 'added' / 'failed' (one pass; the input
    columns are carried through the writer)."""
    todo = flags.withColumn(
        "payload", F.to_json(F.struct(F.col("chat_channel_id").alias("channel"),
                                      F.col("chat_timestamp").alias("timestamp"))))
    out = writeback.write_back(todo, send, key="conversation_id", skip="has_emoji", keep=True)
    there = ~F.col("ok") & F.coalesce(F.lower("error").contains(ALREADY_REACTED), F.lit(False))
    status = (F.when(F.col("has_emoji") | there, F.lit("skipped")).when(F.col("ok"), F.lit("added"))
              .otherwise(F.lit("failed")))
    return out.withColumn("status", status).drop("payload", "ok", "error")


def link_records(plan: DataFrame, cfg: Settings) -> DataFrame:
    """One record per processed ticket: deep link, success (added or already
    there), and the title cut to 50 characters for the run listing."""
    title = F.concat(F.substring(F.coalesce(F.col("title"), F.lit("No title")), 1, TITLE_PREVIEW_CHARS),
                     F.lit("..."))
    return plan.select("conversation_id", C.deep_link("chat_channel_id", "chat_timestamp", cfg.link_base).alias("link"),
                       (F.col("status") != "failed").alias("success"), title.alias("title_line"))


def tag_summary(records: DataFrame) -> DataFrame:
    """Run totals: processed, successful, failed, success rate in percent (0 when empty)."""
    s = records.agg(F.count(F.lit(1)).alias("total_processed"), F.count_if("success").alias("total_successful"),
                    F.count_if(~F.col("success")).alias("total_failed"))
    rate = F.coalesce(F.try_divide(F.col("total_successful") * F.lit(100.0), F.col("total_processed")), F.lit(0.0))
    return s.withColumn("success_rate", rate)


def message_bucket(tickets: DataFrame, modulus: int = 10) -> DataFrame:
    """Stable bucket of every message's (channel, ts)."""
    return tickets.withColumn("bucket", C.hash_bucket(F.concat(F.coalesce("chat_channel_id", F.lit("None")),
                                                               F.coalesce("chat_timestamp", F.lit("None"))),
                                                      modulus))


REACTION_REPLY = StructType([
    StructField("ok", BooleanType()), StructField("error", StringType()),
    StructField("message", StructType([
        StructField("text", StringType()), StructField("user", StringType()), StructField("type", StringType()),
        StructField("subtype", StringType()),
        StructField("reactions", ArrayType(StructType([StructField("name", StringType())])))])),
])


def reaction_debug(replies: DataFrame, key: str = "id", reply: str = "reply") -> DataFrame:
    """Debug record per stored API reply: success flag, message preview and
    fields, reaction count, and the reported error."""
    r = replies.select(key, F.from_json(reply, REACTION_REPLY).alias("r"))
    ok = F.coalesce(F.col("r.ok"), F.lit(False))
    text = F.coalesce(F.col("r.message.text"), F.lit(""))
    return r.select(
        key, ok.alias("success"),
        F.when(ok, C.preview(text, PREVIEW_CHARS)).alias("text_preview"),
        F.when(ok, F.col("r.message.user")).alias("user"),
        F.when(ok, F.col("r.message.type")).alias("type"),
        F.when(ok, F.col("r.message.subtype")).alias("subtype"),
        F.when(ok, F.coalesce(F.size(F.col("r.message.reactions")), F.lit(0))).otherwise(F.lit(0)).alias("n_reactions"),
        F.when(~ok, F.coalesce(F.col("r.error"), F.lit("Unknown error"))).alias("error"),
    )
