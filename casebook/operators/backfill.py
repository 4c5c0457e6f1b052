"""Backfill of missing categories.

Ids come from the migration log (lines whose label came out empty). Each id
is resolved by the first usable tier: the warehouse staging table, the live
ticket record's custom fields, then the model on the embedded thread text.
All tiers are joins on the id; only the residue reaches the model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook import schemas
from casebook.config import EMPTY_MIGRATION_MARKER, MIGRATED_ID_PATTERN, Settings
from casebook.functions import columns as C
from casebook.operators import classify, fields, merge, writeback
from casebook.session import checkpoint_dir


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Text log lines as ``value`` (one row per line, split across files)."""
    return spark.read.text(path)


def log_empty_ids(lines: DataFrame) -> DataFrame:
    """Conversation ids of log lines that record an empty migration label
    (duplicates kept, as the log may repeat a ticket)."""
    hit = lines.where(F.col("value").contains(EMPTY_MIGRATION_MARKER))
    cid = F.nullif(F.regexp_extract("value", MIGRATED_ID_PATTERN, 1), F.lit(""))
    return hit.select(cid.alias("conversation_id")).where(F.col("conversation_id").isNotNull())


def warehouse_lookup(staging: DataFrame, ids: DataFrame, order: str | None = None) -> DataFrame:
    """One staging row per requested id: the greatest ``order``, or without an order column the greatest row."""
    req = ids.select("conversation_id").distinct()
    hit = staging.join(req, "conversation_id", "left_semi")
    cols = ["conversation_id", "ticket_category", "ticket_sub_category", "ticket_resolution"]
    if order is None:
        return merge.latest_by_arrival(hit.select(*cols), "conversation_id", [])
    return merge.latest_per_key(hit, "conversation_id", order).select(*cols)


def embedded_thread(docs: DataFrame, sep: str) -> DataFrame:
    """``(id, content)``: non-empty ``messages[].content`` of a conversation
    document joined by ``sep`` ('' when none)."""
    d = docs.select("id", F.from_json("data", schemas.TICKET_DOC).getField("messages").alias("msgs"))
    keep = F.filter("msgs", lambda m: F.coalesce(m.getField("content"), F.lit("")) != "")
    return d.select("id", F.array_join(F.transform(keep, lambda m: m.getField("content")), sep).alias("content"))


def backfill(ids: DataFrame, staging: DataFrame, live_docs: DataFrame, thread_docs: DataFrame,
             model: classify.Model, cfg: Settings, order: str | None = None) -> DataFrame:
    """One row per requested id (duplicates kept) with the winning tier
    (``warehouse`` / ``live`` / ``model`` / ``none``), the values it gives,
    the migration label and the truthy-only payload map."""
    wh = warehouse_lookup(staging, ids, order).withColumn("wh_found", F.lit(True))
    # Documents meet the requested ids before they are parsed.
    asked = ids.select(F.col("conversation_id").alias("id")).distinct()
    live = fields.with_categories(
        live_docs.join(asked, "id", "left_semi").select("id", F.from_json("data", schemas.TICKET_DOC).getField("ticketTypeFields").alias("f")),
        cfg, "f").select(F.col("id").alias("conversation_id"), F.col("category").alias("live_cat"),
                         F.col("sub_category").alias("live_sub"),
                         fields.field("f", cfg.resolution_field_id).alias("live_res"))
    # The tier table is read twice (residue for the model, final pick): cut it
    # once to the shared checkpoint folder instead of deriving it twice.
    checkpoint_dir(ids.sparkSession)
    base = ids.join(wh, "conversation_id", "left").join(live, "conversation_id", "left").checkpoint(eager=True)
    need_model = base.where(~C.usable("ticket_category") & ~C.usable("live_cat")).select("conversation_id").distinct()
    unsolved = thread_docs.join(need_model.withColumnRenamed("conversation_id", "id"), "id", "left_semi")
    content = embedded_thread(unsolved, cfg.embedded_separator) \
        .where(F.col("content") != "").withColumnRenamed("id", "conversation_id")
    cases = need_model.join(content, "conversation_id", "inner").select(
        "conversation_id", F.col("conversation_id").cast("string").alias("batch_id"),
        classify.single_prompt(F.col("content")).alias("prompt"))
    replies = classify.classify(cases, model)
    ai = classify.single_results(cases.select("conversation_id", "batch_id"), replies, "conversation_id") \
        .select("conversation_id", F.col("category").alias("ai_cat"), F.col("sub_category").alias("ai_sub"),
                F.lit(True).alias("ai_ok"))
    j = base.join(ai, "conversation_id", "left")
    src = (F.when(C.usable("ticket_category"), F.lit("warehouse"))
           .when(C.usable("live_cat"), F.lit("live"))
           .when(F.col("ai_ok"), F.lit("model")).otherwise(F.lit("none")))
    j = j.withColumn("source", src)

    def pick(w, l, a):
        return (F.when(F.col("source") == "warehouse", F.col(w)).when(F.col("source") == "live", F.col(l))
                .when(F.col("source") == "model", F.col(a) if a else F.lit(None).cast("string")))

    j = j.select("conversation_id", "source", F.coalesce("wh_found", F.lit(False)).alias("wh_found"),
                 pick("ticket_category", "live_cat", "ai_cat").alias("category"),
                 pick("ticket_sub_category", "live_sub", "ai_sub").alias("sub_category"),
                 pick("ticket_resolution", "live_res", None).alias("resolution"))
    j = j.withColumn("migration_label", F.when(F.col("source") != "none", C.label_b("category", "sub_category")))
    m = fields.field_map(cfg, {"category": F.col("category"), "sub_category": F.col("sub_category"),
                               "migration": F.col("migration_label"), "resolution": F.col("resolution")})
    return j.withColumn("fields", C.drop_blank_values(m))


def apply_backfill(resolved: DataFrame, send: writeback.Send) -> DataFrame:
    """Send the truthy-only payload of every resolved row (one pass; rows are
    carried through the writer). Rows with an empty payload are not sent and
    fail; rows without data are skipped and get ``ok`` NULL."""
    rows = resolved.withColumn("payload", F.when(F.cardinality("fields") > 0, F.to_json("fields"))) \
        .withColumn("no_data", F.col("source") == "none").drop("fields")
    out = writeback.write_back(rows, send, key="conversation_id", skip="no_data", keep=True)
    return out.withColumn("ok", F.when(~F.col("no_data"), F.col("ok"))).drop("payload", "no_data", "error")


def backfill_funnel(applied: DataFrame) -> DataFrame:
    """Run statistics: ids requested, found per tier, updated, failed, no data."""
    return applied.agg(
        F.count(F.lit(1)).alias("total_conversations"),
        F.count_distinct(F.when(F.col("wh_found"), F.col("conversation_id"))).alias("warehouse_found"),
        F.count_if(F.col("source") == "live").alias("live_found"),
        F.count_if(F.col("source") == "model").alias("model_classified"),
        F.count_if(F.col("ok")).alias("updated_successfully"),
        F.count_if((F.col("source") != "none") & ~F.col("ok")).alias("failed"),
        F.count_if(F.col("source") == "none").alias("no_data_found"),
    )
