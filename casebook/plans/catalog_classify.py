"""Classification and backfill queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from casebook.config import EMBEDDED_THREAD_SEPARATOR, SQL_THREAD_SEPARATOR
from casebook.operators import backfill, classify, merge, silver, threads, writeback
from casebook.plans import doubles
from casebook.plans.catalog_merge import RUN_TS, _dated
from casebook.plans.common import CFG, Fixture
from casebook.plans.fixture_sql import LABEL_A, with_
from casebook.plans.registry import query
from casebook.session import checkpoint_dir
from casebook.sources import fixtures as fx

BATCH = 5
# Allowed (category, sub-category) pairs of the fixture classifications.
FIXTURE_TAXONOMY = {"1-URGENT": ["F", "O"], "2-HIGH": ["F", "O", "P"], "3-MEDIUM": ["O"],
                    "4-NOT SPECIFIED": ["P"], "5-LOW": ["F"]}

_NONBLANK = "text IS NOT NULL AND trim(text) <> '' AND text <> '\"\"'"
_E = f"""SELECT conversationId, string_agg(text, '{SQL_THREAD_SEPARATOR}' ORDER BY ts, id)
  FILTER (WHERE {_NONBLANK}) AS allMessages FROM ms GROUP BY conversationId"""
_EX = """SELECT ts.id, ts.k, e.allMessages FROM ts LEFT JOIN e ON ts.id = e.conversationId
  LEFT JOIN c ON ts.id = c.conversation_id WHERE c.resolution IS NULL"""
_CASES = f"""SELECT id, k, allMessages AS text, k // {BATCH} AS batch_id,
  row_number() OVER (PARTITION BY k // {BATCH} ORDER BY k) AS pos FROM ex"""
_HOST = CFG.chat_host
KW_CAT = f"CASE WHEN strpos(x, '{_HOST}') > 0 THEN 'Escalation' WHEN strpos(x, 'the') > 0 THEN 'General' ELSE 'Other' END"
KW_SUB = "CASE WHEN strpos(x, 'data') > 0 THEN 'Data' ELSE 'Other' END"
KW_RES = "CASE WHEN strpos(x, '?') > 0 THEN 'Customer Education' ELSE 'No Action' END"
_NL = "chr(10)"
_ALIGNED = f"""
SELECT id AS conversation_id,
  CASE WHEN err IS NULL THEN {KW_CAT} ELSE 'Error' END AS category,
  CASE WHEN err IS NULL THEN {KW_SUB} ELSE 'Error' END AS sub_category,
  COALESCE(err, 'keyword') AS reasoning,
  CASE WHEN err IS NULL THEN {KW_RES} ELSE 'Error' END AS resolution,
  err IS NOT NULL AS failed
FROM (SELECT cases.*, COALESCE(text, 'None') AS x,
  CASE WHEN batch_id % 7 = 0 THEN '{{''error'': ''Failed to parse response''}}'
       WHEN batch_id % 11 = 0 AND pos > 1 THEN '{{''error'': ''No result for case''}}'
       WHEN batch_id % 11 <> 0 AND batch_id % 5 = 0 AND pos = n THEN '{{''error'': ''No result for case''}}'
  END AS err
  FROM cases JOIN (SELECT batch_id, COUNT(*) AS n FROM cases GROUP BY batch_id) nb USING (batch_id)) q"""
_CLS_CTES = [("e", _E), ("ex", _EX), ("cases", _CASES)]


def _cases(spark, sf_dir):
    f = Fixture(spark, sf_dir)
    ex = threads.ticket_extract(f.tickets_raw(), f.messages_raw(), f.classes(), CFG)
    checkpoint_dir(spark)
    # The extract behind the cases is the dear part; prompts and alignment both read the cases.
    return classify.case_batches(ex, "id", "allMessages", BATCH).checkpoint()


def _aligned(spark, sf_dir):
    cases = _cases(spark, sf_dir)
    replies = classify.classify(classify.prompt_batches(cases), doubles.KeywordModel(CFG.chat_host))
    return classify.align_replies(cases, replies, "id").withColumnRenamed("id", "conversation_id")


@query("prompt_batches", with_("ts", "ms", "c", extra=_CLS_CTES) + f"""
SELECT batch_id, COUNT(*) AS n_cases,
  'Please classify each of the following support cases:' || {_NL} || {_NL}
  || string_agg('Case ' || CAST(pos AS VARCHAR) || ':' || {_NL} || '<Conversation>' || COALESCE(text, 'None')
                || '</Conversation>' || {_NL} || {_NL}, '' ORDER BY pos)
  || 'Please respond with a JSON array containing the classification for each case in order.' AS prompt
FROM cases GROUP BY batch_id""")
def q_prompt_batches(spark, sf_dir):
    return classify.prompt_batches(_cases(spark, sf_dir)).withColumn("batch_id", F.col("batch_id").cast("long"))


@query("reply_align", with_("ts", "ms", "c", extra=_CLS_CTES) + _ALIGNED)
def q_reply_align(spark, sf_dir):
    return _aligned(spark, sf_dir)


@query("classify_end_to_end", with_("ts", "ms", "c", extra=_CLS_CTES + [("r", _ALIGNED)]) + """
SELECT COALESCE(c.conversation_id, r.conversation_id) AS conversation_id,
  COALESCE(r.category, c.category) AS category, COALESCE(r.sub_category, c.sub_category) AS sub_category,
  COALESCE(r.reasoning, c.reasoning) AS reasoning, COALESCE(r.resolution, c.resolution) AS resolution,
  CAST(CASE WHEN c.conversation_id IS NULL THEN TIMESTAMP '2025-01-01 00:00:00' ELSE c.created_at END AS DATE)
    AS created_at,
  CAST(c.updated_time AS DATE) AS updated_time
FROM c FULL OUTER JOIN r ON c.conversation_id = r.conversation_id""")
def q_classify_end_to_end(spark, sf_dir):
    res = _aligned(spark, sf_dir).withColumn("arrival", F.lit(1))
    out = merge.upsert_coalesce(Fixture(spark, sf_dir).classes(), res, "conversation_id",
                                ["category", "sub_category", "reasoning", "resolution"], "arrival", RUN_TS)
    return _dated(out)


@query("prompt_batches_hash", with_("ts", "ms", "c", extra=_CLS_CTES) + """
SELECT substr(md5(id), 1, 8) || '-' || substr(md5(id), 9, 4) AS id, 1 AS in_batches, FALSE AS oversized,
  TRUE AS well_placed FROM cases""")
def q_prompt_batches_hash(spark, sf_dir):
    """Hash-mode batches over hex ids with hyphens: every case in one batch of at most ``BATCH``, at its own position."""
    f = Fixture(spark, sf_dir)
    ex = threads.ticket_extract(f.tickets_raw(), f.messages_raw(), f.classes(), CFG)
    h = F.md5("id")
    ex = ex.select(F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4)).alias("id"), "allMessages").checkpoint()
    cases = classify.case_batches(ex, "id", "allMessages", BATCH, mode="hash")
    n = classify.prompt_batches(cases).select("batch_id", "n_cases")
    each = cases.join(n, "batch_id").groupBy("id").agg(
        F.count_distinct("batch_id").cast("int").alias("in_batches"), (F.max("n_cases") > BATCH).alias("oversized"),
        (F.max(F.col("pos") - F.col("n_cases")) <= 0).alias("well_placed"))
    return each


@query("resolution_violations", with_("c") + """
SELECT conversation_id, resolution FROM c WHERE resolution IS NOT NULL AND resolution NOT IN ('res0', 'res1', 'res2', 'Error')""")
def q_resolution_violations(spark, sf_dir):
    c = Fixture(spark, sf_dir).classes().select("conversation_id", "resolution")
    return classify.resolution_violations(c, ("res0", "res1", "res2", "Error"))


@query("classify_single", with_("ms", extra=[("e", _E)]) + f"""
SELECT conversationId AS conversation_id, {KW_CAT} AS category, {KW_SUB} AS sub_category,
  'keyword' AS reasoning, {KW_RES} AS resolution
FROM (SELECT conversationId, allMessages AS x FROM e WHERE allMessages IS NOT NULL) q
WHERE CAST(conversationId AS BIGINT) % 7 <> 0""")
def q_classify_single(spark, sf_dir):
    m = silver.messages_silver(Fixture(spark, sf_dir).messages_raw(), CFG, drop_empty=False)
    th = threads.thread_summary(m, CFG.thread_separator, with_flag=False).where(F.col("allMessages").isNotNull())
    cases = th.select(F.col("conversationId").alias("conversation_id"),
                      F.col("conversationId").alias("batch_id"),
                      classify.single_prompt(F.col("allMessages")).alias("prompt"))
    replies = classify.classify(cases, doubles.KeywordModel(CFG.chat_host))
    return classify.single_results(cases.select("conversation_id", "batch_id"), replies, "conversation_id")


_TAX_VALUES = ", ".join(f"('{c}', '{s}')" for c, subs in FIXTURE_TAXONOMY.items() for s in subs)


@query("taxonomy_violations", with_("c") + f"""
SELECT conversation_id, category, sub_category FROM c
WHERE NOT EXISTS (SELECT 1 FROM (VALUES {_TAX_VALUES}) tx(category, sub_category)
                  WHERE tx.category = c.category AND tx.sub_category = c.sub_category)""")
def q_taxonomy_violations(spark, sf_dir):
    c = Fixture(spark, sf_dir).classes().select("conversation_id", "category", "sub_category")
    return classify.taxonomy_violations(c, classify.taxonomy_table(spark, FIXTURE_TAXONOMY))


# --- backfill ---------------------------------------------------------------------
_LINES = f"""
SELECT '2025-08-25 15:45:49,845 - INFO - Migrated ' || (CASE WHEN length(h) < 8 THEN lpad(h, 8, '0') ELSE h END)
  || ': ''' || COALESCE(f_cat, 'None') || ''' + ''' || COALESCE(f_sub, 'None') || ''' -> ''' || {LABEL_A} || ''''
  AS value
FROM (SELECT t.*, lower(hex(k)) AS h FROM t) q, (SELECT 1 AS cp UNION ALL SELECT 2) copies
WHERE cp = 1 OR k % 50 = 0"""
_IDS = """SELECT regexp_extract(value, 'Migrated ([a-f0-9-]+):', 1) AS conversation_id FROM lines
WHERE contains(value, '''None'' + ''None'' -> ''''') AND regexp_extract(value, 'Migrated ([a-f0-9-]+):', 1) <> ''"""
_REQ = "SELECT CAST(CAST('0x' || conversation_id AS BIGINT) AS VARCHAR) AS conversation_id FROM hex_ids"
_WH = """SELECT conversation_id, arg_max(ticket_category, version) AS cat, arg_max(ticket_sub_category, version) AS sub,
  arg_max(ticket_resolution, version) AS res
FROM stg WHERE conversation_id IN (SELECT conversation_id FROM req) GROUP BY conversation_id"""
_EMB = f"""SELECT conversationId AS id, COALESCE(string_agg(text, {_NL} || '<Next_Message>' || {_NL} ORDER BY ts)
  FILTER (WHERE text IS NOT NULL AND text <> ''), '') AS content FROM m GROUP BY conversationId"""
_USABLE = "COALESCE({0}, '') NOT IN ('', 'None')"
_RES = f"""
SELECT req.conversation_id, wh.conversation_id IS NOT NULL AS wh_found,
  CASE WHEN {_USABLE.format('wh.cat')} THEN 'warehouse' WHEN {_USABLE.format('t.f_cat')} THEN 'live'
       WHEN emb.content <> '' AND CAST(req.conversation_id AS BIGINT) % 7 <> 0 THEN 'model' ELSE 'none' END AS source,
  wh.cat, wh.sub, wh.res, t.f_cat, t.f_sub, emb.content AS x
FROM req LEFT JOIN wh ON req.conversation_id = wh.conversation_id
  LEFT JOIN t ON req.conversation_id = t.id LEFT JOIN emb ON req.conversation_id = emb.id"""
_PICKED = f"""
SELECT conversation_id, wh_found, source,
  CASE source WHEN 'warehouse' THEN cat WHEN 'live' THEN f_cat WHEN 'model' THEN {KW_CAT} END AS category,
  CASE source WHEN 'warehouse' THEN sub WHEN 'live' THEN f_sub WHEN 'model' THEN {KW_SUB} END AS sub_category,
  CASE source WHEN 'warehouse' THEN res WHEN 'live' THEN NULL END AS resolution
FROM res0"""
_LAB = f"""
SELECT p.*, CASE WHEN source = 'none' THEN NULL WHEN {_USABLE.format('category')} = false THEN ''
  WHEN {_USABLE.format('sub_category')} = false THEN category ELSE category || ' - ' || sub_category END
  AS migration_label FROM picked p"""
_OK = """
SELECT l.*, CASE WHEN source = 'none' THEN NULL
  WHEN COALESCE(category, '') = '' AND COALESCE(sub_category, '') = '' AND COALESCE(migration_label, '') = ''
       AND COALESCE(resolution, '') = '' THEN false
  ELSE CAST(conversation_id AS BIGINT) % 17 <> 0 END AS ok FROM lab l"""
_BACKFILL_CTES = [("lines", _LINES), ("hex_ids", _IDS), ("req", _REQ), ("wh", _WH), ("emb", _EMB),
                  ("res0", _RES), ("picked", _PICKED), ("lab", _LAB), ("applied", _OK)]


def _log_ids(spark, sf_dir):
    f = Fixture(spark, sf_dir)
    return backfill.log_empty_ids(fx.migration_log(f.t.orders, f.t.customer, CFG))


def _ticket_ids(ids):
    """Fixture log ids are the hex form of the ticket key; map them back."""
    return ids.select(F.conv("conversation_id", 16, 10).alias("conversation_id"))


@query("log_empty_ids", with_("t", extra=_BACKFILL_CTES[:2]) + "SELECT conversation_id FROM hex_ids")
def q_log_empty_ids(spark, sf_dir):
    return _log_ids(spark, sf_dir)


@query("warehouse_lookup", with_("t", "stg", extra=_BACKFILL_CTES[:4]) + """
SELECT conversation_id, cat AS ticket_category, sub AS ticket_sub_category, res AS ticket_resolution FROM wh""")
def q_warehouse_lookup(spark, sf_dir):
    f = Fixture(spark, sf_dir)
    return backfill.warehouse_lookup(f.staging(), _ticket_ids(_log_ids(spark, sf_dir)), "version")


@query("embedded_thread", with_("m", extra=[("emb", _EMB)]) + "SELECT id, content FROM emb")
def q_embedded_thread(spark, sf_dir):
    docs = fx.thread_documents(Fixture(spark, sf_dir).t.conversations, CFG)
    return backfill.embedded_thread(docs, EMBEDDED_THREAD_SEPARATOR)


def _applied(spark, sf_dir):
    f = Fixture(spark, sf_dir)
    resolved = backfill.backfill(_ticket_ids(_log_ids(spark, sf_dir)), f.staging(), f.tickets_raw(),
                                 fx.thread_documents(f.t.conversations, CFG), doubles.KeywordModel(CFG.chat_host), CFG, "version")
    return backfill.apply_backfill(resolved, doubles.KeyModuloFailures(17))


@query("backfill_resolve", with_("t", "stg", "m", extra=_BACKFILL_CTES) + """
SELECT conversation_id, source, category, sub_category, resolution, migration_label, ok FROM applied""")
def q_backfill_resolve(spark, sf_dir):
    return _applied(spark, sf_dir).select("conversation_id", "source", "category", "sub_category", "resolution",
                                          "migration_label", "ok")


@query("backfill_funnel", with_("t", "stg", "m", extra=_BACKFILL_CTES) + """
SELECT COUNT(*) AS total_conversations,
  COUNT(DISTINCT CASE WHEN wh_found THEN conversation_id END) AS warehouse_found,
  COUNT(*) FILTER (WHERE source = 'live') AS live_found, COUNT(*) FILTER (WHERE source = 'model') AS model_classified,
  COUNT(*) FILTER (WHERE ok) AS updated_successfully, COUNT(*) FILTER (WHERE source <> 'none' AND NOT ok) AS failed,
  COUNT(*) FILTER (WHERE source = 'none') AS no_data_found
FROM applied""")
def q_backfill_funnel(spark, sf_dir):
    return backfill.backfill_funnel(_applied(spark, sf_dir))
