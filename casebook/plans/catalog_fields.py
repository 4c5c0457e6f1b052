"""Custom-field migration, payload, paging and write-back outcome queries
(P12-P18, L1, L6, F3, F4, F6, J6, X1, X2, C10, K5-K8, G7, G8, G10)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from casebook.functions import columns as C
from casebook.operators import fields, silver, writeback
from casebook.plans import doubles
from casebook.plans.common import CFG, Fixture
from casebook.plans.fixture_sql import LABEL_A, LABEL_B, with_
from casebook.plans.registry import query
from casebook.session import scratch_path
from casebook.sources import fixtures as fx


def _tickets(spark, sf_dir):
    return silver.ticket_fields(Fixture(spark, sf_dir).tickets_raw())


def _labelled(spark, sf_dir, variant):
    t = fields.migrated_fields(_tickets(spark, sf_dir), CFG, variant)
    return t.select("id", "category", "sub_category", "migration_label")


@query("migration_label_a", with_("t") + f"""
SELECT id, f_cat AS category, f_sub AS sub_category, {LABEL_A} AS migration_label FROM t""")
def q_migration_label_a(spark, sf_dir):
    return _labelled(spark, sf_dir, "a")


@query("migration_label_b", with_("t") + f"""
SELECT id, f_cat AS category, f_sub AS sub_category, {LABEL_B} AS migration_label FROM t""")
def q_migration_label_b(spark, sf_dir):
    return _labelled(spark, sf_dir, "b")


@query("migration_payload", with_("t") + f"""
SELECT id, 'cat' AS field_key, f_cat AS field_value FROM t
UNION ALL SELECT id, 'sub', f_sub FROM t
UNION ALL SELECT id, 'other', 'x' FROM t
UNION ALL SELECT id, 'mig', {LABEL_A} FROM t""")
def q_migration_payload(spark, sf_dir):
    t = fields.migrated_fields(_tickets(spark, sf_dir), CFG, "a")
    return fields.explode_fields(t, "id", "new_fields")


@query("writeback_payload_full", with_("pend") + """
SELECT conversation_id, 'cat' AS field_key, category AS field_value FROM pend
UNION ALL SELECT conversation_id, 'res', resolution FROM pend
UNION ALL SELECT conversation_id, 'sub', sub_category FROM pend
UNION ALL SELECT conversation_id, 'clu', cluster FROM pend""")
def q_writeback_payload_full(spark, sf_dir):
    f = Fixture(spark, sf_dir)
    p = writeback.pending_updates(f.classes(), f.clusters(), limit=None)
    m = fields.field_map(CFG, {"category": F.col("category"), "resolution": F.col("resolution"),
                               "sub_category": F.col("sub_category"), "cluster": F.col("cluster")})
    return fields.explode_fields(p.withColumn("m", m), "conversation_id", "m")


_TRUTHY_SRC = ("stg", """
SELECT conversation_id, ticket_category AS cat, ticket_sub_category AS sub, ticket_resolution AS res,
  CASE WHEN COALESCE(ticket_category, '') IN ('', 'None') THEN ''
       WHEN COALESCE(ticket_sub_category, '') IN ('', 'None') THEN ticket_category
       ELSE ticket_category || ' - ' || ticket_sub_category END AS mig
FROM stg""")


@query("writeback_payload_truthy", with_("stg", extra=[("s", _TRUTHY_SRC[1])]) + """
SELECT conversation_id, 'cat' AS field_key, cat AS field_value FROM s WHERE COALESCE(cat, '') <> ''
UNION ALL SELECT conversation_id, 'sub', sub FROM s WHERE COALESCE(sub, '') <> ''
UNION ALL SELECT conversation_id, 'mig', mig FROM s WHERE COALESCE(mig, '') <> ''
UNION ALL SELECT conversation_id, 'res', res FROM s WHERE COALESCE(res, '') <> ''
UNION ALL SELECT conversation_id, NULL, NULL FROM s
  WHERE COALESCE(cat, '') = '' AND COALESCE(sub, '') = '' AND COALESCE(mig, '') = '' AND COALESCE(res, '') = ''""")
def q_writeback_payload_truthy(spark, sf_dir):
    s = Fixture(spark, sf_dir).staging()
    m = fields.field_map(CFG, {
        "category": F.col("ticket_category"), "sub_category": F.col("ticket_sub_category"),
        "migration": C.label_b("ticket_category", "ticket_sub_category"),
        "resolution": F.col("ticket_resolution")})
    return fields.explode_fields(s.withColumn("m", C.drop_blank_values(m)), "conversation_id", "m")


@query("tickets_page", with_("t") + """
SELECT id, f_cat AS category, f_sub AS sub_category FROM t ORDER BY id LIMIT 50 OFFSET 150""")
def q_tickets_page(spark, sf_dir):
    t = fields.with_categories(_tickets(spark, sf_dir), CFG)
    return fields.page(t.select("id", "category", "sub_category"), [F.col("id")], 3, 50)


_REQ = "SELECT CAST(p_partkey * 11 AS VARCHAR) AS id FROM part"


@query("tickets_by_ids", with_("t") + f"SELECT id, title FROM t WHERE id IN ({_REQ})")
def q_tickets_by_ids(spark, sf_dir):
    f = Fixture(spark, sf_dir)
    return fields.rows_by_ids(silver.ticket_fields(f.tickets_raw()), fx.requested_ids(f.t.part), "id") \
        .select("id", "title")


@query("missing_ids", with_("t") + f"""
SELECT DISTINCT r.id FROM ({_REQ}) r WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.id = r.id)""")
def q_missing_ids(spark, sf_dir):
    f = Fixture(spark, sf_dir)
    return fields.missing_ids(fx.requested_ids(f.t.part), silver.ticket_fields(f.tickets_raw()), "id")


@query("modified_range", with_("t") + """
SELECT id, strftime(upd, '%Y-%m-%d') || 'T12:00:00.000Z' AS updatedAt FROM t
WHERE upd BETWEEN DATE '1996-01-01' AND DATE '1996-03-31'
ORDER BY updatedAt DESC, id DESC""")
def q_modified_range(spark, sf_dir):
    t = _tickets(spark, sf_dir)
    return fields.modified_between(t, "1996-1-1", "1996-3-31").select("id", "updatedAt") \
        .orderBy(F.col("updatedAt").desc(), F.col("id").desc())


@query("append_pages", with_("t") + "SELECT id, sourceType, raw_status AS status FROM t")
def q_append_pages(spark, sf_dir):
    """Four stored pages with differing column orders, each read once."""
    t = _tickets(spark, sf_dir).select("id", "sourceType", "status")
    out = scratch_path(spark, f"casebook-runs/pages-{uuid.uuid4().hex}")
    t.withColumn("page", F.pmod(F.col("id").cast("long"), F.lit(4))).write.partitionBy("page").parquet(out)
    pages = [spark.read.schema(t.schema).parquet(f"{out}/page={i}").select(*(["status", "id", "sourceType"] if i % 2 else t.columns))
             for i in range(4)]
    return fields.append_pages(pages)


@query("migration_dry_run", with_("t") + f"""
SELECT id, f_cat AS category, f_sub AS sub_category, {LABEL_A} AS migration_label FROM t ORDER BY id LIMIT 5""")
def q_migration_dry_run(spark, sf_dir):
    return _labelled(spark, sf_dir, "a").orderBy("id").limit(5)


def _migration_outcomes(spark, sf_dir):
    t = fields.migrated_fields(_tickets(spark, sf_dir), CFG, "a")
    t = t.withColumn("payload", fields.payload(F.col("new_fields"), wrap=True))
    return writeback.write_back(t, doubles.KeyModuloFailures(17), key="id")


@query("migration_outcomes", with_("t") + """
SELECT k // 50 AS batch, COUNT(*) AS processed, COUNT(*) FILTER (WHERE k % 17 <> 0) AS successful,
  COUNT(*) FILTER (WHERE k % 17 = 0) AS failed, COUNT(DISTINCT k // 50) AS batches
FROM t GROUP BY ROLLUP (k // 50)""")
def q_migration_outcomes(spark, sf_dir):
    o = _migration_outcomes(spark, sf_dir).withColumn("batch", F.floor(F.col("id").cast("long") / 50))
    return writeback.outcome_stats(o, "batch")


@query("migration_errors", with_("t") + """
SELECT id, 'API update failed' AS error FROM t WHERE k % 17 = 0 ORDER BY id LIMIT 5""")
def q_migration_errors(spark, sf_dir):
    return writeback.first_errors(_migration_outcomes(spark, sf_dir), 5)


@query("success_rate", with_("t") + """
SELECT COUNT(*) AS processed, COUNT(*) FILTER (WHERE k % 17 <> 0) AS successful,
  COALESCE(COUNT(*) FILTER (WHERE k % 17 <> 0) * 100.0 / NULLIF(COUNT(*), 0), 0.0) AS success_rate FROM t""")
def q_success_rate(spark, sf_dir):
    return writeback.success_rate(_migration_outcomes(spark, sf_dir))
