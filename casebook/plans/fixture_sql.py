"""SQL (DuckDB dialect) for the fixture tables, computed from the raw driver
columns, so the oracles check the Spark JSON path independently.

Each constant is a CTE body; ``with_(...)`` assembles a WITH clause.
"""

from __future__ import annotations

from casebook.config import FIXTURE_SETTINGS as FX

T = f"""
SELECT CAST(o.o_orderkey AS VARCHAR) AS id, o.o_orderkey AS k, o.o_custkey AS n,
  CASE o.o_orderkey % 3 WHEN 0 THEN 'chat' WHEN 1 THEN 'email' ELSE 'portal' END AS sourceType,
  CASE WHEN o.o_orderkey % 97 = 0 THEN NULL WHEN o.o_orderkey % 10 = 0 THEN 'open'
       WHEN o.o_orderstatus = 'O' THEN 'in_progress' WHEN o.o_orderstatus = 'P' THEN 'on_hold'
       WHEN o.o_orderstatus = 'F' THEN 'closed' END AS raw_status,
  c.c_name AS customer_name,
  CASE WHEN o.o_custkey % 5 IN (0, 1) THEN NULL ELSE c.c_mktsegment END AS first_tag,
  CASE WHEN o.o_orderkey % 7 = 0 THEN '' WHEN o.o_orderkey % 7 = 1 THEN NULL
       ELSE 'agent' || CAST(o.o_orderkey % 13 AS VARCHAR) END AS assignee_name,
  'c' || CAST(o.o_custkey AS VARCHAR) || '@cust.example' AS submitter,
  CAST(o.o_orderdate AS DATE) AS dt,
  CAST(CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 30 AS INTEGER) AS DATE) AS upd,
  CAST(o.o_orderkey % 3600 AS VARCHAR) AS responseTime,
  CAST(o.o_orderkey % 500 AS VARCHAR) AS waitingOnAgentTime,
  CASE WHEN o.o_orderkey % 2 <> 0 THEN CAST(o.o_orderkey % 700 AS VARCHAR) END AS waitingOnCustomerTime,
  substr(o.o_orderpriority, 1, 1) AS priority,
  c.c_mktsegment AS ticketType,
  o.o_orderpriority || ' ' || c.c_name AS title,
  CASE WHEN o.o_orderkey % 4 <> 2 THEN 'Summary of order ' || CAST(o.o_orderkey AS VARCHAR) END AS summary,
  CASE o.o_orderkey % 5 WHEN 0 THEN 'positive' WHEN 1 THEN 'negative' ELSE 'neutral' END AS sentiment,
  CASE WHEN o.o_orderkey % 11 <> 0 THEN 'C' || CAST(o.o_custkey % 50 AS VARCHAR) END AS channelId,
  'm' || CAST(o.o_orderkey AS VARCHAR) AS initialMessageId,
  CASE WHEN o.o_orderkey % 13 <> 0 THEN CAST(o.o_orderkey + 1700000000 AS VARCHAR) || '.'
       || lpad(CAST(o.o_orderkey % 1000000 AS VARCHAR), 6, '0') END AS ts,
  CASE WHEN o.o_orderkey % 4 = 0 THEN NULL WHEN o.o_orderkey % 4 = 1 THEN '' ELSE c.c_mktsegment END AS f_cat,
  CASE WHEN o.o_orderkey % 6 = 0 THEN NULL WHEN o.o_orderkey % 6 = 1 THEN '' WHEN o.o_orderkey % 6 = 2 THEN 'None'
       ELSE o.o_orderpriority END AS f_sub,
  o.o_orderpriority AS o_orderpriority, o.o_orderstatus AS o_orderstatus
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
"""

# Tickets with derived columns (status label, days, age) on top of T.
TS = f"""
SELECT t.*,
  CASE WHEN raw_status = 'in_progress' THEN 'pending_customer' WHEN raw_status = 'on_hold' THEN 'pending_engineering'
       ELSE raw_status END AS status,
  COALESCE(first_tag, '{FX.default_plan_category}') AS plan_category,
  COALESCE(NULLIF(assignee_name, ''), '{FX.unassigned_label}') AS assignedTo,
  CASE WHEN raw_status = 'closed' THEN CAST(dt + CAST(k % 20 AS INTEGER) AS DATE) END AS closed,
  CASE WHEN raw_status = 'closed' THEN CAST((k % 20) * 86400 AS VARCHAR) END AS resolutionTime,
  CAST(date_trunc('week', dt) AS DATE) AS creation_week,
  CAST(CASE WHEN raw_status = 'closed' THEN k % 20 ELSE DATE '{FX.as_of.isoformat()}' - dt END AS BIGINT) AS age
FROM t
"""

M = f"""
SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS id,
  CAST(conv_id AS VARCHAR) AS conversationId, conv_id, turn, role,
  lpad(CAST(turn AS VARCHAR), 6, '0') AS ts,
  '2024-01-' || lpad(CAST(conv_id % 28 + 1 AS VARCHAR), 2, '0') AS updatedAt,
  (turn % 4 = 3) AS isPrivateNote,
  CASE WHEN role = 'system' THEN 'helper' END AS botName,
  CASE WHEN (conv_id + turn) % 13 = 0 THEN NULL WHEN (conv_id + turn) % 11 = 0 THEN ''
       WHEN (conv_id + turn) % 17 = 0 THEN '""'
       ELSE text || CASE WHEN conv_id % 9 = 0 THEN ' {FX.chat_host}' ELSE '' END END AS text,
  CASE WHEN role = 'assistant' THEN 'Agent' || CAST(conv_id % 5 AS VARCHAR) || '@Staff.example'
       WHEN role = 'user' THEN '' END AS user_email,
  CASE WHEN role = 'user' THEN 'c' || CAST(conv_id AS VARCHAR) || '@cust.example' END AS sent_email
FROM conversations
"""

_EXCL = ", ".join(f"'{x}'" for x in FX.excluded_senders)

# Messages with sender and the three-valued escalation flag.
MS = f"""
SELECT m.*, COALESCE(NULLIF(user_email, ''), sent_email) AS sender,
  (strpos(text, '{FX.chat_host}') > 0
   OR (lower(COALESCE(NULLIF(user_email, ''), sent_email)) LIKE '%@{FX.staff_domain}'
       AND lower(COALESCE(NULLIF(user_email, ''), sent_email)) NOT IN ({_EXCL}))) AS flag
FROM m
"""

C = """
SELECT CAST(o_orderkey AS VARCHAR) AS conversation_id, o_orderkey AS k,
  CASE WHEN o_orderkey % 15 <> 0 THEN o_orderpriority END AS category,
  o_orderstatus AS sub_category,
  'r' || CAST(o_orderkey AS VARCHAR) AS reasoning,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 25 = 0 THEN 'Error'
       ELSE 'res' || CAST(o_orderkey % 6 AS VARCHAR) END AS resolution,
  CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS created_at,
  CASE WHEN o_orderkey % 2 <> 0 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)
       + to_days(CAST(o_orderkey % 5 - 2 AS INTEGER)) END AS updated_time
FROM orders WHERE o_orderkey % 3 = 0
"""

CLU = """
SELECT 'ex' || CAST(o_orderkey AS VARCHAR) || '-' || CAST(cp AS VARCHAR) AS example_id,
  CAST(o_orderkey AS VARCHAR) AS ticket_id, 's' || CAST(o_orderkey AS VARCHAR) AS summary,
  'cluster' || CAST(o_orderkey % 7 AS VARCHAR) AS cluster_name, o_orderpriority AS category
FROM orders, (SELECT 1 AS cp UNION ALL SELECT 2) AS copies
WHERE o_orderkey % 6 = 0 AND (cp = 1 OR o_orderkey % 12 = 0)
"""

DIR = """
SELECT 'c' || CAST(c_custkey AS VARCHAR) || '@cust.example' AS email, CAST(c_custkey AS VARCHAR) AS user_id,
  c_name AS user_name, c_mktsegment AS segment
FROM customer
"""

STG = """
SELECT conversation_id, CASE WHEN k % 7 = 0 THEN 'None' ELSE category END AS ticket_category,
  sub_category AS ticket_sub_category, resolution AS ticket_resolution, 1 AS version
FROM c
UNION ALL
SELECT conversation_id, 'v2-' || COALESCE(category, 'x') AS ticket_category,
  sub_category AS ticket_sub_category, resolution AS ticket_resolution, 2 AS version
FROM c WHERE k % 21 = 0
"""

UPD = """
SELECT CAST(o_orderkey AS VARCHAR) AS conversation_id,
  CASE WHEN o_orderkey % 2 <> 0 THEN 'new-' || o_orderpriority END AS category,
  CAST(NULL AS VARCHAR) AS sub_category, 'u' || CAST(o_orderkey AS VARCHAR) AS reasoning,
  CASE WHEN o_orderkey % 3 = 0 THEN 'fixed' END AS resolution, 1 AS arrival
FROM orders WHERE o_orderkey % 5 = 0
UNION ALL
SELECT CAST(o_orderkey AS VARCHAR), 'second', NULL, NULL, NULL, 2 FROM orders WHERE o_orderkey % 10 = 0
"""

# Migration label variants on the fixture custom fields.
LABEL_A = "concat_ws(' - ', NULLIF(f_cat, ''), NULLIF(f_sub, ''))"
LABEL_B = ("CASE WHEN COALESCE(f_cat, '') IN ('', 'None') THEN '' WHEN COALESCE(f_sub, '') IN ('', 'None') "
           "THEN f_cat ELSE f_cat || ' - ' || f_sub END")

# Pending write-back rows (category and resolution set, never written), with cluster.
PEND = """
SELECT c.conversation_id, c.k, c.category, c.sub_category, c.resolution, clu.cluster_name AS cluster, c.created_at
FROM c LEFT JOIN clu ON c.conversation_id = clu.ticket_id
WHERE c.category IS NOT NULL AND c.resolution IS NOT NULL AND c.updated_time IS NULL
"""

DEPS = {"ts": ["t"], "ms": ["m"], "stg": ["c"], "pend": ["c", "clu"]}
BODIES = {"t": T, "ts": TS, "m": M, "ms": MS, "c": C, "clu": CLU, "dir": DIR, "stg": STG, "upd": UPD,
          "pend": PEND}


def with_(*names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """WITH clause defining the named fixture CTEs (dependencies first)."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    parts = [f"{n} AS ({BODIES[n]})" for n in order] + [f"{n} AS ({b})" for n, b in (extra or [])]
    return "WITH " + ",\n".join(parts) + "\n"
