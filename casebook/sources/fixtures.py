"""Support-data fixtures derived from the driver tables (see FIXTURES.md section 3).

The driver ships TPC-H-like tables; the operators work on support documents.
These functions derive the documents deterministically from the tables, so the
fixture data grows with the scale factor. Ticket, message and customer
documents are serialised to JSON text here (bronze) and parsed back by the
silver operators, exactly as production documents are. The SQL oracles
evaluate the same formulas on the raw columns.

Formulas beyond FIXTURES.md (fields it leaves open), k = o_orderkey:
responseTime = k % 3600; resolutionTime = (k % 20) * 86400 when closed;
waitingOnAgentTime = k % 500; waitingOnCustomerTime = k % 700 unless k even;
summary = 'Summary of order ' || k unless k % 4 = 2; sentiment by k % 5
(0 positive, 1 negative, else neutral); initialMessageId = 'm' || k.
Messages: updatedAt = '2024-01-' || lpad(1 + conv_id % 28, 2, '0');
isPrivateNote = turn % 4 = 3; botName = 'helper' for role system.
Customers: slackChannel = {'cs-' || key, key % 2 = 0}; CRM id 'crm' || key
unless key % 3 = 0; tag tier 'tier' || (nationkey % 3).
Clusters: example_id 'ex' || k || '-' || copy, summary 's' || k,
cluster_name 'cluster' || (k % 7), category o_orderpriority.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.config import FIXTURE_SETTINGS, Settings

_TAGS_T = "array<struct<name:string>>"


def _s(x) -> Column:
    return x.cast("string")


def _iso(day: Column) -> Column:
    return F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T12:00:00.000Z"))


def _ticket_status(k: Column, orderstatus: Column) -> Column:
    return (F.when(k % 97 == 0, F.lit(None).cast("string"))
            .when(k % 10 == 0, F.lit("open"))
            .when(orderstatus == "O", F.lit("in_progress"))
            .when(orderstatus == "P", F.lit("on_hold"))
            .when(orderstatus == "F", F.lit("closed")))


def _customer_tags(n: Column, segment: Column, tier: Column | None = None) -> Column:
    item = F.struct(segment.alias("name")) if tier is None else F.struct(segment.alias("name"), tier.alias("tier"))
    typ = _TAGS_T if tier is None else "array<struct<name:string,tier:string>>"
    return (F.when(n % 5 == 0, F.array().cast(typ))
            .when(n % 5 == 1, F.lit(None).cast(typ))
            .otherwise(F.array(item)))


def ticket_rows(orders: DataFrame, customer: DataFrame, cfg: Settings = FIXTURE_SETTINGS) -> DataFrame:
    """Typed ticket fields (one row per order) before JSON serialisation."""
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    c = customer.select("c_custkey", "c_name", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    k, n = F.col("o_orderkey"), F.col("o_custkey")
    dt = F.col("o_orderdate").cast("date")
    status = _ticket_status(k, F.col("o_orderstatus"))
    closed = F.when(status == "closed", F.date_add(dt, (k % 20).cast("int")))
    fields = F.create_map(
        F.lit(cfg.category_field_id),
        F.when(k % 4 == 0, F.lit(None).cast("string")).when(k % 4 == 1, F.lit("")).otherwise(F.col("c_mktsegment")),
        F.lit(cfg.sub_category_field_id),
        (F.when(k % 6 == 0, F.lit(None).cast("string")).when(k % 6 == 1, F.lit(""))
         .when(k % 6 == 2, F.lit("None")).otherwise(F.col("o_orderpriority"))),
        F.lit("other"), F.lit("x"),
    )
    return j.select(
        _s(k).alias("id"),
        k.alias("k"), n.alias("n"),
        F.when(k % 3 == 0, "chat").when(k % 3 == 1, "email").otherwise("portal").alias("sourceType"),
        status.alias("status"),
        F.struct(F.col("c_name").alias("name"), _customer_tags(n, F.col("c_mktsegment")).alias("tags")).alias("customer"),
        F.struct(F.when(k % 7 == 0, F.lit("")).when(k % 7 == 1, F.lit(None).cast("string"))
                 .otherwise(F.concat(F.lit("agent"), _s(k % 13))).alias("name")).alias("assignedToUser"),
        F.struct(F.concat(F.lit("c"), _s(n), F.lit("@cust.example")).alias("email")).alias("submitterUser"),
        _iso(dt).alias("createdAt"),
        _iso(F.date_add(dt, (k % 30).cast("int"))).alias("updatedAt"),
        _iso(closed).alias("closedAt"),
        _s(k % 3600).alias("responseTime"),
        F.when(status == "closed", _s((k % 20) * 86400)).alias("resolutionTime"),
        _s(k % 500).alias("waitingOnAgentTime"),
        F.when(k % 2 != 0, _s(k % 700)).alias("waitingOnCustomerTime"),
        F.substring("o_orderpriority", 1, 1).alias("priority"),
        F.struct(F.col("c_mktsegment").alias("name")).alias("ticketType"),
        F.concat_ws(" ", "o_orderpriority", "c_name").alias("title"),
        F.when(k % 4 != 2, F.concat(F.lit("Summary of order "), _s(k))).alias("summary"),
        F.when(k % 5 == 0, "positive").when(k % 5 == 1, "negative").otherwise("neutral").alias("sentiment"),
        F.when(k % 11 != 0, F.concat(F.lit("C"), _s(n % 50))).alias("channelId"),
        F.concat(F.lit("m"), _s(k)).alias("initialMessageId"),
        F.struct(F.when(k % 13 != 0, F.concat(_s(k + 1700000000), F.lit("."),
                                               F.lpad(_s(k % 1000000), 6, "0"))).alias("ts")).alias("initialMessage"),
        fields.alias("ticketTypeFields"),
    )


_DOC_DROP = ("k", "n")


def _json(body: Column) -> Column:
    """JSON text of a (never NULL) struct, typed non-nullable so a downstream
    ``data IS NOT NULL`` check folds away instead of serialising twice."""
    return F.coalesce(F.to_json(body), F.lit("{}"))


def ticket_documents(orders: DataFrame, customer: DataFrame, cfg: Settings = FIXTURE_SETTINGS,
                     partitions: int | None = None) -> DataFrame:
    """Bronze ticket documents ``(id, data)``: one JSON text per order.
    With ``partitions`` the rows are hash-partitioned by ``id`` first (as a
    bronze table bucketed by its key would be)."""
    rows = ticket_rows(orders, customer, cfg)
    if partitions is not None:
        rows = rows.repartition(partitions, "id") if partitions > 0 else rows.repartition("id")
    body = F.struct(*[c for c in rows.columns if c not in _DOC_DROP])
    return rows.select("id", _json(body).alias("data"))


def message_rows(conversations: DataFrame, cfg: Settings = FIXTURE_SETTINGS) -> DataFrame:
    cv = conversations.select("conv_id", "turn", "role", "text")
    cid, turn, role = F.col("conv_id"), F.col("turn"), F.col("role")
    key = cid + turn
    text = (F.when(key % 13 == 0, F.lit(None).cast("string"))
            .when(key % 11 == 0, F.lit(""))
            .when(key % 17 == 0, F.lit('""'))
            .otherwise(F.concat(F.col("text"), F.when(cid % 9 == 0, F.lit(" " + cfg.chat_host)).otherwise(F.lit("")))))
    staff = cfg.staff_domain[:1].upper() + cfg.staff_domain[1:]
    return cv.select(
        F.concat(_s(cid), F.lit("-"), _s(turn)).alias("id"),
        _s(cid).alias("conversationId"),
        F.lpad(_s(turn), 6, "0").alias("timestamp"),
        F.concat(F.lit("2024-01-"), F.lpad(_s(cid % 28 + 1), 2, "0")).alias("updatedAt"),
        (turn % 4 == 3).alias("isPrivateNote"),
        F.when(role == "system", F.lit("helper")).alias("botName"),
        F.struct(F.when(role == "assistant", F.concat(F.lit("Agent"), _s(cid % 5), F.lit("@" + staff)))
                 .when(role == "user", F.lit("")).alias("email")).alias("user"),
        F.struct(F.when(role == "user", F.concat(F.lit("c"), _s(cid), F.lit("@cust.example"))).alias("email"))
        .alias("sentByUser"),
        text.alias("text"),
    )


def message_documents(conversations: DataFrame, cfg: Settings = FIXTURE_SETTINGS) -> DataFrame:
    rows = message_rows(conversations, cfg)
    return rows.select("id", _json(F.struct(*rows.columns)).alias("data"))


def customer_documents(customer: DataFrame) -> DataFrame:
    n = F.col("c_custkey")
    doc = F.struct(
        _s(n).alias("id"),
        F.col("c_name").alias("name"),
        F.struct(F.concat(F.lit("cs-"), _s(n)).alias("name"), (n % 2 == 0).alias("isPrivate")).alias("slackChannel"),
        F.when(n % 3 != 0, F.struct(F.concat(F.lit("crm"), _s(n)).alias("id"))).alias("externalCrmMetadata"),
        _customer_tags(n, F.col("c_mktsegment"),
                       F.concat(F.lit("tier"), _s(F.col("c_nationkey") % 3))).alias("tags"),
    )
    return customer.select(_s(n).alias("id"), _json(doc).alias("data"))


def classifications(orders: DataFrame) -> DataFrame:
    """Classification facts for every third order (typed, no JSON)."""
    k = F.col("o_orderkey")
    created = F.col("o_orderdate").cast("date").cast("timestamp")
    return orders.where(k % 3 == 0).select(
        _s(k).alias("conversation_id"),
        F.when(k % 15 != 0, F.col("o_orderpriority")).alias("category"),
        F.col("o_orderstatus").alias("sub_category"),
        F.concat(F.lit("r"), _s(k)).alias("reasoning"),
        (F.when(k % 4 == 0, F.lit(None).cast("string")).when(k % 25 == 0, F.lit("Error"))
         .otherwise(F.concat(F.lit("res"), _s(k % 6)))).alias("resolution"),
        created.alias("created_at"),
        F.when(k % 2 != 0, created + F.make_dt_interval(days=(k % 5 - 2).cast("int"))).alias("updated_time"),
    )


def clusters(orders: DataFrame) -> DataFrame:
    """Cluster lookup: one row for k % 6 = 0, two for k % 12 = 0 (fan-out on ticket_id)."""
    k = F.col("o_orderkey")
    base = orders.where(k % 6 == 0).select(k, "o_orderpriority",
                                           F.explode(F.when(k % 12 == 0, F.array(F.lit(1), F.lit(2)))
                                                     .otherwise(F.array(F.lit(1)))).alias("copy"))
    return base.select(
        F.concat(F.lit("ex"), _s(k), F.lit("-"), _s(F.col("copy"))).alias("example_id"),
        _s(k).alias("ticket_id"),
        F.concat(F.lit("s"), _s(k)).alias("summary"),
        F.concat(F.lit("cluster"), _s(k % 7)).alias("cluster_name"),
        F.col("o_orderpriority").alias("category"),
    )


def directory(customer: DataFrame) -> DataFrame:
    """User directory keyed by email."""
    n = F.col("c_custkey")
    return customer.select(F.concat(F.lit("c"), _s(n), F.lit("@cust.example")).alias("email"),
                           _s(n).alias("user_id"), F.col("c_name").alias("user_name"),
                           F.col("c_mktsegment").alias("segment"))


def staging(orders: DataFrame) -> DataFrame:
    """Warehouse staging rows: the classifications with 'None' categories for
    k % 7 = 0 and a second (later) row for k % 21 = 0."""
    c = classifications(orders)
    k = F.col("conversation_id").cast("long")
    first = c.select(
        "conversation_id",
        F.when(k % 7 == 0, F.lit("None")).otherwise(F.col("category")).alias("ticket_category"),
        F.col("sub_category").alias("ticket_sub_category"),
        F.col("resolution").alias("ticket_resolution"),
        F.lit(1).alias("version"),
    )
    second = c.where(k % 21 == 0).select(
        "conversation_id",
        F.concat(F.lit("v2-"), F.coalesce(F.col("category"), F.lit("x"))).alias("ticket_category"),
        F.col("sub_category").alias("ticket_sub_category"),
        F.col("resolution").alias("ticket_resolution"),
        F.lit(2).alias("version"),
    )
    return first.unionByName(second)


def reactions(orders: DataFrame, cfg: Settings = FIXTURE_SETTINGS) -> DataFrame:
    """Stored reactions per message: the ticket emoji present when k % 5 = 0."""
    k = F.col("o_orderkey")
    rows = orders.where(k % 13 != 0).select(k, "o_custkey")
    return rows.select(
        F.concat(F.lit("C"), _s(F.col("o_custkey") % 50)).alias("channel"),
        F.concat(_s(k + 1700000000), F.lit("."), F.lpad(_s(k % 1000000), 6, "0")).alias("ts"),
        F.when(k % 5 == 0, F.array(F.lit("eyes"), F.lit(cfg.ticket_emoji)))
        .otherwise(F.array(F.lit("eyes"))).alias("names"),
    )


def migration_log(orders: DataFrame, customer: DataFrame, cfg: Settings = FIXTURE_SETTINGS) -> DataFrame:
    """Migration log lines (``value`` column, like ``spark.read.text``): one per
    ticket, a second copy for k % 50 = 0. Ids are the lower-case hex of k padded
    to 8; values are written Python style ('None' for a missing value)."""
    t = ticket_rows(orders, customer, cfg)
    cat = F.element_at("ticketTypeFields", F.lit(cfg.category_field_id))
    sub = F.element_at("ticketTypeFields", F.lit(cfg.sub_category_field_id))
    from casebook.functions.columns import label_a

    def q(x):
        return F.concat(F.lit("'"), F.coalesce(x, F.lit("None")), F.lit("'"))

    h = F.lower(F.hex(F.col("k")))
    hex_id = F.when(F.length(h) < 8, F.lpad(h, 8, "0")).otherwise(h)
    line = F.concat(F.lit("2025-08-25 15:45:49,845 - INFO - Migrated "), hex_id,
                    F.lit(": "), q(cat), F.lit(" + "), q(sub), F.lit(" -> "), q(label_a(cat, sub)))
    copies = F.when(F.col("k") % 50 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return t.select(line.alias("value"), F.explode(copies).alias("_copy")).select("value")


def classification_updates(orders: DataFrame) -> DataFrame:
    """Partial classification updates (``arrival`` orders them): one for
    k % 5 = 0 and a later one for k % 10 = 0; NULL means 'no new value'."""
    k = F.col("o_orderkey")
    first = orders.where(k % 5 == 0).select(
        _s(k).alias("conversation_id"),
        F.when(k % 2 != 0, F.concat(F.lit("new-"), F.col("o_orderpriority"))).alias("category"),
        F.lit(None).cast("string").alias("sub_category"),
        F.concat(F.lit("u"), _s(k)).alias("reasoning"),
        F.when(k % 3 == 0, F.lit("fixed")).alias("resolution"),
        F.lit(1).alias("arrival"),
    )
    second = orders.where(k % 10 == 0).select(
        _s(k).alias("conversation_id"), F.lit("second").alias("category"),
        F.lit(None).cast("string").alias("sub_category"), F.lit(None).cast("string").alias("reasoning"),
        F.lit(None).cast("string").alias("resolution"), F.lit(2).alias("arrival"),
    )
    return first.unionByName(second)


def requested_ids(part: DataFrame) -> DataFrame:
    """Requested ticket ids (``id``): 11 x partkey, so some exist and some do not."""
    return part.select(_s(F.col("p_partkey") * 11).alias("id"))


def thread_documents(conversations: DataFrame, cfg: Settings = FIXTURE_SETTINGS) -> DataFrame:
    """Conversation documents with their messages embedded (``messages[].content``
    in turn order), built from the message fixture. Assembled with an ordered
    ``listagg`` of per-message JSON, which Spark pre-aggregates map-side."""
    m = message_rows(conversations, cfg).select("conversationId", F.col("timestamp"),
                                                 F.to_json(F.struct(F.col("text").alias("content"))).alias("j"))
    g = m.groupBy("conversationId").agg(F.expr("listagg(j, ',') WITHIN GROUP (ORDER BY timestamp)").alias("arr"))
    return g.select(F.col("conversationId").alias("id"),
                    F.concat(F.lit('{"id":"'), F.col("conversationId"), F.lit('","messages":['), F.col("arr"),
                             F.lit("]}")).alias("data"))


def reaction_replies(conversations: DataFrame, cfg: Settings = FIXTURE_SETTINGS) -> DataFrame:
    """Stored chat-API replies per message (``id``, ``reply`` JSON text):
    a failure for (conv_id + turn) % 19 = 0, else the message with its text,
    user, type, subtype and one reaction on even turns."""
    cv = conversations.select("conv_id", "turn", "role", "text")
    cid, turn = F.col("conv_id"), F.col("turn")
    bad = (cid + turn) % 19 == 0
    msg = F.struct(
        F.col("text").alias("text"), F.concat(F.lit("U"), _s(cid % 7)).alias("user"), F.lit("message").alias("type"),
        F.when(F.col("role") == "system", F.lit("bot_message")).alias("subtype"),
        F.when(turn % 2 == 0, F.array(F.struct(F.lit("eyes").alias("name"))))
        .otherwise(F.array().cast("array<struct<name:string>>")).alias("reactions"))
    body = F.when(bad, F.to_json(F.struct(F.lit(False).alias("ok"), F.lit("missing_scope").alias("error")))) \
        .otherwise(F.to_json(F.struct(F.lit(True).alias("ok"), msg.alias("message"))))
    return cv.select(F.concat(_s(cid), F.lit("-"), _s(turn)).alias("id"), body.alias("reply"))
