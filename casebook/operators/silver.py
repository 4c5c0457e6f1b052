"""Silver projections: parse each JSON document once into typed columns.

``from_json`` with an explicit schema parses the document a single time and
lets Catalyst prune the struct to the fields a query reads. Persist the result
as parquet (``write_silver``) so later jobs push filters into row groups
instead of re-parsing text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from casebook import schemas
from casebook.config import Settings
from casebook.functions import columns as C


def parse_documents(raw: DataFrame, schema) -> DataFrame:
    """Bronze ``(id, data)`` -> ``(id, doc struct)``; rows with NULL data are dropped."""
    return raw.where(F.col("data").isNotNull()).select("id", F.from_json("data", schema).alias("doc"))


def parse_fields(raw: DataFrame, schema) -> DataFrame:
    """Bronze ``(id, data)`` -> ``id`` plus every document field except ``id`` as a column.

    The parse goes through ``inline(array(from_json(...)))``: filters on parsed
    fields cannot be pushed below a generator, so each document is parsed once
    even when a later ``where`` tests a parsed field (pushed through a plain
    projection, the filter would re-run ``from_json`` on every row)."""
    names = [f.name for f in schema.fields]
    parsed = raw.where(F.col("data").isNotNull()).select(
        F.col("id").alias("_key"), F.inline(F.array(F.from_json("data", schema))))
    return parsed.select(F.col("_key").alias("id"), *[c for c in names if c != "id"])


def ticket_fields(raw: DataFrame) -> DataFrame:
    """All parsed ticket fields as top-level columns (``id`` is the document key)."""
    return parse_fields(raw, schemas.TICKET_DOC)


def tickets_silver(raw: DataFrame, cfg: Settings) -> DataFrame:
    """Normalised ticket view (the 18 raw columns plus escalation-free derived ones)."""
    return ticket_view(ticket_fields(raw), cfg)


def ticket_view(t: DataFrame, cfg: Settings) -> DataFrame:
    """The view from parsed ticket fields, however they were parsed."""
    created, updated, closed = C.as_day("createdAt"), C.as_day("updatedAt"), C.as_day("closedAt")
    return t.select(
        "id",
        "sourceType",
        C.status_label("status", cfg.status_remap).alias("status"),
        C.plan_category(F.col("customer.tags"), cfg.default_plan_category).alias("plan_category"),
        C.assignee(F.col("assignedToUser.name"), cfg.unassigned_label).alias("assignedTo"),
        created.alias("createdAt"),
        updated.alias("updatedAt"),
        closed.alias("closedAt"),
        "responseTime", "resolutionTime", "waitingOnAgentTime", "waitingOnCustomerTime", "priority",
        F.col("ticketType.name").alias("ticketType"),
        F.col("submitterUser.email").alias("submitter"),
        "title", "summary", "sentiment",
        C.week_start(created).alias("creation_week"),
        C.age_days("status", closed, created, cfg.as_of).alias("age"),
    )


def messages_silver(raw: DataFrame, cfg: Settings, drop_empty: bool = True) -> DataFrame:
    """Normalised message view with sender and three-valued escalation flag.

    ``drop_empty`` keeps only messages whose text is present and not empty
    (the raw-message listing)."""
    m = parse_fields(raw, schemas.MESSAGE_DOC)
    snd = C.sender(F.col("user.email"), F.col("sentByUser.email"))
    out = m.select(
        "id", "conversationId", "timestamp", "updatedAt", "isPrivateNote", "botName",
        snd.alias("sender"),
        "text",
        C.escalation_flag("text", snd, cfg.chat_host, cfg.staff_domain, cfg.excluded_senders).alias("internalEscalation"),
    )
    return out.where(C.nonempty_text("text")) if drop_empty else out


def message_senders(raw: DataFrame) -> DataFrame:
    """``(id, conversationId, sender)``: only the fields these need are parsed."""
    names = ("conversationId", "user", "sentByUser")
    m = parse_fields(raw, StructType([f for f in schemas.MESSAGE_DOC.fields if f.name in names]))
    return m.select("id", "conversationId", C.sender(F.col("user.email"), F.col("sentByUser.email")).alias("sender"))


def customers_silver(raw: DataFrame) -> DataFrame:
    d = parse_documents(raw, schemas.CUSTOMER_DOC)
    return d.select(
        "id",
        F.col("doc.name").alias("name"),
        F.col("doc.slackChannel.name").alias("slackChannel"),
        F.col("doc.slackChannel.isPrivate").alias("isPrivate"),
        F.col("doc.externalCrmMetadata.id").alias("crm_id"),
        F.get(F.col("doc.tags"), 0).getField("tier").alias("tier"),
    )


def write_silver(df: DataFrame, path: str, buckets_by: str | None = None, n_files: int | None = None) -> None:
    """Persist a silver table as parquet, clustered by its key so joins and
    point filters on that key read few row groups."""
    _clustered(df, buckets_by, n_files).write.mode("overwrite").parquet(path)


def _clustered(df: DataFrame, buckets_by: str | None, n_files: int | None) -> DataFrame:
    w = df.repartition(n_files, buckets_by) if (buckets_by and n_files) else df
    return w.sortWithinPartitions(buckets_by) if buckets_by else w


def write_silver_counted(df: DataFrame, path: str, counts: dict[str, Column], buckets_by: str | None = None,
                         n_files: int | None = None) -> dict[str, int]:
    """``write_silver``, and aggregates over the written rows from the same pass (no second action)."""
    seen = Observation()
    aggs = [c.alias(n) for n, c in counts.items()]
    _clustered(df, buckets_by, n_files).observe(seen, *aggs).write.mode("overwrite").parquet(path)
    return seen.get
