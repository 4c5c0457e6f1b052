"""Per-conversation message aggregates and the ticket extract (one pass over messages)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.config import Settings
from casebook.functions import columns as C
from casebook.operators import ordering
from casebook.operators.silver import messages_silver, tickets_silver
from casebook.session import checkpoint_dir


MOST_BROADCAST = 100_000  # ids; a longer list meets its tables by a shuffle


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def thread_summary(messages: DataFrame, sep: str, with_text: bool = True, with_flag: bool = True) -> DataFrame:
    """One row per conversation: any-escalation (``max`` of the three-valued
    flag, NULLs ignored) and the non-blank message texts joined by ``sep`` in
    ``(timestamp, id)`` order. Both aggregates share one shuffle on
    ``conversationId``; the flag is combined map-side, and ``listagg`` keeps a
    partial buffer per map task, so a very hot conversation is pre-aggregated
    before the exchange."""
    aggs = []
    if with_flag:
        aggs.append(F.max("internalEscalation").alias("internalEscalation"))
    if with_text:
        aggs.append(F.expr(
            f"listagg(text, {_sql_str(sep)}) WITHIN GROUP (ORDER BY timestamp, id) "
            f"FILTER (WHERE text IS NOT NULL AND trim(text) <> '' AND text <> '\"\"')").alias("allMessages"))
    return messages.groupBy("conversationId").agg(*aggs)


def thread_chunks(messages: DataFrame, sep: str, partitions: int | None = None) -> DataFrame:
    """``(conversationId, chunk, n_messages, n_chars, text)``: each conversation's texts in ``(timestamp, id)`` order, cut
    into chunks that follow each other.

    The messages are range-partitioned by conversation, time and id, so a conversation with a large share of all
    messages spans many partitions; each of them joins its own part. Chunks of one conversation ascend with ``chunk``."""
    m = messages.where(C.nonblank_text("text")).select("conversationId", "timestamp", "id", "text")
    rows = ordering.ranged(m, [F.col("conversationId"), F.col("timestamp"), F.col("id")], "thread-ranges", partitions)
    joined = F.expr(f"listagg(text, {_sql_str(sep)}) WITHIN GROUP (ORDER BY _at)")
    return rows.groupBy("conversationId", F.shiftright("_at", ordering.PLACE).alias("chunk")).agg(
        F.count(F.lit(1)).alias("n_messages"), F.sum(F.length("text")).alias("n_chars"), joined.alias("text"))


def thread_texts(chunks: DataFrame, sep: str, max_chars: int = 100_000_000) -> DataFrame:
    """``(conversationId, allMessages)`` from chunks, joined in their order. Conversations of more than ``max_chars``
    characters, too long for one value, are left out: read them from the chunk table (``long_threads``)."""
    fits = chunks.join(long_threads(chunks, max_chars), "conversationId", "left_anti")
    joined = F.expr(f"listagg(text, {_sql_str(sep)}) WITHIN GROUP (ORDER BY chunk)")
    return fits.groupBy("conversationId").agg(joined.alias("allMessages"))


def long_threads(chunks: DataFrame, max_chars: int = 100_000_000) -> DataFrame:
    """``(conversationId, n_chars, n_chunks)`` of the conversations that stay in chunks."""
    size = chunks.groupBy("conversationId").agg(F.sum("n_chars").alias("n_chars"), F.count(F.lit(1)).alias("n_chunks"))
    return size.where(F.col("n_chars") > max_chars)


def classifications_view(classes: DataFrame) -> DataFrame:
    """The renamed classification columns joined into the extract."""
    return classes.select(
        F.col("conversation_id").alias("conversationId"),
        F.col("category").alias("ai_category"),
        "sub_category", "reasoning", "resolution",
    )


def _first_tickets(tickets_raw: DataFrame, messages_raw: DataFrame, classes: DataFrame, cfg: Settings, limit: int,
                   unresolved_only: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Tickets, classifications and raw messages of the first ``limit`` tickets by id.

    The ids come from the document keys alone; tickets are parsed, and messages kept, for those ids only. A
    message's conversation is read from its document by one path before the semi join."""
    ids = tickets_raw.where(F.col("data").isNotNull()).select("id")
    if unresolved_only:
        solved = classes.where(F.col("resolution").isNotNull()).select(F.col("conversation_id").alias("id"))
        ids = ids.join(solved, "id", "left_anti")
    checkpoint_dir(tickets_raw.sparkSession)
    ids = ids.orderBy("id").limit(limit).checkpoint()
    if limit <= MOST_BROADCAST:
        ids = F.broadcast(ids)
    cl = classifications_view(classes.join(ids, classes.conversation_id == ids.id, "left_semi"))
    t = tickets_silver(tickets_raw.join(ids, "id", "left_semi"), cfg)
    of = messages_raw.where(F.col("data").isNotNull()).withColumn("_c", F.get_json_object("data", "$.conversationId"))
    return t, cl, of.join(ids, F.col("_c") == ids.id, "left_semi").drop("_c")


def ticket_extract(tickets_raw: DataFrame, messages_raw: DataFrame, classes: DataFrame, cfg: Settings,
                   limit: int | None = None, unresolved_only: bool = True) -> DataFrame:
    """Ticket rows with escalation, thread text and classification.

    Three left joins on the conversation id; every right side has one row per
    key, so each join is a plain sort-merge (or AQE broadcast when small) with
    no fan-out. ``unresolved_only`` keeps tickets without a classification or
    with a NULL resolution (a left join + IS NULL, not an anti join: a row
    with NULL resolution also qualifies). ``limit`` takes the first rows by id;
    they are chosen before anything is assembled, so only their own messages
    are parsed in full and shuffled.
    """
    t = tickets_silver(tickets_raw, cfg)
    cl = classifications_view(classes)
    messages = messages_raw
    if limit is not None:
        t, cl, messages = _first_tickets(tickets_raw, messages_raw, classes, cfg, limit, unresolved_only)
    m = messages_silver(messages, cfg, drop_empty=False)
    out = assemble_extract(t, m, cl, cfg, unresolved_only)
    if limit is not None:
        out = out.orderBy("id").limit(limit)
    return out


def assemble_extract(tickets: DataFrame, messages: DataFrame, classes: DataFrame, cfg: Settings,
                     unresolved_only: bool = True) -> DataFrame:
    """The extract from silver tickets, silver messages and the classification view.

    From tables bucketed alike by the conversation (``write_bucketed``) neither the message aggregate nor
    the joins need an exchange."""
    th = thread_summary(messages, cfg.thread_separator)
    out = tickets.join(classes, tickets.id == classes.conversationId, "left").drop("conversationId")
    if unresolved_only:
        out = out.where(F.col("resolution").isNull())
    return out.join(th, tickets.id == th.conversationId, "left").drop("conversationId").select(
        *[c for c in tickets.columns if c not in ("creation_week", "age")],
        F.coalesce(F.col("internalEscalation"), F.lit(False)).alias("internalEscalation"),
        "creation_week", "age", "allMessages", "ai_category", "sub_category", "reasoning", "resolution",
    )


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Store ``df`` as catalogue table ``table``, bucketed and sorted by ``key``, one file a bucket; the table as a frame.

    Tables with equal bucket counts and key types meet without an exchange. A conversation's rows share one
    bucket: choose the count by the largest table, so that a bucket is a task's work."""
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def summary_inputs(extract: DataFrame) -> DataFrame:
    """The three columns handed to the classifier, selected by name."""
    return extract.select(F.col("id").alias("conversation_id"), "ticketType",
                          F.col("allMessages").alias("message_content"))
