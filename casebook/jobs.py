"""Job entry points: the command surface as Spark jobs over stored tables.

Each job reads parquet tables (or a feed), composes the operators, and writes
its result as a new parquet table under the given paths; nothing passes
through the driver. ``dry_run`` jobs compute the same plan without the sink.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook import schemas
from casebook.config import Settings
from casebook.operators import backfill, classify, fields, merge, silver, tagging, writeback
from casebook.session import checkpoint_dir
from casebook.sources import paged
from casebook.streaming.mergeonread import MergeOnReadTable
from casebook.streaming.snapshot import BucketedSnapshot


def ingest(spark: SparkSession, entity: str, fetcher: str, table_path: str, modified_after: str | None = None,
           modified_before: str | None = None, conversation_id: str | None = None, num_partitions: int = 8,
           buckets: int = 256, merge_on_read: bool = False, **options: str) -> None:
    """Download one entity from the paged feed and upsert it: the later run wins, within a run the
    latest ``updatedAt``. The feed is read once (the merge checkpoints it).

    With ``merge_on_read`` the table is a ``MergeOnReadTable``: a run writes what it changed, other writers
    may commit meanwhile, and ``compact`` has to be run now and then."""
    paged.register(spark)
    r = spark.read.format("paged_feed").option("entity", entity).option("fetcher", fetcher) \
        .option("numPartitions", str(num_partitions)).options(**options)
    if modified_after:
        r = r.option("modifiedAfter", modified_after)
    if modified_before:
        r = r.option("modifiedBefore", modified_before)
    feed = r.load().where("id IS NOT NULL")
    if conversation_id:
        feed = feed.where(F.col("id") == conversation_id)
    snap = (MergeOnReadTable if merge_on_read else BucketedSnapshot)(table_path, "id", feed.schema, buckets)
    snap.merge(feed, lambda cur, new: merge.replace_rows(cur, merge.latest_by_arrival(new, "id", ["updatedAt"]), "id"))


def _sent(outcomes: DataFrame) -> DataFrame:
    """Run the writer now, once, and keep its outcomes: reading them later sends nothing again."""
    checkpoint_dir(outcomes.sparkSession)
    return outcomes.checkpoint(eager=True)


ENTITIES = ("users", "customers", "conversations", "messages")


def ingest_conversations(spark: SparkSession, fetcher: str, root: str, modified_after: str | None = None,
                         modified_before: str | None = None, conversation_id: str | None = None,
                         num_partitions: int = 8, fetch_partitions: int | None = None, buckets: int = 256,
                         **options: str) -> DataFrame:
    """Conversations with their details and messages: list the ids, fetch each one's detail and its message chain.

    Stores ``root/conversations`` and ``root/messages`` (last write wins) and appends to ``root/dead_letters`` what
    could not be fetched: ``(kind, id, error)``. Each id is fetched once. Returns the counts per kind."""
    paged.register(spark)
    checkpoint_dir(spark)
    root = root.rstrip("/")
    r = spark.read.format("paged_feed").options(entity="conversations", fetcher=fetcher, numPartitions=str(num_partitions), **options)
    for name, value in (("modifiedAfter", modified_after), ("modifiedBefore", modified_before), ("id", conversation_id)):
        r = r.option(name, value) if value else r
    listed = r.load().checkpoint(eager=True)
    known = listed.where("id IS NOT NULL")
    ids = merge.latest_by_arrival(known.select("id", "updatedAt"), "id", ["updatedAt"])
    details = paged.fetch_details(ids, fetcher, partitions=fetch_partitions).checkpoint(eager=True)
    found = details.where("error IS NULL").join(ids, "id").select("id", "updatedAt", "data")
    snap = BucketedSnapshot(f"{root}/conversations", "id", found.schema, buckets)
    snap.merge(found, lambda cur, new: merge.replace_rows(cur, new, "id"))
    pages = paged.fetch_pages_per_key(found.select(F.col("id").alias("key")), fetcher, partitions=fetch_partitions) \
        .checkpoint(eager=True)
    rows = merge.latest_by_arrival(pages.where("error IS NULL AND id IS NOT NULL").select("id", "updatedAt", "data"), "id", ["updatedAt"])
    snap = BucketedSnapshot(f"{root}/messages", "id", rows.schema, buckets)
    snap.merge(rows, lambda cur, new: merge.replace_rows(cur, new, "id"))
    dead = (listed.where("id IS NULL").select(F.lit("listing").alias("kind"), "id", F.lit("record without id").alias("error"))
            .unionByName(details.where("error IS NOT NULL").select(F.lit("conversation").alias("kind"), "id", "error"))
            .unionByName(pages.where("error IS NOT NULL").select(F.lit("messages").alias("kind"), F.col("key").alias("id"), "error"))
            .unionByName(pages.where("error IS NULL AND id IS NULL").select(F.lit("message").alias("kind"), F.col("key").alias("id"),
                                                                            F.lit("record without id").alias("error"))))
    dead.write.mode("append").parquet(f"{root}/dead_letters")
    counts = found.select(F.lit("conversations").alias("kind")).unionByName(rows.select(F.lit("messages").alias("kind"))) \
        .unionByName(dead.select(F.lit("dead_letters").alias("kind")))
    return counts.groupBy("kind").agg(F.count("*").alias("n"))


def ingest_all(spark: SparkSession, fetcher: str, root: str, modified_after: str | None = None,
               modified_before: str | None = None, num_partitions: int = 8) -> None:
    """The ``all`` command: every entity, customers included, each into ``root/<entity>``.
    Date bounds apply to the time-filtered entities only (conversations, messages)."""
    for entity in ENTITIES:
        timed = entity in ("conversations", "messages")
        ingest(spark, entity, fetcher, f"{root.rstrip('/')}/{entity}",
               modified_after if timed else None, modified_before if timed else None,
               num_partitions=num_partitions)


def write_back_job(classes: BucketedSnapshot | MergeOnReadTable, clusters: DataFrame, send: writeback.Send, cfg: Settings,
                   run_ts: _dt.datetime, limit: int | None = None, include_stale: bool = False,
                   partitions: int | None = None, outcome_log: str | None = None,
                   run_id: str | None = None) -> DataFrame:
    """Pending classifications -> wrapped payload -> writer -> mark processed. Returns the outcomes.

    Delivery to the remote API is at-least-once (a retried task may send a
    row again; the payload is idempotent). ``outcome_log`` appends every
    outcome as ``(run_id, id, ok, error, run_ts)`` to a parquet log
    partitioned by ``run_id``, the audit trail of what each run sent."""
    spark = clusters.sparkSession
    pend = writeback.pending_updates(classes.read(spark), clusters, limit=limit, include_stale=include_stale)
    body = fields.payload(fields.field_map(cfg, {"category": F.col("category"), "resolution": F.col("resolution"),
                                                 "sub_category": F.col("sub_category"),
                                                 "cluster": F.col("cluster")}), wrap=True)
    outcomes = writeback.write_back(pend.withColumn("payload", body), send, key="conversation_id",
                                    partitions=partitions)
    outcomes = _sent(outcomes)
    classes.merge(outcomes, lambda cur, o: merge.mark_updated(cur, o, "conversation_id", run_ts), batch_key="id")
    if outcome_log:
        rid = run_id or run_ts.strftime("%Y%m%dT%H%M%S")
        (outcomes.withColumn("run_id", F.lit(rid)).withColumn("run_ts", merge.ts_literal(run_ts))
         .write.mode("append").partitionBy("run_id").parquet(outcome_log))
    return outcomes


def classify_job(extract: DataFrame, classes: BucketedSnapshot | MergeOnReadTable, model: classify.Model, run_ts: _dt.datetime,
                 batch_size: int = 10, max_conversations: int | None = None) -> DataFrame:
    """Batch-classify the extract's conversations and merge the results (null-preserving).
    The returned results are checkpointed, so they stay valid after the merge."""
    inputs = extract.select(F.col("id"), F.col("allMessages"))
    if max_conversations:
        inputs = inputs.orderBy("id").limit(max_conversations)
    # Persist the two-column input once: hash batching counts it and then reads
    # it again, and the extract behind it is the expensive part.
    inputs = inputs.checkpoint(eager=True)
    cases = classify.case_batches(inputs, "id", "allMessages", batch_size, mode="hash")
    replies = classify.classify(classify.prompt_batches(cases), model)
    # Materialise the results before the merge replaces the snapshot buckets
    # the inputs may have been read from.
    res = classify.align_replies(cases, replies, "id").withColumnRenamed("id", "conversation_id") \
        .withColumn("arrival", F.lit(1)).checkpoint(eager=True)
    cols = ["category", "sub_category", "reasoning", "resolution"]
    classes.merge(res, lambda cur, r: merge.upsert_coalesce(cur, r, "conversation_id", cols, "arrival", run_ts))
    return res


def migrate_fields(tickets_raw: DataFrame, cfg: Settings, send: writeback.Send, ticket_ids: DataFrame | None = None,
                   max_tickets: int | None = None, dry_run: bool = False, buckets: int = 64) -> DataFrame:
    """Set the migration field (label variant A) on every ticket, keeping its other fields.
    Returns outcome statistics per id hash bucket plus the total (or the label
    preview when ``dry_run``)."""
    t = silver.ticket_fields(tickets_raw)
    if ticket_ids is not None:
        t = fields.rows_by_ids(t, ticket_ids, "id")
    if max_tickets:
        t = t.orderBy("id").limit(max_tickets)
    t = fields.migrated_fields(t, cfg, "a")
    if dry_run:
        return t.select("id", "category", "sub_category", "migration_label").orderBy("id").limit(5)
    t = t.withColumn("payload", fields.payload(F.col("new_fields"), wrap=True))
    out = _sent(writeback.write_back(t, send, key="id"))
    return writeback.outcome_stats(out.withColumn("batch", F.pmod(F.xxhash64("id"), F.lit(max(1, buckets)))), "batch")


def backfill_categories(log_lines: DataFrame, staging: DataFrame, live_docs: DataFrame, thread_docs: DataFrame,
                        model: classify.Model, send: writeback.Send, cfg: Settings,
                        limit: int | None = None) -> DataFrame:
    """Ids with empty migrations -> first usable tier -> truthy write-back. Returns the funnel."""
    ids = backfill.log_empty_ids(log_lines)
    if limit is not None:
        ids = ids.orderBy("conversation_id").limit(limit)
    resolved = backfill.backfill(ids, staging, live_docs, thread_docs, model, cfg)
    return backfill.backfill_funnel(_sent(backfill.apply_backfill(resolved, send)))


def tag_open_tickets(tickets_raw: DataFrame, reactions: DataFrame, send: writeback.Send, cfg: Settings,
                     dry_run: bool = True) -> DataFrame:
    """Add the ticket emoji to open chat tickets that lack it. ``dry_run`` (the
    default) plans the actions without sending: status 'would_add' / 'skipped'."""
    flags = tagging.reaction_flags(tagging.open_chat_tickets(tickets_raw, cfg), reactions, cfg.ticket_emoji)
    if dry_run:
        return flags.select("conversation_id", F.when(F.col("has_emoji"), "skipped").otherwise("would_add")
                            .alias("status"))
    return _sent(tagging.reaction_plan(flags, send))


__all__ = ["ingest", "ingest_all", "write_back_job", "classify_job", "migrate_fields", "backfill_categories", "tag_open_tickets",
           "schemas"]
