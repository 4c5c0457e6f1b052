"""Exact deduplication as a stateful stream, in DataFrame operations only.

Documents arrive as a file stream. The stream's keyed state lives on disk (RocksDB), never expires and holds
for each SHA-256 digest the group's size and its stable identifier and content locator: the largest doc_id with
the file and row where its text stands. A stream stopped and started again on the same state folder goes on
from there, so later files are compared with all earlier ones.

A hit (a digest with more than one row) is a claim only: the rows of hits are read again by their locators and
their full bytes are compared, by grouping on digest and text. Should two texts share a digest, its group is
split by text. Copies collapse before each shuffle, so a group may hold any share of the rows.

Edge cases: null text counts as empty; a null doc_id is smaller than all others; of rows that repeat both
doc_id and text, the one with the greatest locator stays; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm.frames import shared_path, stored, text_column

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else each partition's log reserves 4 MB of disk
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the time of a call."""
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _digested(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
        F.unhex(F.sha2(text_column().cast("binary"), 256)).alias("digest"),
        text_column().alias("text"),
    )


def update_state(spark: SparkSession, path: str, state: str, *, files_per_batch: int | None = None) -> None:
    """Feed all files under ``path`` that the state folder has not seen yet into the state."""
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    path = path.rstrip("/")
    path = f"{path[:-1]}[{path[-1]}]"  # as a pattern, a path may be one file as well as a folder
    held = _digested(reader.parquet(path)).groupBy("digest").agg(F.count("*").alias("size"), F.max(F.struct("doc_id", "file", "row")).alias("keep"))
    with _settings(spark, STATE_CONF):
        run = held.writeStream.outputMode("update").format("noop").option("checkpointLocation", state).trigger(availableNow=True).start()
        run.awaitTermination()


def read_state(spark: SparkSession, state: str) -> DataFrame:
    """(digest, size, keep_id, keep_file, keep_row): the state as a table, read from its checkpoint."""
    with _settings(spark, STATE_CONF):
        df = spark.read.format("statestore").load(state)
    size, keep = df.schema["value"].dataType.names
    keep = F.col(f"value.`{keep}`")
    return df.select(
        F.col("key.digest").alias("digest"), F.col(f"value.`{size}`").alias("size"), keep["doc_id"].alias("keep_id"), keep["file"].alias("keep_file"), keep["row"].alias("keep_row")
    )


def collisions(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """Digests of ``hits`` (digest, file, row) under which differing texts stand."""
    texts = docs.select("file", "row", "text").join(hits, ["file", "row"])
    return texts.groupBy("digest", "text").agg(F.count("*").alias("n")).groupBy("digest").agg(F.count("*").alias("texts")).where("texts > 1").select("digest")


def deduplicate(spark: SparkSession, path: str, *, state: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """One row per document under ``path``: doc_id, keep_id, group_size, kept, text_sha256, keep_file, keep_row.

    ``files_per_batch`` bounds a micro-batch; by default one batch takes all files that are there.
    """
    state = state or shared_path(spark, "dedup-state")
    update_state(spark, path, state, files_per_batch=files_per_batch)
    docs = _digested(spark.read.parquet(path))
    rows = stored(docs.drop("text").join(read_state(spark, state), "digest"), "dedup-rows")
    bad = stored(collisions(docs, rows.where("size > 1").select("digest", "file", "row")), "dedup-collisions")
    if not bad.isEmpty():
        texts = docs.join(bad, "digest")
        each = texts.groupBy("digest", "text").agg(F.count("*").alias("size"), F.max(F.struct("doc_id", "file", "row")).alias("k"))
        split = texts.join(each, ["digest", "text"]).select(
            *docs.drop("text").columns, "size", F.col("k.doc_id").alias("keep_id"), F.col("k.file").alias("keep_file"), F.col("k.row").alias("keep_row")
        )
        rows = rows.join(bad, "digest", "left_anti").unionByName(split)
    return rows.select(
        "doc_id",
        "keep_id",
        F.col("size").cast("long").alias("group_size"),
        ((F.col("file") == F.col("keep_file")) & (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "keep_file",
        "keep_row",
    )
