"""A keyed table that is merged on read: delta files, deletion vectors, optimistic commits, compaction.

A merge writes the new rows as delta files and, for each data file that held an old version of a changed row, a
deletion vector: the sorted positions (Parquet row indexes) of its dead rows. Nothing else is rewritten, so the bytes
written follow the size of the batch and not of the table. Readers take the rows of all live files without those that
a vector names. ``compact`` rewrites buckets whose dead rows or files have become too many.

Rows are clustered by a hash bucket of the key (an ordinary column, sorted within files), and the log keeps each
file's first and last bucket: a merge looks for old versions only in files and row groups that hold touched buckets.

The log is one JSON file for each commit, named by its number and published by a rename that fails if the name is
taken (put-if-absent). A writer that loses the race looks at the commits it hadn't read. If none of them touched its
keys or a file it deletes from, its commit is published under the next number; otherwise it is built anew from the
newest state. A crash before the rename leaves files that no commit names; ``vacuum`` removes them. Every
``CHECKPOINT`` commits the whole state is written beside the log, so reading it stays short.

Each commit keeps which rows it removed and added, so ``changes`` gives every changed row before and after.
The driver handles file names and counts only. Renames must be atomic in the store (HDFS and local folders are;
an object store needs a committer that offers put-if-absent).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from casebook.session import checkpoint_dir

MergeFn = Callable[[DataFrame, DataFrame], DataFrame]  # (current rows of the batch's keys, batch) -> their new rows
CHECKPOINT = 16


class Conflict(Exception):
    """A commit in between touched the same keys or files."""


@dataclass
class State:
    """The table as of one commit: live data files and the vectors that delete from them."""

    seq: int = 0
    files: dict[str, dict] = field(default_factory=dict)  # relative name -> {rows, bytes, lo, hi}
    vectors: dict[str, dict[str, int]] = field(default_factory=dict)  # folder -> {data file: dead rows}

    def apply(self, commit: dict) -> None:
        self.seq = commit["seq"]
        self.files.update(commit["add"])
        for f in commit["remove"]:
            self.files.pop(f, None)
        if commit["vectors"]:
            self.vectors.update(commit["vectors"])
        self.vectors = {v: live for v, dead in self.vectors.items() if (live := {f: n for f, n in dead.items() if f in self.files})}

    def dead(self) -> dict[str, int]:
        out: dict[str, int] = {}
        for dead in self.vectors.values():
            for f, n in dead.items():
                out[f] = out.get(f, 0) + n
        return out


@dataclass
class Change:
    """A commit that isn't published yet."""

    read: State
    add: dict[str, dict]
    vectors: dict[str, dict[str, int]]
    remove: list[str]
    keys: DataFrame | None  # of the batch; None for a compaction
    kind: str

    def entry(self, seq: int) -> dict:
        return {"seq": seq, "kind": self.kind, "add": self.add, "remove": self.remove, "vectors": self.vectors}


class MergeOnReadTable:
    def __init__(self, path: str, key: str, schema: StructType, buckets: int = 64, rows_per_file: int = 1_000_000):
        self.path, self.key, self.schema = path.rstrip("/"), key, schema
        self.buckets, self.rows_per_file = buckets, rows_per_file
        self.stored = StructType([*schema.fields, StructField("_bucket", IntegerType())])

    # --- the log ---

    def _fs(self, spark: SparkSession):
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, spark: SparkSession, *parts: str):
        return spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def _names(self, spark: SparkSession, folder: str) -> list[str]:
        fs, at = self._fs(spark), self._at(spark, folder)
        return sorted(x.getPath().getName() for x in fs.listStatus(at)) if fs.exists(at) else []

    def _load(self, spark: SparkSession, folder: str, names: list[str]) -> list[dict]:
        if not names:
            return []
        rows = spark.read.option("wholetext", "true").text([f"{self.path}/{folder}/{n}" for n in names]).collect()
        return sorted((json.loads(r["value"]) for r in rows), key=lambda c: c["seq"])

    def _put_if_absent(self, spark: SparkSession, folder: str, name: str, content: dict) -> bool:
        fs = self._fs(spark)
        draft = self._at(spark, "_drafts", uuid.uuid4().hex)
        out = fs.create(draft, False)
        out.write(json.dumps(content).encode())
        out.close()
        fs.mkdirs(self._at(spark, folder))
        context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
        rename = spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
        options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = rename
        try:
            context.rename(draft, self._at(spark, folder, name), options)
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" not in e.java_exception.getClass().getName():
                raise
            fs.delete(draft, False)
            return False
        return True

    def commits(self, spark: SparkSession, after: int = 0, upto: int | None = None) -> list[dict]:
        """The log's entries with ``after < seq <= upto``."""
        names = [n for n in self._names(spark, "log") if after < int(n[:20]) and (upto is None or int(n[:20]) <= upto)]
        return self._load(spark, "log", names)

    def state(self, spark: SparkSession, seq: int | None = None) -> State:
        """The state as of commit ``seq`` (the newest by default)."""
        saved = [n for n in self._names(spark, "checkpoints") if seq is None or int(n[:20]) <= seq]
        s = State(**self._load(spark, "checkpoints", saved[-1:])[0]) if saved else State()
        for c in self.commits(spark, s.seq, seq):
            s.apply(c)
        if seq is not None and s.seq != seq:
            raise ValueError(f"{self.path} has no commit {seq}")
        return s

    # --- reading ---

    def _bucket(self, key: str | None = None):
        return F.pmod(F.xxhash64(F.col(key or self.key)), F.lit(self.buckets)).cast("int")

    def _place(self):
        return [F.regexp_extract("_metadata.file_path", r"/data/([^/]+/[^/]+)$", 1).alias("_file"), F.col("_metadata.row_index").alias("_row")]

    def _vector_rows(self, spark: SparkSession, folders: list[str]) -> DataFrame:
        """(_file, _row) of the dead rows that vectors name."""
        dv = spark.read.schema("file string, positions array<long>").parquet(*[f"{self.path}/vectors/{v}" for v in folders])
        return dv.select(F.col("file").alias("_file"), F.explode("positions").alias("_row"))

    def _live(self, spark: SparkSession, s: State, files: list[str] | None = None) -> DataFrame:
        """Live rows of ``files`` (all by default) with their places. Only files that a vector names take part in the join."""
        files = set(s.files if files is None else files)
        folders = {v: hit for v, dead in s.vectors.items() if (hit := files & set(dead))}
        touched = {f for hit in folders.values() for f in hit}
        frames = []
        for part, dead in ((sorted(files - touched), False), (sorted(touched), True)):
            if part:
                df = spark.read.schema(self.stored).parquet(*[f"{self.path}/data/{f}" for f in part]).select(*self.stored.names, *self._place())
                frames.append(df.join(self._vector_rows(spark, sorted(folders)), ["_file", "_row"], "left_anti") if dead else df)
        if not frames:
            return spark.createDataFrame([], self.stored).select("*", F.lit("").alias("_file"), F.lit(0).cast("long").alias("_row"))
        return reduce(DataFrame.unionByName, frames).select(*self.stored.names, "_file", "_row")

    def read(self, spark: SparkSession, seq: int | None = None) -> DataFrame:
        """The rows as of commit ``seq`` (the newest by default); an empty frame before the first one."""
        return self._live(spark, self.state(spark, seq)).select(*self.schema.names)

    def changes(self, spark: SparkSession, after: int, upto: int | None = None) -> DataFrame:
        """Changed rows of the commits ``after < seq <= upto``: the table's columns, ``_change`` (``before`` / ``after``) and ``_seq``.

        Reads the commits' delta files, their vectors, and the data files those name; compactions change no row.
        """
        frames = []
        for c in self.commits(spark, after, upto):
            if c["kind"] == "compact":
                continue
            if c["add"]:
                new = spark.read.schema(self.stored).parquet(*[f"{self.path}/data/{f}" for f in sorted(c["add"])])
                frames.append(new.select(*self.schema.names, F.lit("after").alias("_change"), F.lit(c["seq"]).cast("long").alias("_seq")))
            if c["remove"]:  # a replaced table: all its rows
                old = self._live(spark, self.state(spark, c["seq"] - 1), c["remove"])
                frames.append(old.select(*self.schema.names, F.lit("before").alias("_change"), F.lit(c["seq"]).cast("long").alias("_seq")))
            for v, dead in c["vectors"].items():
                old = spark.read.schema(self.stored).parquet(*[f"{self.path}/data/{f}" for f in sorted(dead)]).select(*self.schema.names, *self._place())
                old = old.join(self._vector_rows(spark, [v]), ["_file", "_row"], "left_semi")
                frames.append(old.select(*self.schema.names, F.lit("before").alias("_change"), F.lit(c["seq"]).cast("long").alias("_seq")))
        if not frames:
            return spark.createDataFrame([], self.schema).select("*", F.lit("").alias("_change"), F.lit(0).cast("long").alias("_seq")).where("false")
        return reduce(DataFrame.unionByName, frames)

    # --- writing ---

    def _write(self, df: DataFrame, rows: int) -> dict[str, dict]:
        """Write data files clustered by bucket and key; their names with rows, bytes, first and last bucket."""
        if not rows:
            return {}
        spark, folder = df.sparkSession, uuid.uuid4().hex
        df = df.select(*self.schema.names).withColumn("_bucket", self._bucket())
        n = -(-rows // self.rows_per_file)
        df = df.repartitionByRange(n, "_bucket", self.key) if n > 1 else df.coalesce(1)
        df.sortWithinPartitions("_bucket", self.key).write.parquet(f"{self.path}/data/{folder}")
        written = spark.read.schema(self.stored).parquet(f"{self.path}/data/{folder}")
        stats = written.select(*self._place(), "_bucket", F.col("_metadata.file_size").alias("size"))
        stats = stats.groupBy("_file").agg(F.count("*").alias("rows"), F.first("size").alias("bytes"), F.min("_bucket").alias("lo"), F.max("_bucket").alias("hi"))
        return {r["_file"]: {k: r[k] for k in ("rows", "bytes", "lo", "hi")} for r in stats.collect()}

    def _write_vectors(self, hit: DataFrame) -> dict[str, dict[str, int]]:
        """One vector for each data file: the sorted positions in it. A vector is no longer than its file."""
        spark, folder = hit.sparkSession, uuid.uuid4().hex
        dv = hit.groupBy(F.col("_file").alias("file")).agg(F.sort_array(F.collect_list("_row")).alias("positions"))
        dv.coalesce(1).write.option("compression", "zstd").parquet(f"{self.path}/vectors/{folder}")
        dead = {r["file"]: r["n"] for r in spark.read.parquet(f"{self.path}/vectors/{folder}").select("file", F.size("positions").alias("n")).collect()}
        return {folder: dead} if dead else {}

    def stage(self, batch: DataFrame, merge_fn: MergeFn | None = None, batch_key: str | None = None) -> Change:
        """Write a merge's files without publishing them. By default each row of the batch (one a key) replaces its key's row."""
        spark = batch.sparkSession
        checkpoint_dir(spark)
        batch = batch.checkpoint(eager=True)  # the source is read once
        s = self.state(spark)
        keys = batch.select(F.col(batch_key or self.key).alias(self.key)).where(F.col(self.key).isNotNull()).distinct()
        touched = sorted(r[0] for r in keys.select(self._bucket()).distinct().collect())  # at most ``buckets`` numbers
        files = [f for f, x in s.files.items() if any(x["lo"] <= b <= x["hi"] for b in touched)]
        old = self._live(spark, s, files).where(F.col("_bucket").isin(touched))
        hit = old.join(keys, self.key, "left_semi").select(*self.schema.names, "_file", "_row").checkpoint(eager=True)
        new = batch if merge_fn is None else merge_fn(hit.select(*self.schema.names), batch)
        new = new.select(*self.schema.names).checkpoint(eager=True)
        return Change(s, self._write(new, new.count()), self._write_vectors(hit.select("_file", "_row")) if files else {}, [], keys, "merge")

    def _conflict(self, spark: SparkSession, change: Change, others: list[dict]) -> bool:
        mine = {f for dead in change.vectors.values() for f in dead} | set(change.remove)
        for c in others:
            theirs = {f for dead in c["vectors"].values() for f in dead}
            if mine & set(c["remove"]) or set(change.remove) & theirs:
                return True  # a file that is gone, or that has dead rows a rewrite didn't see
            if change.keys is None or c["kind"] == "compact":
                continue
            if c["add"]:
                added = spark.read.schema(self.stored).parquet(*[f"{self.path}/data/{f}" for f in sorted(c["add"])])
                if not change.keys.join(added.select(self.key), self.key, "left_semi").isEmpty():
                    return True
            if mine & theirs:
                both = self._vector_rows(spark, list(change.vectors)).join(self._vector_rows(spark, list(c["vectors"])), ["_file", "_row"], "left_semi")
                if not both.isEmpty():
                    return True
        return False

    def publish(self, spark: SparkSession, change: Change) -> int:
        """Publish a staged change as the next commit and return its number; raises ``Conflict``."""
        seen = change.read.seq
        while True:
            others = self.commits(spark, seen)
            if self._conflict(spark, change, others):
                raise Conflict(f"a commit after {seen} touches the same rows")
            seen = others[-1]["seq"] if others else seen
            if self._put_if_absent(spark, "log", f"{seen + 1:020d}.json", change.entry(seen + 1)):
                break
        seq = seen + 1
        if seq % CHECKPOINT == 0:
            s = self.state(spark, seq)
            self._put_if_absent(spark, "checkpoints", f"{seq:020d}.json", {"seq": s.seq, "files": s.files, "vectors": s.vectors})
        return seq

    def merge(self, batch: DataFrame, merge_fn: MergeFn | None = None, batch_key: str | None = None, attempts: int = 10) -> int:
        """Merge a batch and return the commit's number. A merge that conflicts is built anew from the newest state."""
        for left in range(attempts - 1, -1, -1):
            try:
                return self.publish(batch.sparkSession, self.stage(batch, merge_fn, batch_key))
            except Conflict:
                if not left:
                    raise
        raise AssertionError

    def write_all(self, df: DataFrame) -> int:
        """Replace the table's content (initial load)."""
        spark = df.sparkSession
        checkpoint_dir(spark)
        df = df.select(*self.schema.names).checkpoint(eager=True)
        s = self.state(spark)
        return self.publish(spark, Change(s, self._write(df, df.count()), {}, sorted(s.files), df.select(self.key).distinct(), "replace" if s.files else "merge"))

    # --- upkeep ---

    def compact(self, spark: SparkSession, max_dead: float = 0.2, max_files: int = 8) -> int | None:
        """Rewrite files with more than ``max_dead`` dead rows, and all small ones if there are more than ``max_files``."""
        s = self.state(spark)
        dead = s.dead()
        worn = {f for f, x in s.files.items() if dead.get(f, 0) > max_dead * x["rows"]}
        small = {f for f, x in s.files.items() if x["rows"] < self.rows_per_file // 2}
        chosen = sorted(worn | (small if len(small) > max_files else set()))
        if not chosen:
            return None
        rows = sum(s.files[f]["rows"] - dead.get(f, 0) for f in chosen)
        return self.publish(spark, Change(s, self._write(self._live(spark, s, chosen), rows), {}, chosen, None, "compact"))

    def vacuum(self, spark: SparkSession) -> int:
        """Remove data files and vectors that the newest state doesn't name (run it when no writer or older reader is at work)."""
        s, fs, n = self.state(spark), self._fs(spark), 0
        for folder in self._names(spark, "data"):
            for name in self._names(spark, f"data/{folder}"):
                if name.endswith(".parquet") and f"{folder}/{name}" not in s.files:
                    n += fs.delete(self._at(spark, "data", folder, name), False)
        for folder in self._names(spark, "vectors"):
            if folder not in s.vectors:
                n += fs.delete(self._at(spark, "vectors", folder), True)
        return n
