"""A keyed snapshot table on plain parquet, merged one batch at a time.

Rows are spread over ``buckets`` hash buckets (``pmod(xxhash64(key), n)``). Each
merge writes the buckets that its batch touches as a new version folder
(``data/version=<v>/bucket=<b>``) and then one manifest file that names, for
every bucket, the version that holds it. Readers follow the newest manifest
file; a data file that may be read is never replaced. A crash before the manifest is
written leaves the table as it was, and its half-written version unused.

A merge reads only the touched buckets: their numbers (at most ``buckets``
integers) become a filter on the partition column. The batch is checkpointed
first, so a source that answers differently on each read is read once.
A bucket is written by up to ``files_per_bucket`` tasks, each with its share of the keys.

``put`` (last write wins) rewrites nothing: the batch's rows become one more version of the buckets they touch, and the
manifest names all versions of a bucket. Of a key's rows, readers take those of its newest version; a bucket with one
version is read as it is. The bytes written follow the batch and not the table. The next ``merge`` of a bucket, or
``compact``, leaves it with one version again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from casebook.operators.merge import latest_by_arrival
from casebook.session import checkpoint_dir

MergeFn = Callable[[DataFrame, DataFrame], DataFrame]  # (current rows of touched buckets, batch) -> new rows

MANIFEST = "seq long, buckets int, bucket int, version long"


class BucketedSnapshot:
    def __init__(self, path: str, key: str, schema: StructType, buckets: int = 64, files_per_bucket: int = 4):
        self.path, self.key, self.schema, self.buckets = path.rstrip("/"), key, schema, buckets
        self.files_per_bucket = files_per_bucket
        self.stored = StructType(list(schema.fields) + [StructField("version", LongType()),
                                                        StructField("bucket", IntegerType())])

    def bucket_of(self, col: str | None = None):
        return F.pmod(F.xxhash64(F.col(col or self.key)), F.lit(self.buckets)).cast("int")

    def _columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    def _manifest(self, spark: SparkSession) -> tuple[int, dict[int, list[int]]]:
        """(sequence number, versions of each bucket); (0, {}) before the first write.

        Only a missing path counts as 'not written yet'; any other error is raised. The bucket
        count stored with the table wins over the one asked for."""
        try:
            m = spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0, {}
        last = m.agg(F.max("seq")).first()[0]
        if last is None:
            return 0, {}
        rows = m.where(F.col("seq") == last).collect()  # one row per bucket and version
        self.buckets = rows[0]["buckets"]
        versions: dict[int, list[int]] = {}
        for r in sorted((r for r in rows if r["bucket"] is not None), key=lambda r: r["version"]):
            versions.setdefault(r["bucket"], []).append(r["version"])
        return last, versions

    def _rows(self, spark: SparkSession, versions: dict[int, list[int]]) -> DataFrame:
        """Rows of the buckets ``versions``; of a key with rows in several versions, those of the newest."""
        if not versions:
            return spark.createDataFrame([], self.stored)
        layered = {b: vs for b, vs in versions.items() if len(vs) > 1}
        if not layered:
            return self._layers(spark, versions)
        rows = self._layers(spark, layered)
        newest = rows.groupBy(F.col(self.key).alias("_key")).agg(F.max("version").alias("_newest"))
        # A NULL key replaces no row.
        rows = rows.join(newest, F.col(self.key) == F.col("_key"), "left").where("_newest IS NULL OR version = _newest").drop("_key", "_newest")
        single = {b: vs for b, vs in versions.items() if len(vs) == 1}
        return rows.unionByName(self._layers(spark, single)) if single else rows

    def _layers(self, spark: SparkSession, versions: dict[int, list[int]]) -> DataFrame:
        """All rows of all ``versions``."""
        folders = sorted({f"{self.path}/data/version={v}" for vs in versions.values() for v in vs})
        df = spark.read.schema(self.stored).option("basePath", f"{self.path}/data").parquet(*folders)
        by_version: dict[int, list[int]] = {}
        for b, vs in versions.items():
            for v in vs:
                by_version.setdefault(v, []).append(b)
        live = F.lit(False)
        for v, bs in sorted(by_version.items()):
            live = live | ((F.col("version") == v) & F.col("bucket").isin(bs))
        return df.where(F.col("bucket").isin(list(versions)) & live)

    def read(self, spark: SparkSession, with_bucket: bool = False) -> DataFrame:
        """Current rows (an empty frame before the first write)."""
        df = self._rows(spark, self._manifest(spark)[1]).drop("version")
        return df if with_bucket else df.drop("bucket")

    def _part(self):
        return F.pmod(F.xxhash64(F.col(self.key), F.lit(1)), F.lit(self.files_per_bucket))

    def _commit(self, df: DataFrame, seq: int, versions: dict[int, list[int]], touched: list[int]) -> None:
        version = seq + 1
        (df.select(*self._columns()).withColumn("bucket", self.bucket_of())
         .repartition(F.col("bucket"), self._part())
         .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/data/version={version}"))
        self._publish(df.sparkSession, version, {**versions, **{b: [version] for b in touched}})

    def _publish(self, spark: SparkSession, seq: int, versions: dict[int, list[int]]) -> None:
        rows = [(seq, self.buckets, b, v) for b, vs in sorted(versions.items()) for v in vs] or [(seq, self.buckets, None, None)]
        spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")

    def write_all(self, df: DataFrame) -> None:
        """Initial load: every bucket written once, as one new version."""
        seq, _ = self._manifest(df.sparkSession)
        self._commit(df, seq, {}, list(range(self.buckets)))

    def merge(self, batch: DataFrame, merge_fn: MergeFn, batch_key: str | None = None) -> None:
        spark = batch.sparkSession
        checkpoint_dir(spark)
        batch = batch.checkpoint(eager=True)
        seq, versions = self._manifest(spark)
        touched = sorted(r[0] for r in batch.select(self.bucket_of(batch_key)).distinct().collect())  # at most `buckets`
        if not touched:
            return
        current = self._rows(spark, {b: versions[b] for b in touched if b in versions}).drop("version", "bucket")
        self._commit(merge_fn(current, batch), seq, versions, touched)

    def put(self, batch: DataFrame, arrival: list[str]) -> None:
        """Last write wins: every key of the batch replaces its stored row, whatever either holds. Of a key's rows in the
        batch the last by ``arrival`` counts. The batch is read and shuffled once; no stored row is read."""
        spark = batch.sparkSession
        seq, versions = self._manifest(spark)
        version = seq + 1
        spread = batch.select(*self._columns(), self.bucket_of().alias("bucket"), self._part().alias("_part")).repartition("bucket", "_part")
        # Grouped within the partitions made by the bucket, so without another exchange.
        rows = latest_by_arrival(spread, ["bucket", "_part", self.key], arrival).drop("_part")
        rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/data/version={version}")
        written = spark.read.schema(self.stored).option("basePath", f"{self.path}/data").parquet(f"{self.path}/data/version={version}")
        touched = [r[0] for r in written.select("bucket").distinct().collect()]  # at most `buckets`
        if touched:
            self._publish(spark, version, {**versions, **{b: [*versions.get(b, []), version] for b in touched}})

    def compact(self, spark: SparkSession) -> None:
        """Leave every bucket with one version."""
        seq, versions = self._manifest(spark)
        layered = {b: vs for b, vs in versions.items() if len(vs) > 1}
        if layered:
            self._commit(self._rows(spark, layered).drop("version", "bucket"), seq, versions, sorted(layered))

    def vacuum(self, spark: SparkSession) -> int:
        """Delete version folders that the newest manifest no longer names; returns their number.
        Run it when no reader holds an older state."""
        seq, versions = self._manifest(spark)
        used = {v for vs in versions.values() for v in vs}
        fs_path = spark._jvm.org.apache.hadoop.fs.Path
        fs = fs_path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        gone = [v for v in range(1, seq + 1) if v not in used and fs.exists(fs_path(f"{self.path}/data/version={v}"))]
        for v in gone:
            fs.delete(fs_path(f"{self.path}/data/version={v}"), True)
        return len(gone)
