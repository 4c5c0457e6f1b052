"""Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/casebook-llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_column(name: str = "text") -> Column:
    """The text as read; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def fold(mod: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``mod`` (null id: fold of the empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % mod
