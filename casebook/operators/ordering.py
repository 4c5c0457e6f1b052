"""Row numbers in a total order without a global window.

``numbered`` range-partitions the rows by the order, sorts each partition, and writes the result once, so that the
ranges are fixed. A row's number is the count of rows in the partitions before its own (one number for each
partition, the only thing the driver sees) plus its place in its partition. No task sees more than one range.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.session import scratch_path

PLACE = 33  # bits of monotonically_increasing_id below the partition number


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, however often it is used."""
    path = scratch_path(df.sparkSession, f"casebook-runs/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranged(df: DataFrame, order: list[Column], name: str, partitions: int | None = None) -> DataFrame:
    """``df`` in range partitions by ``order``, written, with ``_at``: partition number and place in it."""
    parts = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    return written(parts.sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), name)


def numbered(df: DataFrame, order: list[Column], partitions: int | None = None) -> DataFrame:
    """``df`` with ``row_no``, 0-based and gapless in ``order``.

    Rows that ``order`` leaves equal share a partition and are numbered in no particular order: end it with a unique
    column.
    """
    rows = ranged(df, order, "numbered", partitions)
    sizes = rows.groupBy(F.shiftright("_at", PLACE).alias("part")).count().collect()  # one row for each partition
    before, starts = 0, []
    for part, n in sorted((r["part"], r["count"]) for r in sizes):
        starts.append((part, before))
        before += n
    starts = rows.sparkSession.createDataFrame(starts, "_part long, _before long")
    placed = rows.withColumn("_part", F.shiftright("_at", PLACE)).join(F.broadcast(starts), "_part")  # as many rows as partitions
    row_no = F.col("_before") + F.col("_at").bitwiseAND((1 << PLACE) - 1)
    return placed.select(*df.columns, row_no.alias("row_no"))
