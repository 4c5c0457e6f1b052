"""Seek paging over a range-clustered table (L1, L2).

``write_pages`` numbers the rows once in the order of the listing and stores them in slices of whole pages, with a page
index: the first row's order key of each page. A page is then read from the one slice that holds it (a partition
filter, and row-group statistics inside the slice), whatever its number; an OFFSET sorts the whole table for each page.

A slice is one file in a folder of its own. There are at most ``most_slices`` of them: the slices of a longer listing hold
more pages each, so folders and files don't grow in number with the table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.operators.ordering import numbered


@dataclass(frozen=True)
class Pages:
    """A paged listing: where it lies, and its sizes in rows."""

    path: str
    page_size: int
    slice_rows: int

    def _rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/rows")

    def page(self, spark: SparkSession, number: int) -> DataFrame:
        """Page ``number`` (from 0) in order; an empty frame beyond the last."""
        first = number * self.page_size
        hit = (F.col("_slice") == first // self.slice_rows) & F.col("row_no").between(first, first + self.page_size - 1)
        return self._rows(spark).where(hit).orderBy("row_no").drop("_slice", "row_no")

    def index(self, spark: SparkSession) -> DataFrame:
        """(page, rows, first): each page with the row that opens it."""
        return spark.read.parquet(f"{self.path}/index")

    def page_of(self, spark: SparkSession, precedes: Column) -> int:
        """The page on which a key stands or would stand: the last whose first row satisfies ``precedes`` (a condition on
        the columns of ``first``: the row is not after the key). The index is read, the rows are not."""
        return self.index(spark).where(precedes).agg(F.coalesce(F.max("page"), F.lit(0))).first()[0]


def write_pages(df: DataFrame, order: list[Column], page_size: int, path: str, slice_rows: int = 1_000_000, most_slices: int = 500) -> Pages:
    """Store ``df`` as pages of ``page_size`` rows in ``order`` (a total order) under ``path``, in slices of ``slice_rows``
    rows, or of more where that would be over ``most_slices`` slices."""
    placed = numbered(df, order)
    n = placed.count()
    in_slice = max(1, slice_rows // page_size, -(-n // (page_size * most_slices)))
    pages = Pages(path.rstrip("/"), page_size, in_slice * page_size)
    rows = placed.withColumn("_slice", F.floor(F.col("row_no") / pages.slice_rows).cast("long"))
    # A slice is one task's file; slices spread over as many tasks as there are.
    rows.repartition("_slice").sortWithinPartitions("_slice", "row_no").write.partitionBy("_slice").parquet(f"{pages.path}/rows")
    stored = pages._rows(df.sparkSession)
    page = F.floor(F.col("row_no") / page_size).cast("long")
    opens = stored.where(F.col("row_no") % page_size == 0).select(
        page.alias("page"), F.least(F.lit(page_size), F.lit(n) - F.col("row_no")).cast("long").alias("rows"), F.struct(*df.columns).alias("first"))
    opens.write.parquet(f"{pages.path}/index")
    return pages
