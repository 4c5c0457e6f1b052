"""Group counts and global progress counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    """Rows per key combination (NULL keys form their own group). Partial
    counts are combined map-side, so a hot key costs one row per map task."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def count_changes(changes: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    """Signed rows per key combination of a change feed: a row after counts one, a row before minus one."""
    sign = F.when(F.col("_change") == "after", 1).otherwise(-1).cast("long")
    return changes.groupBy(*keys).agg(F.sum(sign).alias(name)).where(F.col(name) != 0)


def add_counts(counts: DataFrame, delta: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    """A count report brought up to date by signed counts; groups that are empty now go. The table isn't read."""
    both = counts.unionByName(delta)
    return both.groupBy(*keys).agg(F.sum(name).alias(name)).where(F.col(name) != 0)


def ordered_report(counts: DataFrame, lead: list[str], name: str = "n", tie: list[str] | None = None) -> DataFrame:
    """Report order: the ``lead`` group keys ascending, then the count
    descending, then ``tie`` keys for a total order (the output of a group
    count is small, so this sort is cheap)."""
    order = [F.col(k).asc_nulls_first() for k in lead] + [F.col(name).desc()]
    order += [F.col(k).asc_nulls_first() for k in (tie or [])]
    return counts.orderBy(*order)


def progress_counts(df: DataFrame, col: str) -> DataFrame:
    """Total rows, rows with ``col`` set, and the difference (one global row)."""
    return df.agg(F.count(F.lit(1)).alias("total"), F.count(col).alias("with_value")).select(
        "total", "with_value", (F.col("total") - F.col("with_value")).alias("without_value"))
