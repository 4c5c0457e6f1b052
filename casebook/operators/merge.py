"""Set-based merges: latest-wins upsert (K1/W1), null-preserving upsert
(K2/W3), marking processed rows (K3) and additive schema evolution (K4).

All merges are one aggregation keyed by the primary key. ``max_by`` and
``max`` are combined map-side before the shuffle: a key that holds a third of
all updates costs one partial row per map task. A struct maximum runs as a
sort-based aggregate, so each map task sorts its rows by key (and spills if
it must); that is its price. No window over the key is used.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def ts_literal(ts: _dt.datetime) -> Column:
    """A timestamp literal read as wall-clock time in the session time zone
    (``F.lit(datetime)`` would go through the Python process's zone)."""
    return F.lit(ts.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def latest_per_key(df: DataFrame, key: str | list[str], order: str) -> DataFrame:
    """One row per key: the row with the greatest ``order`` (ties: greatest row)."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys and c != order]
    # One struct led by the order column: its max is the newest row (ties go to
    # the greatest remaining values), and the row travels once per partial.
    packed = F.max(F.struct(F.col(order).alias("_o"), *[F.col(c) for c in rest]))
    out = df.groupBy(*keys).agg(packed.alias("_r"))
    return out.select(*keys, *[F.col("_r._o").alias(order) if c == order else F.col(f"_r.{c}")
                               for c in df.columns if c not in keys])


def upsert_latest(current: DataFrame, updates: DataFrame, key: str | list[str], order: str) -> DataFrame:
    """Insert-or-replace: union the snapshot and the updates, keep the newest
    row per key. ``order`` is the arrival column; snapshot rows must carry a
    value lower than any update (e.g. their own arrival)."""
    both = current.unionByName(updates, allowMissingColumns=True)
    return latest_per_key(both, key, order)


def latest_by_arrival(updates: DataFrame, key: str | list[str], arrival: list[str]) -> DataFrame:
    """One row per key: the row that arrived last. ``arrival`` columns decide in order (say, run number,
    then the record's own time); NULL comes before every value, and the greatest row breaks ties."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in updates.columns if c not in keys and c not in arrival]
    newest = updates.groupBy(*keys).agg(F.max(F.struct(*arrival, *rest)).alias("_r"))
    return newest.select(*[F.col(c) if c in keys else F.col(f"_r.{c}") for c in updates.columns])


def replace_rows(current: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Last write wins: a key in ``updates`` (one row per key) replaces its old row, whatever the old row holds."""
    return current.join(updates.select(key), key, "left_anti").select(*current.columns) \
        .unionByName(updates, allowMissingColumns=True)


def fold_updates(updates: DataFrame, key: str, cols: list[str], order: str) -> DataFrame:
    """Several partial updates of one key -> one row: per column, the newest
    non-NULL value (NULL when every update left the column NULL)."""
    aggs = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in cols]
    return updates.groupBy(key).agg(*aggs)


def upsert_coalesce(current: DataFrame, updates: DataFrame, key: str, cols: list[str], order: str,
                    run_ts: _dt.datetime, created_col: str = "created_at",
                    updated_col: str = "updated_time", requeue_on_change: bool = False) -> DataFrame:
    """Null-preserving upsert: a non-NULL new value overwrites, NULL keeps the
    old one; ``created_col``/``updated_col`` keep their old values on
    conflict. New keys are inserted with ``created_col = run_ts``.

    With ``requeue_on_change`` a row whose merged values differ from the old
    ones gets ``updated_col`` reset to NULL, so it is written back again (by
    default, as in the original, a re-classified row keeps its old mark and is
    never re-sent)."""
    new = fold_updates(updates, key, cols, order).alias("n")
    old = current.alias("o")
    j = old.join(new, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    out = [F.coalesce(F.col(f"o.{key}"), F.col(f"n.{key}")).alias(key)]
    out += [F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c) for c in cols]
    is_new = F.col(f"o.{key}").isNull()
    out.append(F.when(is_new, ts_literal(run_ts)).otherwise(F.col(f"o.{created_col}")).alias(created_col))
    kept = F.col(f"o.{updated_col}")
    if requeue_on_change:
        changed = None
        for c in cols:
            diff = ~F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).eqNullSafe(F.col(f"o.{c}"))
            changed = diff if changed is None else changed | diff
        kept = F.when(changed, F.lit(None)).otherwise(kept)
    out.append(F.when(is_new, F.lit(None)).otherwise(kept).alias(updated_col))
    return j.select(*out)


def mark_updated(current: DataFrame, outcomes: DataFrame, key: str, run_ts: _dt.datetime,
                 updated_col: str = "updated_time", outcome_key: str = "id") -> DataFrame:
    """Set ``updated_col = run_ts`` on rows whose write-back succeeded at least once."""
    done = outcomes.where(F.col("ok")).select(F.col(outcome_key).alias("_k")).distinct()
    j = current.join(done, current[key] == done["_k"], "left")
    return j.select(*[F.when(F.col("_k").isNotNull(), ts_literal(run_ts)).otherwise(F.col(c)).alias(c)
                      if c == updated_col else F.col(c) for c in current.columns])


def evolve(df: DataFrame, schema: StructType) -> DataFrame:
    """Add every column of ``schema`` missing from ``df`` as a typed NULL and
    order columns as in ``schema`` (extra columns are kept at the end)."""
    have = set(df.columns)
    cols: list[Column] = [F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
                          for f in schema.fields]
    extra = [F.col(c) for c in df.columns if c not in {f.name for f in schema.fields}]
    return df.select(*cols, *extra)


def has_column(df: DataFrame, name: str) -> bool:
    return name in df.columns
