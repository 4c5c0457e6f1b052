"""Write-back: pending selection, row-wise sink with per-row outcome, and
outcome statistics (F7/F8, J2, L3, K5-K8, G6-G10).

The sink itself is external I/O, so it runs in Python tasks via
``mapInPandas``: each partition sends its rows with a bounded in-task retry
and returns ``(id, ok, error)``; Spark's own task retry sits on top. Delivery
is at-least-once, so payloads must be idempotent (they are: the same field
values are set again).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from casebook.config import ERROR_LABEL

Send = Callable[[str, str], None]  # raises on failure


def pending_updates(classes: DataFrame, clusters: DataFrame, limit: int | None = None, include_stale: bool = False,
                    dedup: bool = False, exclude_errors: bool = False) -> DataFrame:
    """Classifications ready to write back, newest first, with their cluster.

    Pending = category and resolution set and never written (``updated_time``
    NULL); ``include_stale`` also re-queues rows written before they were
    created. The cluster lookup is not unique per ticket, so a ticket can
    appear once per cluster row unless ``dedup``. Failed classifications are
    stored with the label 'Error' and are pending like any other row (as in
    the original) unless ``exclude_errors``."""
    c = classes.where(F.col("category").isNotNull() & F.col("resolution").isNotNull())
    if exclude_errors:
        c = c.where((F.col("category") != ERROR_LABEL) & (F.col("resolution") != ERROR_LABEL))
    never = F.col("updated_time").isNull()
    c = c.where(never | (F.col("updated_time") < F.col("created_at"))) if include_stale else c.where(never)
    cl = clusters.select(F.col("ticket_id"), F.col("cluster_name").alias("cluster"))
    if dedup:
        cl = cl.groupBy("ticket_id").agg(F.min("cluster").alias("cluster"))
    j = c.join(cl, c.conversation_id == cl.ticket_id, "left")
    out = j.select("conversation_id", "category", "sub_category", "resolution", "cluster", "created_at")
    if limit is not None:
        out = out.orderBy(F.col("created_at").desc_nulls_last(), F.col("conversation_id").asc_nulls_first(),
                          F.col("cluster").asc_nulls_first()).limit(limit)
    return out


def sink_rows(send: Send, key: str, body: str, skip: str | None = None, attempts: int = 3):
    """``mapInPandas`` function: send every row once (bounded retry) and append
    ``ok`` / ``error``. A NULL body is not sent ('empty payload'); rows with
    ``skip`` set are not sent either and count as done ('skipped')."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            oks, errs = [], []
            skips = pdf[skip] if skip else [False] * len(pdf)
            for k, b, sk in zip(pdf[key], pdf[body], skips):
                if sk is not None and sk is not pd.NA and bool(sk):
                    oks.append(True)
                    errs.append(SKIPPED)
                    continue
                if b is None or b is pd.NA or (isinstance(b, float) and b != b):
                    oks.append(False)
                    errs.append(EMPTY)
                    continue
                err = None
                for _ in range(attempts):
                    try:
                        send(k, b)
                        err = None
                        break
                    except Exception as e:  # noqa: BLE001
                        err = str(e) or type(e).__name__
                oks.append(err is None)
                errs.append(err)
            out = pdf.copy()
            out["ok"] = oks
            out["error"] = errs
            yield out

    return run


SKIPPED = "skipped"
EMPTY = "empty payload"


def write_back(df: DataFrame, send: Send, key: str = "id", body: str = "payload", skip: str | None = None,
               partitions: int | None = None, keep: bool = False) -> DataFrame:
    """Send ``body`` of every row and return the outcome per row in one pass.

    Without ``keep`` the result is ``(id, ok, error)``; with ``keep`` every
    input column is carried through and ``ok`` / ``error`` are appended, so
    callers never join the outcome back to a recomputed input. Rows with a
    NULL body fail with 'empty payload'; rows with ``skip`` true are not sent.
    ``partitions`` caps concurrent connections to the remote system."""
    cols = df.columns if keep else [key, body] + ([skip] if skip else [])
    src = df.select(*cols)
    if partitions:
        src = src.repartition(partitions)
    schema = StructType(list(src.schema.fields) + [StructField("ok", BooleanType()),
                                                   StructField("error", StringType())])
    out = src.mapInPandas(sink_rows(send, key, body, skip), schema)
    return out if keep else out.select(F.col(key).cast("string").alias("id"), "ok", "error")


def outcome_stats(outcomes: DataFrame, batch_col: str | None = None) -> DataFrame:
    """processed / successful / failed per batch plus a total row (batch NULL)
    and the number of batches."""
    aggs = [F.count(F.lit(1)).alias("processed"), F.count_if(F.col("ok")).alias("successful"),
            F.count_if(~F.col("ok")).alias("failed")]
    if batch_col is None:
        return outcomes.agg(*aggs)
    # One row per batch first; the rollup then expands only those.
    per = outcomes.groupBy(batch_col).agg(*aggs)
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("processed", "successful", "failed")]
    return per.rollup(batch_col).agg(*sums, F.count(batch_col).alias("batches"))


def success_rate(outcomes: DataFrame) -> DataFrame:
    """Successful share in percent, 0 when nothing was processed."""
    s = outcome_stats(outcomes)
    return s.select("processed", "successful",
                    F.coalesce(F.try_divide(F.col("successful") * F.lit(100.0), F.col("processed")),
                               F.lit(0.0)).alias("success_rate"))


def first_errors(outcomes: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` failures by id (the error list shown in a run summary)."""
    return outcomes.where(~F.col("ok")).orderBy("id").limit(n).select("id", "error")
