"""Merge operators: latest-wins, null-preserving upsert, marking, evolution."""

import datetime as dt

from pyspark.sql import functions as F

from casebook import schemas
from casebook.operators import merge

RUN = dt.datetime(2025, 1, 1)


def as_set(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_latest_replaces_and_is_idempotent(spark):
    cur = spark.createDataFrame([("1", "alice", 1), ("2", "bob", 1)], "id string, name string, v int")
    upd = spark.createDataFrame([("1", "alicia", 2), ("3", "carl", 2), ("1", "ali", 3)], "id string, name string, v int")
    once = merge.upsert_latest(cur, upd, "id", "v")
    assert as_set(once) == [("1", "ali", 3), ("2", "bob", 1), ("3", "carl", 2)]
    assert as_set(merge.upsert_latest(once, upd, "id", "v")) == as_set(once)


def test_upsert_coalesce_keeps_old_on_null_and_folds_updates(spark):
    cur = spark.createDataFrame([("1", "A", "a", "r", "res", RUN, None)], schemas.CLASSIFICATION)
    upd = spark.createDataFrame([("1", None, "b", None, None, 1), ("1", "B", None, None, None, 2),
                                 ("1", None, None, None, None, 3), ("9", "N", None, None, None, 1)],
                                "conversation_id string, category string, sub_category string, reasoning string, "
                                "resolution string, arrival int")
    cols = ["category", "sub_category", "reasoning", "resolution"]
    out = {r.conversation_id: r for r in merge.upsert_coalesce(cur, upd, "conversation_id", cols, "arrival",
                                                                dt.datetime(2030, 1, 1)).collect()}
    assert (out["1"].category, out["1"].sub_category, out["1"].reasoning, out["1"].resolution) == ("B", "b", "r", "res")
    assert out["1"].created_at == RUN
    assert out["9"].category == "N" and out["9"].created_at == dt.datetime(2030, 1, 1) and out["9"].updated_time is None


def test_mark_updated_only_successes(spark):
    cur = spark.createDataFrame([("1", None), ("2", None), ("3", RUN)], "conversation_id string, updated_time timestamp")
    outc = spark.createDataFrame([("1", True, None), ("2", False, "x"), ("1", True, None)], schemas.OUTCOME)
    out = dict(tuple(r) for r in merge.mark_updated(cur, outc, "conversation_id", dt.datetime(2026, 1, 1)).collect())
    assert out == {"1": dt.datetime(2026, 1, 1), "2": None, "3": RUN}


def test_evolve_adds_typed_null_column(spark):
    df = spark.createDataFrame([("1", "c")], "conversation_id string, category string")
    out = merge.evolve(df, schemas.CLASSIFICATION)
    assert out.columns[:7] == [f.name for f in schemas.CLASSIFICATION.fields]
    assert dict(out.dtypes)["updated_time"] == "timestamp"
    assert out.select(F.col("updated_time").isNull()).first()[0]


def test_requeue_on_change_resets_mark(spark):
    done = dt.datetime(2024, 6, 1)
    cur = spark.createDataFrame([("1", "A", "a", "r", "res", RUN, done), ("2", "B", "b", "r", "res", RUN, done)],
                                schemas.CLASSIFICATION)
    upd = spark.createDataFrame([("1", "A2", None, None, None, 1), ("2", "B", None, None, None, 1)],
                                "conversation_id string, category string, sub_category string, reasoning string, "
                                "resolution string, arrival int")
    cols = ["category", "sub_category", "reasoning", "resolution"]
    keep = {r.conversation_id: r.updated_time for r in
            merge.upsert_coalesce(cur, upd, "conversation_id", cols, "arrival", RUN).collect()}
    assert keep == {"1": done, "2": done}
    req = {r.conversation_id: r.updated_time for r in
           merge.upsert_coalesce(cur, upd, "conversation_id", cols, "arrival", RUN, requeue_on_change=True).collect()}
    assert req == {"1": None, "2": done}
