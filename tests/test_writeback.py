"""Pending selection and write-back traps: cluster fan-out, Error rows, stale re-queue, outcomes."""

import datetime as dt

from casebook import schemas
from casebook.plans import doubles
from casebook.operators import writeback

D1, D2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def _classes(spark):
    return spark.createDataFrame([
        ("1", "A", "a", "r", "res", D1, None),
        ("2", "Error", "Error", "{'error': 'x'}", "Error", D2, None),   # failed classification
        ("3", "B", "b", "r", None, D1, None),                           # no resolution: not pending
        ("4", "C", "c", "r", "res", D2, D1),                            # written before it was created: stale
        ("5", "D", "d", "r", "res", D1, D2),                            # written: done
    ], schemas.CLASSIFICATION)


def _clusters(spark):
    return spark.createDataFrame([("e1", "1", "s", "k1", "x"), ("e2", "1", "s", "k2", "x")], schemas.CLUSTER)


def test_fanout_kept_and_dedup_option(spark):
    p = writeback.pending_updates(_classes(spark), _clusters(spark), limit=None)
    ids = sorted(r.conversation_id for r in p.collect())
    assert ids == ["1", "1", "2"]  # ticket 1 once per cluster row; Error rows are written back too
    d = writeback.pending_updates(_classes(spark), _clusters(spark), limit=None, dedup=True)
    assert sorted(r.conversation_id for r in d.collect()) == ["1", "2"]


def test_documented_rule_requeues_stale(spark):
    p = writeback.pending_updates(_classes(spark), _clusters(spark), limit=None, include_stale=True, dedup=True)
    assert sorted(r.conversation_id for r in p.collect()) == ["1", "2", "4"]


def test_limit_takes_newest_first(spark):
    p = writeback.pending_updates(_classes(spark), _clusters(spark), limit=1)
    assert [r.conversation_id for r in p.collect()] == ["2"]


def test_write_back_outcomes(spark):
    df = spark.createDataFrame([("17", "{}"), ("18", "{}"), ("19", None)], "id string, payload string")
    out = {r.id: (r.ok, r.error) for r in writeback.write_back(df, doubles.KeyModuloFailures(17)).collect()}
    assert out == {"17": (False, "API update failed"), "18": (True, None), "19": (False, "empty payload")}
    stats = writeback.outcome_stats(writeback.write_back(df, doubles.KeyModuloFailures(17))).first()
    assert (stats.processed, stats.successful, stats.failed) == (3, 1, 2)


def test_exclude_errors_option(spark):
    p = writeback.pending_updates(_classes(spark), _clusters(spark), limit=None, dedup=True, exclude_errors=True)
    assert [r.conversation_id for r in p.collect()] == ["1"]
