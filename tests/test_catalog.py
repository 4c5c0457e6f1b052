"""Every catalogue query against its DuckDB oracle on the smallest tables."""

import os

import pytest

import __spark_entry__ as E
from casebook.plans.catalog import ORACLES, QUERIES
from tools.check_oracles import canon, duck

SF = os.environ.get("CASEBOOK_TEST_SF", "/root/testdata/sf0.001")
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "allMessages" in df.columns


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    r = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in r.description]
    assert sorted(df.columns) == sorted(ocols)
    assert canon(df.columns, rows) == canon(ocols, r.fetchall())
