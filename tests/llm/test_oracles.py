"""The registered queries against their SQL."""

import pytest

from casebook.llm.queries import ORACLES, QUERIES
from tools.check_oracles import canon

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    r = con.execute(ORACLES[name])
    assert got == canon([d[0] for d in r.description], r.fetchall())
