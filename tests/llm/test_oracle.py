"""The queries with SQL against DuckDB on the smallest tables."""

import duckdb
import pytest

from starmart.llm.oracle import ORACLES
from starmart.llm.queries import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    got = queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want.fetchall())
