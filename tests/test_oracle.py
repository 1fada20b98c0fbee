"""The driver's correctness gate, at sf0.001: queries() against oracle_sql() in DuckDB."""

from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as E

from .conftest import SF001

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
NAMES = sorted(n for n in E.oracle_sql() if not n.startswith("op"))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = [tuple(str(r[i]) if isinstance(r[i], Decimal) else r[i] for i in order)
            for r in rows]
    return sorted(cols), sorted(norm, key=repr)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[name])
    want = _canon([d[0] for d in res.description], res.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
