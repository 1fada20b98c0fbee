"""The driver contract: entry(), queries(), oracle_sql()."""

import re
import sys

import __spark_entry__ as E


def test_every_oracle_has_a_query():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    text = {n for n in q if re.match(r"op\d+_|pipeline$", n)}
    assert set(q) - text <= set(o)


def test_entry_points_work_without_the_text_operators(monkeypatch):
    q, o = set(E.queries()), set(E.oracle_sql())
    monkeypatch.setitem(sys.modules, "starmart.llm", None)
    for name in [m for m in sys.modules if m.startswith("starmart.llm.") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    assert set(E.queries()) == {n for n in q if not re.match(r"op\d+_|pipeline$", n)}
    assert set(E.oracle_sql()) == {n for n in o if not re.match(r"op\d+_|pipeline$", n)}


def test_entry_runs_flagship_query(spark):
    df = E.entry(spark)
    assert df.columns == ["year_number", "month_number", "country", "product_name", "sales"]
    rows = df.collect()
    assert rows and all(r["sales"] is not None for r in rows)
