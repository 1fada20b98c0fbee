"""As-of lookups and interleaved order against plain Python."""

import datetime as dt
import random

from pyspark.sql import functions as F

from starmart.functions.zorder import BITS, interleaved, scaled
from starmart.operators.asof import as_of, covered

DAY = dt.date(2020, 1, 1)
DIM = "bk long, key long, valid_from date, valid_to date"


def _day(n):
    return None if n is None else DAY + dt.timedelta(days=n)


def _sales(rng, keys, n):
    return [(i, rng.choice([None, *range(keys + 2)]), _day(rng.choice([None, *range(-5, 70)])))
            for i in range(n)]


def test_last_version_that_holds_the_day(spark):
    rng, rows, key = random.Random(1), [], 0
    for bk in range(12):
        at = rng.randrange(20)
        for _ in range(rng.randrange(1, 9)):
            end = at + rng.randrange(0, 9)
            rows.append((bk, key, _day(at), _day(end)))
            rows.append((bk, key + 1, _day(at + 1), _day(at)))  # an empty version
            key, at = key + 2, end + 1 + rng.randrange(3)
        rows.append((bk, key, _day(at), None))
        key += 1
    rng.shuffle(rows)
    sales = _sales(rng, 12, 900)
    want = {(i, k) for i, bk, d in sales for b, k, lo, hi in rows
            if d is not None and b == bk and lo <= d and (hi is None or d <= hi)}
    got = as_of(spark.createDataFrame(sales, "id long, bk long, day date"),
                spark.createDataFrame(rows, DIM), bk="bk", key="key", date_col="day")
    assert got.columns == ["id", "bk", "day", "key"]
    found = [(r["id"], r["key"]) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == want


def test_days_that_any_version_covers(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(8), k, _day(lo), rng.choice([None, *[_day(lo + x) for x in range(-2, 12)] * 2]))
            for k in range(60) for lo in [rng.randrange(60)]]
    sales = _sales(rng, 8, 700)
    got = covered(spark.createDataFrame(sales, "id long, bk long, day date"),
                  spark.createDataFrame(rows, DIM), bk="bk", date_col="day", flag="ok")
    want = {i: True if d is not None and any(
        b == bk and lo <= d and (hi is None or d <= hi) for b, _, lo, hi in rows) else None
        for i, bk, d in sales}
    assert {r["id"]: r["ok"] for r in got.collect()} == want


def test_interleaved_bits(spark):
    rows = [(a, b) for a in range(0, 100, 7) for b in range(0, 1000, 61)]
    df = spark.createDataFrame(rows, "a long, b long")
    got = df.select("a", "b", interleaved(scaled(F.col("a"), 99), scaled(F.col("b"), 999)).alias("z"))

    def plain(a, b):
        x, y = a * (1 << BITS) // 100, b * (1 << BITS) // 1000
        return sum((x >> i & 1) << (2 * i + 1) | (y >> i & 1) << (2 * i) for i in range(BITS))

    assert {(r["a"], r["b"]): r["z"] for r in got.collect()} == {(a, b): plain(a, b) for a, b in rows}
