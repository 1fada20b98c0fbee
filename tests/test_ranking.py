"""Distributed row numbers and NTILE."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from starmart.operators.ranking import assign_keys, ntile_global, row_number_global


def _ntile(spark, values, n, parts=3):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, v long")
    out = ntile_global(df.repartition(parts), n, "v", "id", "b")
    return [r["b"] for r in out.orderBy(F.col("v").desc(), "id").collect()]


def test_ten_rows_into_four(spark):
    assert _ntile(spark, list(range(10)), 4) == [1, 1, 1, 2, 2, 2, 3, 3, 4, 4]


def test_three_rows_into_five(spark):
    assert _ntile(spark, [5, 6, 7], 5) == [1, 2, 3]


def test_all_tied_follow_tie_break(spark):
    df = spark.createDataFrame([(i, 1) for i in range(7)], "id long, v long")
    out = ntile_global(df, 3, "v", "id", "b")
    got = {r["id"]: r["b"] for r in out.collect()}
    assert got == {0: 1, 1: 1, 2: 1, 3: 2, 4: 2, 5: 3, 6: 3}


def test_equals_builtin_ntile_with_heavy_ties(spark):
    rng = random.Random(3)
    rows = [(i, rng.randint(0, 9)) for i in range(1003)]
    df = spark.createDataFrame(rows, "id long, v long")
    order = [F.col("v").desc(), F.col("id").asc()]
    mine = ntile_global(df.repartition(8), 5, "v", "id", "b")
    ref = df.withColumn("b", F.ntile(5).over(Window.orderBy(*order)))
    assert mine.join(ref, ["id", "v", "b"], "left_anti").count() == 0
    assert mine.count() == 1003


def test_row_numbers_are_dense_over_partitions(spark):
    df = spark.range(0, 500).withColumn("k", (F.col("id") * 7919) % 500)
    out, n = row_number_global(df, [F.col("k")], "rn", num_partitions=6)
    assert n == 500
    got = [(r["k"], r["rn"]) for r in out.collect()]
    assert sorted(rn for _, rn in got) == list(range(1, 501))
    assert all(rn == k + 1 for k, rn in got)


def test_keys_after_max(spark):
    df = spark.createDataFrame([(30,), (10,), (20,)], "bk long")
    out, n = assign_keys(df, [F.col("bk")], "key", 7)
    assert n == 3
    assert [(r["bk"], r["key"]) for r in out.orderBy("bk").collect()] == [(10, 8), (20, 9), (30, 10)]


def test_numbering_under_aqe_merged_ranges(spark):
    """adaptive=True (no explicit count): AQE merges adjacent small ranges
    (forced here with a small advisory size); ranks stay dense and in order."""
    keys = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "40k",
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(0, 5000).withColumn("k", (F.col("id") * 7919) % 5000)
        out, n = row_number_global(df, [F.col("k")], "rn", adaptive=True)
        pids = out.rdd.getNumPartitions()
        got = [(r["k"], r["rn"]) for r in out.collect()]
        assert n == 5000 and all(rn == k + 1 for k, rn in got)
        assert 1 < pids < 4   # the 4 initial ranges, partly merged by AQE
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_several_measures_share_passes_and_equal_the_builtin(spark, monkeypatch):
    """Nulls, negative and wide values, heavy ties on values, and narrow passes."""
    from decimal import Decimal
    import datetime as dt

    from starmart.operators import ranking
    rng = random.Random(5)
    rows = [(i * 1_000_003 - 77, rng.choice([None, 0, 1, -1, rng.randint(-10**12, 10**12)]),
             rng.choice([None, dt.date(1999, 1, 1) + dt.timedelta(rng.randint(0, 5))]),
             Decimal(rng.randint(-500, 500)) / 100) for i in range(701)]
    df = spark.createDataFrame(rows, "id long, w long, d date, m decimal(20,2)").repartition(5)
    for bits, n in ((14, 5), (3, 4), (1, 2)):
        monkeypatch.setattr(ranking, "PASS_BITS", bits)
        got = ranking.tiles(df, n, {"w": "tw", "d": "td", "m": "tm"}, "id")
        assert got.columns == ["id", "w", "d", "m", "tw", "td", "tm"]
        want = df
        for c in "wdm":
            want = want.withColumn(f"t{c}", F.ntile(n).over(
                Window.orderBy(F.col(c).desc_nulls_first(), "id")))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_tiles_of_nothing_and_of_nulls(spark):
    empty = spark.createDataFrame([], "id long, v long")
    assert ntile_global(empty, 4, "v", "id", "b").collect() == []
    nulls = spark.createDataFrame([(i, None) for i in range(5)], "id long, v long")
    assert {r["id"]: r["b"] for r in ntile_global(nulls, 2, "v", "id", "b").collect()} == {
        0: 1, 1: 1, 2: 1, 3: 2, 4: 2}


def test_running_maximum_of_a_hot_group_spans_partitions(spark):
    from starmart.operators.ranking import running
    rows = spark.range(3000).selectExpr(
        "case when id % 9 < 8 then 1L when id % 2 = 0 then null else 2L end as g",
        "cast(id as int) as o", "date_add(date'2000-01-01', cast((id * 7919) % 997 as int)) as v")
    w = Window.partitionBy("g").orderBy("o").rowsBetween(Window.unboundedPreceding, -1)
    want = rows.withColumn("m", F.max("v").over(w))
    got = running(rows, "g", ["o"], F.col("v"), "m", F.max, num_partitions=6, inclusive=False)
    assert got.exceptAll(want).count() == 0 and got.count() == 3000
