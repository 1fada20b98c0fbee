"""Plan shapes that matter at scale, checked on the executed physical plans."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from starmart.loads import Staged
from starmart.operators.facts import dedupe_batch, pit_lookup, resolve_sales
from starmart.operators.layout import daily_product_totals, transaction_lines
from starmart.operators.ranking import placed
from starmart.plans import analytics as A

from .conftest import SF001


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()   # run once so AQE settles
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def wh(spark):
    return E._warehouse(spark, SF001)


def test_global_ranks_never_use_a_single_partition(wh):
    """The frame that is checkpointed before it is ranked, not the one read back."""
    fact = wh["fact_sales"]
    per = fact.groupBy("customer_key").agg(F.count(F.lit(1)).alias("n"))
    plan = _plan(placed(per, [F.col("n").desc(), F.col("customer_key").asc()]))
    assert "rangepartitioning(n" in plan and "SinglePartition" not in plan


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, old)


def test_fact_resolution_at_scale_sort_merges_and_drops_empty_versions(spark, wh, no_broadcast):
    t = wh.tables()
    sales = Staged.from_driver(spark, SF001).sales
    plan = resolve_sales(sales, t["dim_date"], t["dim_store"], t["dim_customer"],
                         t["dim_product"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") >= 4 and "Broadcast" not in plan
    # Below the joins: on the scans of the two versioned dimensions.
    assert plan.count("(valid_from") + plan.count("<= coalesce(valid_to") >= 2


def test_versions_of_a_hot_key_do_not_meet_its_sales(spark):
    empty = spark.range(5000).selectExpr(
        "1L as bk", "id as key", "date'2020-01-01' as valid_from", "date'2019-12-31' as valid_to")
    live = spark.sql("select 1L as bk, 9999L as key, date'1900-01-01' as valid_from, "
                     "cast(null as date) as valid_to")
    sales = spark.range(20000).selectExpr("1L as bk", "date'2021-01-01' as transaction_date")
    out = pit_lookup(sales, empty.union(live), bk="bk", key="key")
    assert out.count() == 20000 and out.select("key").distinct().collect()[0][0] == 9999


def test_top5_per_group_uses_window_group_limit(wh):
    assert "WindowGroupLimit" in _plan(A.q12_top5_products(wh))


def test_top50_is_a_top_k_not_a_full_sort(wh):
    plan = _plan(A.q03_store_ranking(wh))
    assert "TakeOrderedAndProject" in plan


def test_shares_use_a_scalar_subquery_not_a_cross_join(wh):
    for q in (A.q04_category_mix, A.q10_brand_share, A.q11_country_share):
        plan = _plan(q(wh))
        assert "Subquery" in plan
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_duplicate_groups_are_reduced_before_the_shuffle(spark):
    batch = spark.range(0, 1000).select(
        F.lit(1).cast("long").alias("transaction_id"), F.lit(7).cast("long").alias("product_key"),
        *[F.lit(0).alias(c) for c in ("date_key", "customer_key", "store_key", "quantity")],
        *[F.lit(1).cast("decimal(10,2)").alias(c)
          for c in ("unit_price", "total_amount", "discount_amount")],
        F.lit(3).cast("long").alias("product_business_key"),
        F.current_date().alias("transaction_date"))
    out = dedupe_batch(batch, ["transaction_id", "product_key"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min") > plan.index("Exchange")  # printed root-first
    assert out.count() == 1


def test_scans_read_only_needed_columns(wh):
    plan = _plan(A.q09_quantity_buckets(wh))
    scan = [line for line in plan.splitlines() if "ReadSchema" in line or "FileScan" in line]
    assert scan and all("customer_key" not in s for s in scan)


def test_access_paths_push_their_filters(spark, wh):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = _plan(daily_product_totals(wh["fact_sales"], "1998-03-01", "1998-03-31", [3, 7, 11]))
    assert "In(product_key" in plan and "GreaterThanOrEqual(date_key" in plan
    assert "PartitionFilters" in plan and "year_month" in plan
    plan = _plan(transaction_lines(wh["fact_sales"], wh["fact_keys"], 100, 200))
    assert plan.count("GreaterThanOrEqual(transaction_id,100)") >= 2
    scan = next(x for x in plan.splitlines() if "FileScan" in x and "total_amount" in x)
    assert "dynamicpruning" in scan.split("PartitionFilters: [")[1].split("PushedFilters")[0]


def test_running_totals_span_partitions(spark):
    from pyspark.sql import Window

    from starmart.operators.ranking import running_total
    rows = spark.range(3000).selectExpr("case when id % 7 < 6 then 'hot' else 'cold' end as g",
                                        "cast(id as int) as o", "id % 5 as v")
    got = running_total(rows, "g", "o", "v", "total", num_partitions=6)
    w = Window.partitionBy("g").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    want = rows.withColumn("total", F.sum("v").over(w))
    assert got.exceptAll(want).count() == 0 and got.count() == 3000


def test_versions_are_searched_not_paired(spark, no_broadcast):
    """A key with ten years of daily versions and a third of the sales: no pair join."""
    from starmart.operators.facts import pit_lookup
    daily = spark.range(3650).selectExpr(
        "1L as bk", "id as key", "date_add(date'2010-01-01', cast(id as int)) as valid_from",
        "date_add(date'2010-01-01', cast(id as int)) as valid_to")
    others = spark.range(2, 2000).selectExpr("id as bk", "id + 10000 as key",
                                             "date'1900-01-01' as valid_from",
                                             "cast(null as date) as valid_to")
    sales = spark.range(300_000).selectExpr(
        "id as tid", "case when id % 3 = 0 then 1L else id % 1999 + 1 end as bk",
        "date_add(date'2010-01-01', cast(id % 4000 as int)) as transaction_date")
    out = pit_lookup(sales, daily.unionByName(others), bk="bk", key="key")
    plan = _plan(out)
    join = [x for x in plan.splitlines() if "SortMergeJoin" in x]
    # Equal keys only: nothing follows the join type but the skew mark.
    assert join and all("Inner" in x and "<=" not in x and ">=" not in x for x in join)
    want = sales.filter("bk > 1 or tid % 4000 < 3650").selectExpr(
        "tid", "case when bk = 1 then tid % 4000 else bk + 10000 end as key")
    assert out.select("tid", "key").exceptAll(want).count() == 0
    assert out.count() == want.count()


def test_rfm_needs_few_jobs_and_no_join_of_scores(spark, wh):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("rfm", "rfm")
    try:
        out = A.q07_rfm(wh)
        jobs = len(tracker.getJobIdsForGroup("rfm"))
    finally:
        spark.sparkContext.setJobGroup("tests", "tests")
    assert jobs < 8, jobs
    assert "Join" not in _plan(out)
