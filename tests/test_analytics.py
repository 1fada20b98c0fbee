"""Q02-Q12 hand cases (FIXTURES section 4) on tiny hand-built warehouses."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from starmart import schemas as S
from starmart.functions.money import round_div
from starmart.plans import analytics as A
from starmart.plans.marts import MARTS
from starmart.sources.calendar import dim_date

START = dt.date(1900, 1, 1)


def _wh(spark, facts, customers=None, products=None, stores=None):
    """facts: (date, customer_key, store_key, product_key, qty, unit_price, total)."""
    customers = customers or [(1, 1, "a", "b", "e", "F", "FR", "c", None, START, None, True)]
    products = products or [(1, 1, "w", "b", "cat", "s", D("1.00"), START, None, True)]
    stores = stores or [(1, 1, "s1", "c", "FR", "EU", "T", None)]
    rows = [(i + 1, int(d.strftime("%Y%m%d")), c, s, p, i + 1, q, D(u), D(t), D("0.00"))
            for i, (d, c, s, p, q, u, t) in enumerate(facts)]
    t = {"fact_sales": spark.createDataFrame(rows, S.FACT_SALES),
         "dim_date": dim_date(spark, dt.date(2022, 1, 1), dt.date(2023, 12, 31)),
         "dim_customer": spark.createDataFrame(customers, S.DIM_CUSTOMER),
         "dim_product": spark.createDataFrame(products, S.DIM_PRODUCT),
         "dim_store": spark.createDataFrame(stores, S.DIM_STORE)}
    for name, fn in MARTS.items():
        t[name] = fn(t)
    return t


def test_calendar_hand_cases(spark):
    cal = {r["full_date"]: r for r in dim_date(spark, dt.date(2022, 1, 1), dt.date(2024, 12, 31)).collect()}
    cases = {dt.date(2022, 1, 1): (6, 52, True), dt.date(2022, 1, 2): (0, 52, False),
             dt.date(2023, 12, 25): (1, 52, True), dt.date(2024, 2, 29): (4, 9, False)}
    for d, (dow, week, hol) in cases.items():
        r = cal[d]
        assert (r["day_of_week"], r["week_number"], r["is_holiday"]) == (dow, week, hol)
    assert cal[dt.date(2022, 1, 1)]["date_key"] == 20220101
    assert cal[dt.date(2022, 1, 1)]["day_name"] == "Saturday"
    assert cal[dt.date(2022, 1, 1)]["month_name"] == "January"


def test_q02_missing_month_uses_row_neighbours(spark):
    t = _wh(spark, [(dt.date(2022, 1, 5), 1, 1, 1, 1, "10.00", "10.00"),
                    (dt.date(2022, 2, 5), 1, 1, 1, 1, "20.00", "20.00"),
                    (dt.date(2022, 4, 5), 1, 1, 1, 1, "40.00", "40.00")])
    got = [(r["month_number"], r["sales_ma3"]) for r in A.q02_seasonality(t).collect()]
    assert got == [(1, D("15.000000")), (2, D("23.333333")), (4, D("30.000000"))]


def test_q05_price_buckets_round_half_up(spark):
    t = _wh(spark, [(dt.date(2022, 1, 5), 1, 1, 1, 2, "2.50", "5.00"),
                    (dt.date(2022, 1, 6), 1, 1, 1, 3, "2.49", "7.47")])
    got = [(r["price_bucket"], r["qty"], r["cum_qty"]) for r in A.q05_price_curve(t).collect()]
    assert got == [(D("2"), 3, 3), (D("3"), 2, 5)]


def test_q06_cohort_retention(spark):
    customers = [(k, k, "a", "b", "e", "F", "FR", "c", None, START, None, True) for k in (1, 2)]
    t = _wh(spark, [(dt.date(2022, 1, 5), 1, 1, 1, 1, "1.00", "1.00"),
                    (dt.date(2022, 1, 9), 2, 1, 1, 1, "1.00", "1.00"),
                    (dt.date(2022, 3, 9), 2, 1, 1, 1, "1.00", "1.00")], customers=customers)
    got = {r["month_offset"]: r for r in A.q06_cohorts(t).collect()}
    assert got[0]["cohort_size"] == 2 and got[0]["active_customers"] == 2
    assert got[2]["active_customers"] == 1 and got[2]["retention_pct"] == D("50.00")
    assert got[2]["active_events"] == 1


def test_q09_buckets_include_zero_and_null(spark):
    t = _wh(spark, [(dt.date(2022, 1, 5), 1, 1, 1, q, "1.00", "1.00") for q in (1, 3, 6, 10, 0)])
    t["fact_sales"] = t["fact_sales"].unionByName(
        t["fact_sales"].limit(1).withColumn("quantity", F.lit(None).cast("long")))
    got = {r["qty_bucket"]: r["nb_transactions"] for r in A.q09_quantity_buckets(t).collect()}
    assert got == {"1-2": 1, "3-5": 1, "6-9": 1, "10+": 3}


def test_round_div_half_away_from_zero(spark):
    df = spark.createDataFrame([(D("-0.05"), 10), (D("0.05"), 10), (D("1.00"), 0)],
                               "a decimal(20,2), n long")
    got = [r[0] for r in df.select(round_div(F.col("a"), F.col("n"))).collect()]
    assert got == [D("-0.01"), D("0.01"), None]


def test_q12_tie_broken_by_lower_product_name(spark):
    products = [(k, k, f"p{k}", "b", "c", "s", D("1.00"), START, None, True) for k in range(1, 7)]
    facts = [(dt.date(2022, 1, 5), 1, 1, k, 1, "1.00", "10.00") for k in range(1, 6)]
    facts += [(dt.date(2022, 1, 6), 1, 1, 6, 1, "1.00", "6.00"),   # p6 totals 10.00 too:
              (dt.date(2022, 1, 7), 1, 1, 6, 1, "1.00", "4.00")]   # tied with p1..p5
    t = _wh(spark, facts, products=products)
    names = [r["product_name"] for r in A.q12_top5_products(t).collect()]
    assert len(names) == 5 and "p6" not in names
