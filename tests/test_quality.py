"""W16-W17 hand cases (FIXTURES section 4)."""

import datetime as dt
from decimal import Decimal

from starmart import schemas as S
from starmart.operators.quality import reject_report, uniqueness_report
from starmart.sources.calendar import dim_date

START = dt.date(1900, 1, 1)


def _tables(spark, customers):
    return {"dim_customer": spark.createDataFrame(customers, S.DIM_CUSTOMER),
            "dim_product": spark.createDataFrame([], S.DIM_PRODUCT),
            "dim_store": spark.createDataFrame([], S.DIM_STORE),
            "fact_sales": spark.createDataFrame([], S.FACT_SALES)}


def test_two_current_rows_and_overlaps_are_reported(spark):
    rows = [
        (1, 10, "a", "b", "e", "F", "FR", "c", None, START, None, True),
        (2, 10, "a", "b", "e", "F", "FR", "d", None, dt.date(2020, 1, 1), None, True),
        (3, 11, "a", "b", "e", "F", "FR", "c", None, START, dt.date(2020, 12, 31), False),
        (4, 11, "a", "b", "e", "F", "FR", "d", None, dt.date(2021, 1, 1), None, True),
        # empty interval (two changes on one day): never an overlap
        (5, 12, "a", "b", "e", "F", "FR", "c", None, dt.date(2021, 1, 1), dt.date(2020, 12, 31), False),
        (6, 12, "a", "b", "e", "F", "FR", "d", None, dt.date(2021, 1, 1), None, True),
    ]
    rep = {(r["reason"], r["record_key"]) for r in
           uniqueness_report(_tables(spark, rows)).collect()}
    assert ("two_current_rows", "10") in rep
    assert ("overlapping_versions", "10|2") in rep
    assert not any(k.startswith("11") or k.startswith("12") for _, k in rep)


class _Staged:
    pass


def test_null_id_and_too_long_text_are_rejected(spark):
    st = _Staged()
    st.sales = spark.createDataFrame(
        [(None, dt.date(2022, 1, 3), 1, 1, 1, 1, Decimal("1.00"), Decimal("1.00"), Decimal("0"))],
        "transaction_id long, transaction_date date, customer_business_key long, "
        "store_business_key long, product_business_key long, quantity long, "
        "unit_price decimal(10,2), total_amount decimal(10,2), discount_amount decimal(10,2)")
    st.customers = spark.createDataFrame(
        [(1, "a", "b", "e", "F", "X" * 51, "c")],
        "customer_business_key long, first_name string, last_name string, email string, "
        "gender string, country string, city string")
    st.stores = spark.createDataFrame(
        [(1, "s", "c", "C", "R", "T")], "store_business_key long, store_name string, city string, "
        "country string, region string, store_type string")
    st.products = spark.createDataFrame(
        [(1, "p", "b", "c", "s")], "product_business_key long, product_name string, "
        "brand string, category string, subcategory string")
    t = _tables(spark, [(1, 1, "a", "b", "e", "F", "FR", "c", None, START, None, True)])
    t["dim_date"] = dim_date(spark, dt.date(2022, 1, 1), dt.date(2022, 12, 31))
    t["dim_store"] = spark.createDataFrame([(1, 1, "s", "c", "C", "R", "T", None)], S.DIM_STORE)
    t["dim_product"] = spark.createDataFrame(
        [(1, 1, "p", "b", "c", "s", None, START, None, True)], S.DIM_PRODUCT)
    reasons = {(r["source"], r["reason"]) for r in reject_report(st, t).collect()}
    assert reasons == {("sales", "null_transaction_id"), ("customers", "too_long_country")}


def test_overlapping_versions_do_not_duplicate_reject_rows(spark):
    st = _Staged()
    st.sales = spark.createDataFrame(
        [(None, dt.date(2022, 3, 3), 10, 1, 1, 1, Decimal("1.00"), Decimal("1.00"), Decimal("0"))],
        "transaction_id long, transaction_date date, customer_business_key long, "
        "store_business_key long, product_business_key long, quantity long, "
        "unit_price decimal(10,2), total_amount decimal(10,2), discount_amount decimal(10,2)")
    st.customers = spark.createDataFrame([], "customer_business_key long, first_name string, last_name string, email string, gender string, country string, city string")
    st.stores = spark.createDataFrame([], "store_business_key long, store_name string, city string, country string, region string, store_type string")
    st.products = spark.createDataFrame([], "product_business_key long, product_name string, brand string, category string, subcategory string")
    overlapping = [(1, 10, "a", "b", "e", "F", "FR", "c", None, START, None, True),
                   (2, 10, "a", "b", "e", "F", "FR", "d", None, dt.date(2020, 1, 1), None, True)]
    t = _tables(spark, overlapping)
    t["dim_date"] = dim_date(spark, dt.date(2022, 1, 1), dt.date(2022, 12, 31))
    t["dim_store"] = spark.createDataFrame([(1, 1, "s", "c", "C", "R", "T", None)], S.DIM_STORE)
    t["dim_product"] = spark.createDataFrame(
        [(1, 1, "p", "b", "c", "s", None, START, None, True)], S.DIM_PRODUCT)
    rows = [(r["source"], r["reason"]) for r in reject_report(st, t).collect()]
    assert rows == [("sales", "null_transaction_id")]


def test_reject_report_shuffles_no_money(spark):
    """Joins carry which required values a sale lacks, not the values."""
    st = _Staged()
    st.sales = spark.createDataFrame(
        [(None, dt.date(2022, 3, 3), 9, 1, 1, None, Decimal("1.00"), None, Decimal("0"))],
        "transaction_id long, transaction_date date, customer_business_key long, "
        "store_business_key long, product_business_key long, quantity long, "
        "unit_price decimal(10,2), total_amount decimal(10,2), discount_amount decimal(10,2)")
    st.customers = spark.createDataFrame([], "customer_business_key long, first_name string, last_name string, email string, gender string, country string, city string")
    st.stores = spark.createDataFrame([], "store_business_key long, store_name string, city string, country string, region string, store_type string")
    st.products = spark.createDataFrame([], "product_business_key long, product_name string, brand string, category string, subcategory string")
    t = _tables(spark, [])
    t["dim_date"] = dim_date(spark, dt.date(2022, 1, 1), dt.date(2022, 12, 31))
    t["dim_store"] = spark.createDataFrame([(1, 1, "s", "c", "C", "R", "T", None)], S.DIM_STORE)
    t["dim_product"] = spark.createDataFrame(
        [(1, 1, "p", "b", "c", "s", None, START, None, True)], S.DIM_PRODUCT)
    report = reject_report(st, t)
    assert sorted(r["reason"] for r in report.collect()) == [
        "customer_not_found", "null_quantity", "null_total_amount", "null_transaction_id"]
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    joined = [x for x in plan.split("\n") if "Project" in x and "_date_ok" in x]
    assert joined and not [x for x in joined if "unit_price" in x or "total_amount" in x]
