"""Point-in-time lookup, fact resolution, conflict-ignoring append."""

import datetime as dt
from decimal import Decimal


from pyspark.sql import functions as F

from starmart import schemas as S
from starmart.operators.facts import (conflict_ignoring_append, existing_conflict_keys,
                                      pit_lookup, resolve_sales)
from starmart.operators.quality import reject_report
from starmart.sources.calendar import dim_date

AS_OF = dt.date(2023, 6, 1)
START = dt.date(1900, 1, 1)
SALES = ("transaction_id long, transaction_date date, customer_business_key long, "
         "store_business_key long, product_business_key long, quantity long, "
         "unit_price decimal(10,2), total_amount decimal(10,2), discount_amount decimal(10,2)")


def _customers(spark):
    # Customer 1 lived in Paris until 2023-05-31, then Lyon (the documented example).
    return spark.createDataFrame([
        (1, 1, "A", "B", "a@b", "F", "FR", "Paris", None, START, AS_OF - dt.timedelta(days=1), False),
        (2, 1, "A", "B", "a@b", "F", "FR", "Lyon", None, AS_OF, None, True)], S.DIM_CUSTOMER)


def _products(spark, changed=False):
    rows = [(1, 100, "w", "b", "c", "s", Decimal("1.00"), START, None, True)]
    if changed:
        rows = [(1, 100, "w", "b", "c", "s", Decimal("1.00"), START, AS_OF - dt.timedelta(days=1), False),
                (2, 100, "w", "b", "c", "s", Decimal("2.00"), AS_OF, None, True)]
    return spark.createDataFrame(rows, S.DIM_PRODUCT)


def _stores(spark):
    return spark.createDataFrame([(1, 9, "s", "c", "C", "R", "T", None)], S.DIM_STORE)


def _sale(tid, day, cust=1, store=9, prod=100, qty=1, total="1.00"):
    return (tid, day, cust, store, prod, qty, Decimal("1.00"), Decimal(total), Decimal("0.00"))


def test_pit_lookup_picks_version_valid_on_date(spark):
    sales = spark.createDataFrame([_sale(1, AS_OF - dt.timedelta(days=1)), _sale(2, AS_OF),
                                   _sale(3, dt.date(2022, 5, 15))], SALES)
    got = pit_lookup(sales, _customers(spark), bk="customer_business_key", key="customer_key")
    assert {r["transaction_id"]: r["customer_key"] for r in got.collect()} == {1: 1, 2: 2, 3: 1}


def _cal(spark):
    return dim_date(spark, dt.date(2022, 1, 1), dt.date(2024, 12, 31))


def test_unmatched_sales_drop_and_are_reported(spark):
    sales = spark.createDataFrame([
        _sale(1, dt.date(2023, 1, 2)),                 # fine
        _sale(2, dt.date(2023, 1, 2), cust=77),        # unknown customer
        _sale(3, dt.date(2030, 1, 1)),                 # outside the calendar
        _sale(4, None),                                # null date
    ], SALES)
    t = {"dim_date": _cal(spark), "dim_store": _stores(spark),
         "dim_customer": _customers(spark), "dim_product": _products(spark)}
    got = resolve_sales(sales, t["dim_date"], t["dim_store"], t["dim_customer"], t["dim_product"])
    assert [r["transaction_id"] for r in got.collect()] == [1]

    class St:
        pass
    st = St()
    st.sales = sales
    st.customers = spark.createDataFrame([], "customer_business_key long, first_name string, last_name string, email string, gender string, country string, city string")
    st.stores = spark.createDataFrame([], "store_business_key long, store_name string, city string, country string, region string, store_type string")
    st.products = spark.createDataFrame([], "product_business_key long, product_name string, brand string, category string, subcategory string")
    rep = {(r["reason"], r["record_key"].split("|")[0]) for r in reject_report(st, t).collect()}
    assert ("customer_not_found", "2") in rep
    assert ("date_not_found", "3") in rep and ("date_not_found", "4") in rep
    assert not any(k == "1" for _, k in rep)


def _resolved(spark, sales_rows, changed):
    t = {"dim_date": _cal(spark), "dim_store": _stores(spark),
         "dim_customer": _customers(spark), "dim_product": _products(spark, changed)}
    sales = spark.createDataFrame(sales_rows, SALES)
    return t, resolve_sales(sales, t["dim_date"], t["dim_store"], t["dim_customer"],
                            t["dim_product"])


def test_duplicates_in_batch_and_in_fact_are_skipped(spark):
    _, batch = _resolved(spark, [_sale(1, dt.date(2023, 1, 2), total="5.00"),
                                 _sale(1, dt.date(2023, 1, 2), total="3.00"),
                                 _sale(2, dt.date(2023, 1, 2))], False)
    fresh = conflict_ignoring_append(batch, None)
    rows = {r["transaction_id"]: r["total_amount"] for r in fresh.collect()}
    assert rows == {1: Decimal("3.00"), 2: Decimal("1.00")}
    fact = fresh.select("transaction_id", "product_key")
    assert conflict_ignoring_append(batch, fact).count() == 0


def test_d4_reload_after_product_change(spark):
    """A product changes on as_of; a sale dated >= as_of loaded before the change
    reloads under the new version in reference mode, not in business mode."""
    sale = [_sale(1, AS_OF + dt.timedelta(days=2))]
    _, first = _resolved(spark, sale, False)
    fact = conflict_ignoring_append(first, None)
    t2, again = _resolved(spark, sale, True)
    ref, bus = (conflict_ignoring_append(
        again, existing_conflict_keys(fact, t2["dim_product"], mode), mode)
        for mode in ("reference", "business"))
    assert ref.count() == 1 and bus.count() == 0


def _parts(spark, lines, headers):
    from starmart.operators.facts import SaleParts
    return SaleParts(
        spark.createDataFrame(lines, "transaction_id long, store_business_key long, "
                              "product_business_key long, l_quantity long"),
        spark.createDataFrame(headers, "transaction_id long, transaction_date date, "
                              "customer_business_key long"),
        lambda rows: rows.withColumnsRenamed({"l_quantity": "quantity"}).withColumns({
            c: F.col("quantity").cast("decimal(10,2)")
            for c in ("unit_price", "total_amount", "discount_amount")}))


def test_lines_and_headers_resolve_as_their_join_does(spark):
    """Repeated and missing transactions, null keys, unknown members, days of two versions."""
    before, after = AS_OF - dt.timedelta(days=1), AS_OF
    parts = _parts(
        spark,
        [(1, 9, 100, 1), (1, 9, 100, 2), (2, 9, 100, 3), (2, 8, 100, 4), (3, 9, 100, 5),
         (4, 9, 77, 6), (5, 9, 100, 7), (None, 9, 100, 8), (6, None, 100, 9), (7, 9, 100, None)],
        [(1, before, 1), (2, after, 1), (2, after, 1), (2, before, 1), (3, None, 1),
         (4, after, 1), (5, after, 77), (None, after, 1), (6, after, 1), (7, after, 1), (8, after, 1)])
    dims = (_cal(spark), _stores(spark), _customers(spark), _products(spark, True))
    flat = parts.amounts(parts.lines.join(parts.headers, "transaction_id"))
    got, want = resolve_sales(parts, *dims), resolve_sales(flat, *dims)
    assert got.schema == want.schema
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    assert got.count() == 6


def test_customers_are_looked_up_once_for_a_transaction(spark):
    """Only headers are shuffled for the customers: no line's column passes that exchange."""
    parts = _parts(spark, [(1, 9, 100, 1)], [(1, AS_OF, 1)])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = resolve_sales(parts, _cal(spark), _stores(spark), _customers(spark),
                             _products(spark))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    lines = plan.splitlines()
    at = next(i for i, x in enumerate(lines) if "hashpartitioning(customer_business_key" in x)
    depth = lines[at].index("Exchange")
    below = [x for i, x in enumerate(lines[at + 1:]) if all(
        len(y) - len(y.lstrip(" :+-")) > depth for y in lines[at + 1:at + 2 + i])]
    assert below and not any("l_quantity" in x for x in below)


def test_reload_with_business_keys_looks_up_only_new_lines(spark):
    """Known lines leave before any lookup; what is new loads as before."""
    from starmart.loads import fact_batch
    t = {"dim_date": _cal(spark), "dim_store": _stores(spark), "dim_customer": _customers(spark),
         "dim_product": _products(spark, True), "fact_sales": spark.createDataFrame([], S.FACT_SALES)}
    headers = [(i, AS_OF + dt.timedelta(days=i), 1) for i in range(1, 5)]
    first = fact_batch(t, _parts(spark, [(1, 9, 100, 1), (2, 9, 100, 2)], headers), mode="business")
    t["fact_sales"] = first.drop("transaction_date")
    seen = []
    parts = _parts(spark, [(1, 9, 100, 9), (2, 9, 100, 9), (3, 9, 100, 3), (3, 9, 100, 2)], headers)
    amounts = parts.amounts
    parts.amounts = lambda rows: seen.append(rows.count()) or amounts(rows)
    again = fact_batch(t, parts, mode="business").collect()
    assert [(r["sales_key"], r["transaction_id"], r["quantity"]) for r in again] == [(3, 3, 2)]
    assert seen == [2]


def _first_load(spark, flat, mode):
    """A first load's facts, and the same from the batch reduced by a shuffle of its own."""
    from starmart.loads import fact_batch
    from starmart.operators.facts import with_sales_keys
    dims = {"dim_date": _cal(spark), "dim_store": _stores(spark),
            "dim_customer": _customers(spark), "dim_product": _products(spark, True)}
    t = {**dims, "fact_sales": spark.createDataFrame([], S.FACT_SALES)}
    got = fact_batch(t, flat, mode=mode)
    rows = flat.amounts(flat.lines.join(flat.headers, "transaction_id")) if hasattr(flat, "lines") else flat
    want = with_sales_keys(conflict_ignoring_append(resolve_sales(rows, *dims.values()), None, mode), 0)
    assert got.schema == want.schema
    got, want = (sorted(x.collect(), key=str) for x in (got, want))
    assert got == want
    return got


def test_first_load_settles_duplicates_of_one_and_of_several_days(spark):
    """A transaction of two days keeps its earlier row, also where no number is given."""
    a, b = dt.date(2023, 7, 3), dt.date(2023, 7, 1)
    rows = [_sale(1, a, total="5.00"), _sale(1, a, total="3.00"), _sale(2, a), _sale(2, b, total="9.00"),
            _sale(None, a), _sale(None, b), _sale(3, dt.date(2023, 5, 1)), _sale(3, b)]
    for mode in ("reference", "business"):
        got = _first_load(spark, spark.createDataFrame(rows, SALES), mode)
        assert sorted((r["transaction_id"] or 0, r["date_key"], r["total_amount"]) for r in got
                      if r["transaction_id"] != 3) == [
            (0, 20230701, Decimal("1.00")), (1, 20230703, Decimal("3.00")),
            (2, 20230701, Decimal("9.00"))]
        # Two versions of the product are two reference keys and one business key.
        assert sum(r["transaction_id"] == 3 for r in got) == (2 if mode == "reference" else 1)


def test_first_load_of_parts_settles_duplicates(spark, monkeypatch):
    from starmart.operators import facts
    a, b = AS_OF, AS_OF + dt.timedelta(days=1)
    parts = _parts(spark, [(1, 9, 100, 5), (1, 9, 100, 3), (2, 9, 100, 2), (4, 9, 100, 7),
                           *[(3, 9, 100, i) for i in range(20)], (None, 9, 100, 1)],
                   [(1, a, 1), (2, b, 1), (2, a, 1), (3, a, 1), (4, a, 1), (4, a, 1), (None, a, 1)])
    cal = _cal(spark)
    assert {r[0] for r in facts.far_transactions(parts, cal).collect()} == {2}
    for few in (facts.NEAR_ROWS, 10):  # the second: many rows of transaction 3 go the other way
        monkeypatch.setattr(facts, "NEAR_ROWS", few)
        got = _first_load(spark, parts, "reference")
        assert [(r["transaction_id"], r["date_key"], r["quantity"]) for r in got] == [
            (1, 20230601, 3), (2, 20230601, 2), (3, 20230601, 0), (4, 20230601, 7)]
    assert {r[0] for r in facts.far_transactions(parts, cal).collect()} == {2, 3}


def test_first_load_is_not_shuffled_for_its_duplicates(spark):
    from starmart.operators.facts import SALES_KEY_ORDER, dedupe_in_order
    from starmart.operators.ranking import placed
    _, batch = _resolved(spark, [_sale(1, dt.date(2023, 1, 2)), _sale(1, dt.date(2023, 1, 2))], False)
    for mode in ("reference", "business"):
        rows = placed(batch, SALES_KEY_ORDER, 4, settle=lambda r: dedupe_in_order(r, mode))
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert plan.count("rangepartitioning") == 1
        assert plan.index("rangepartitioning") > plan.index("Aggregate")  # printed root-first
        assert "hashpartitioning(transaction_id" not in plan and "hashpartitioning(date_key" not in plan
        assert rows.count() == 1
