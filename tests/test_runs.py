"""Published runs, failure handling, reload, layout."""

import pytest
from pyspark.sql import functions as F

from starmart import config as C
from starmart import runs as R
from starmart.catalog import Part, Warehouse
from starmart.loads import Staged
from starmart.operators.layout import daily_totals
from starmart.session import scratch_path

from .conftest import SF001


@pytest.fixture(scope="module")
def wh(spark):
    w = Warehouse(spark, scratch_path(spark, "test-wh"))
    staged = Staged.from_driver(spark, SF001)
    R.run_full_etl(w, staged, C.BATCH2_AS_OF)
    R.refresh_all_marts(w)
    return w


def test_metrics_of_first_run(wh, spark):
    m = {r["metric_name"]: int(r["metric_value"]) for r in R.metrics(wh, 1).collect()}
    n_fact = wh["fact_sales"].count()
    assert m[C.METRIC_FACT_INSERTED] == n_fact == m[C.METRIC_FACT_TOTAL]
    assert m[C.METRIC_CUSTOMER_ROWS] == spark.read.parquet(f"{SF001}/customer.parquet").count()


def test_mart_totals_equal_fact_total(wh):
    fact_total = wh["fact_sales"].agg(F.sum("total_amount")).first()[0]
    for name in ("mart_monthly_country", "mart_top_products", "mart_store_region"):
        assert wh[name].agg(F.sum("total_sales")).first()[0] == fact_total


def test_unchanged_reload_is_a_no_op(wh, spark):
    before = wh["fact_sales"].count()
    dims_before = {t: wh[t].count() for t in ("dim_customer", "dim_product", "dim_store")}
    R.run_full_etl(wh, Staged.from_driver(spark, SF001), C.BATCH2_AS_OF)
    assert wh["fact_sales"].count() == before
    assert {t: wh[t].count() for t in dims_before} == dims_before


def test_failed_run_keeps_old_snapshot(wh, spark, monkeypatch):
    before = wh.snapshot(refresh=True).version
    rows = wh["fact_sales"].count()

    def boom(*a, **k):
        raise RuntimeError("forced failure in the fact load")
    monkeypatch.setattr(R, "write_fact", boom)
    with pytest.raises(RuntimeError):
        R.run_full_etl(wh, Staged.from_driver(spark, SF001).batch2(), C.BATCH2_AS_OF)
    assert wh.snapshot(refresh=True).version == before
    assert wh["fact_sales"].count() == rows
    last = R.recent_runs(wh, 1).first()
    assert last["status"] == "FAILED" and "forced failure" in last["error_message"]
    errors = R.events(wh, last["run_id"]).filter(F.col("level") == "ERROR").count()
    assert errors == 1


def test_recent_runs_is_latest_first(wh):
    ids = [r["run_id"] for r in R.recent_runs(wh, 5).collect()]
    assert ids == sorted(ids, reverse=True) and len(ids) <= 5


def test_date_range_prunes_partitions(wh):
    fact = wh["fact_sales"]
    q = daily_totals(fact, "1998-03-01", "1998-03-31")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "year_month" in plan
    assert "PushedFilters" in plan and "date_key" in plan
    want = fact.filter(F.col("date_key").between(19980301, 19980331)).count()
    assert q.agg(F.sum("nb_lines")).first()[0] == want


def test_published_increment_equals_in_memory_scenario(spark):
    from starmart.loads import Staged as St
    from starmart.plans.scenarios import fact_incremental
    st = St.from_driver(spark, SF001)
    w = Warehouse(spark, scratch_path(spark, "inc"))
    early = St(st.customers, st.products, st.stores,
               st.sales.filter(F.col("transaction_date") < F.lit(C.BATCH2_AS_OF)))
    R.run_full_etl(w, early, C.BATCH2_AS_OF)
    R.run_incremental_etl(w, st.batch2(), C.INCREMENT_FROM, C.INCREMENT_TO, C.BATCH2_AS_OF)
    got = w["fact_sales"].drop("year_month")
    want = fact_incremental(spark, SF001).select(*got.columns)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_incremental_mart_refresh_equals_full_recompute(spark):
    from starmart.loads import Staged as St
    from starmart.plans.marts import MARTS
    st = St.from_driver(spark, SF001)
    w = Warehouse(spark, scratch_path(spark, "marts"))
    early = St(st.customers, st.products, st.stores,
               st.sales.filter(F.col("transaction_date") < F.lit(C.BATCH2_AS_OF)))
    R.run_full_etl(w, early, C.BATCH2_AS_OF)
    R.refresh_all_marts(w)
    R.run_incremental_etl(w, st.batch2(), C.INCREMENT_FROM, C.INCREMENT_TO, C.BATCH2_AS_OF)
    R.refresh_all_marts(w, incremental=True)
    msgs = [r["message"] for r in R.events(w).collect()]
    assert any("new fact folders" in m for m in msgs)
    t = w.tables()
    for name, fn in MARTS.items():
        got, want = w[name], fn(t)
        assert got.count() == want.count()
        assert got.exceptAll(want.select(*got.columns)).count() == 0, name
    # W23 read the new facts only: the pairs of the first load are kept beside theirs.
    pairs = w.snapshot().parts["store_customer_sales"]
    assert [p.kind for p in pairs] == ["append", "append"] and all(p.rows for p in pairs)
    R.refresh_all_marts(w, incremental=True)          # nothing new: marts kept
    assert any("is up to date" in r["message"] for r in R.events(w).collect())


def test_aborted_publish_does_not_block_the_next_one(spark):
    w = Warehouse(spark, scratch_path(spark, "abort"))
    # What a publish killed before its commit leaves: a version folder, no data file.
    spark.createDataFrame([], "x int").write.parquet(
        f"{w.root}/_manifest/version=1-dead/_temporary")
    assert w.snapshot(refresh=True).version == 0
    snap = w.publish({"mart_x": [Part("current", f"{w.root}/tables/mart_x/run=1", 3)]})
    assert snap.version == 1 and w.snapshot(refresh=True).parts["mart_x"][0].rows == 3


def test_a_second_writer_is_refused(spark):
    root = scratch_path(spark, "writers")
    a, b = Warehouse(spark, root), Warehouse(spark, root)
    base = b.snapshot(refresh=True).version
    a.publish({"mart_x": [Part("current", f"{root}/tables/mart_x/run=1", 3)]}, base=base)
    with pytest.raises(RuntimeError, match="one writer"):
        b.publish({"mart_x": [Part("current", f"{root}/tables/mart_x/run=2", 4)]}, base=base)
    assert b.snapshot(refresh=True).parts["mart_x"][0].rows == 3


@pytest.mark.parametrize("column", C.SALES_NOT_NULL)
def test_a_sale_without_a_required_value_fails_the_run(spark, wh, column):
    before, rows = wh.snapshot(refresh=True).version, wh["fact_sales"].count()
    st = Staged.from_driver(spark, SF001)
    kind = st.sales.schema[column].dataType
    bad = st.sales.withColumn(column, F.when(F.col("transaction_id") % 50 == 0, F.lit(None).cast(kind))
                              .otherwise(F.col(column) if column != "transaction_id"
                                         else F.col(column) + 10_000_000))
    if column != "transaction_id":  # new sales, so that none is a conflict
        bad = bad.withColumn("transaction_id", F.col("transaction_id") + 20_000_000)
    with pytest.raises(ValueError, match=column):
        R.run_full_etl(wh, Staged(st.customers, st.products, st.stores, bad), C.BATCH2_AS_OF)
    assert R.recent_runs(wh, 1).first()["status"] == "FAILED"
    assert wh.snapshot(refresh=True).version == before and wh["fact_sales"].count() == rows


def test_over_long_text_fails_the_run_with_its_whole_message(spark, wh):
    before = wh.snapshot(refresh=True).version
    st = Staged.from_driver(spark, SF001)
    bad = st.customers.withColumn("city", F.repeat(F.lit("x"), 101))
    with pytest.raises(ValueError, match="over-long"):
        R.run_full_etl(wh, Staged(bad, st.products, st.stores, st.sales), C.BATCH2_AS_OF)
    assert wh.snapshot(refresh=True).version == before
    run = R.Run(wh, "test")
    run.fail(ValueError("y" * 5000), "test")
    assert len(R.recent_runs(wh, 1).first()["error_message"]) > 5000


def test_later_years_extend_the_calendar_and_lose_no_sale(spark):
    st = Staged.from_driver(spark, SF001)
    w = Warehouse(spark, scratch_path(spark, "years"))
    R.run_full_etl(w, st, C.BATCH2_AS_OF)
    n, days = w["fact_sales"].count(), w["dim_date"].count()
    late = st.sales.withColumn("transaction_date", F.add_months("transaction_date", 240)).withColumn(
        "transaction_id", F.col("transaction_id") + 10_000_000)
    R.run_full_etl(w, Staged(st.customers, st.products, st.stores, late), C.BATCH2_AS_OF)
    assert w["fact_sales"].count() == 2 * n
    cal = w["dim_date"]
    assert cal.count() == cal.select("full_date").distinct().count() > days
    m = {r["metric_name"]: int(r["metric_value"]) for r in R.metrics(w, 2).collect()}
    assert m[C.METRIC_SALES_UNMATCHED] == 0


def test_unmatched_sales_are_counted(spark):
    st = Staged.from_driver(spark, SF001)
    w = Warehouse(spark, scratch_path(spark, "unmatched"))
    some = st.customers.filter(F.col("customer_business_key") % 11 != 5)
    R.run_full_etl(w, Staged(some, st.products, st.stores, st.sales), C.BATCH2_AS_OF)
    m = {r["metric_name"]: int(r["metric_value"]) for r in R.metrics(w, 1).collect()}
    lost = st.sales.join(some, "customer_business_key", "left_anti").count()
    assert m[C.METRIC_SALES_UNMATCHED] == lost > 0


def test_an_unchanged_load_writes_no_dimension_and_leaves_no_staging(spark, wh):
    st = Staged.from_driver(spark, SF001)
    old = {t: [p.path for p in wh.snapshot(refresh=True).parts[t]]
           for t in ("dim_customer", "dim_product", "dim_store", "dim_date")}
    R.run_full_etl(wh, st, C.BATCH2_AS_OF)
    new = wh.snapshot(refresh=True).parts
    assert {t: [p.path for p in new[t]] for t in old} == old
    jvm = spark._jvm.org.apache.hadoop.fs
    path = jvm.Path(f"{wh.root}/_staging")
    left = path.getFileSystem(spark._jsc.hadoopConfiguration())
    assert not left.exists(path) or len(left.listStatus(path)) == 0


def _ids(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "transaction_id long")


def test_conflict_keys_are_read_by_transaction_bounds(spark, wh):
    keys = R.loaded_keys(wh, _ids(spark, 10, 20), {"min_transaction_id": 10, "max_transaction_id": 20},
                         "business")
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(transaction_id,10)" in plan


def test_stretches_hold_every_transaction_and_leave_the_widest_gaps(spark):
    import random
    rng = random.Random(4)
    ids = sorted({rng.randint(0, 50) * 10_000 + rng.randint(0, 99) for _ in range(400)} | {10**12})
    held = R.occupied(_ids(spark, *ids, None), ids[0], ids[-1])
    assert len(held) <= R.RANGES and all(any(a <= i <= b for a, b in held) for i in ids)
    assert all(b < c for (_, b), (c, _) in zip(held, held[1:]))
    assert R.occupied(_ids(spark, 7), 7, 7) == [(7, 7)]


def _footers(spark, df, *columns):
    """Per row group of the files of ``df``: (folder, rows, {column: (min, max)})."""
    import pyarrow.parquet as pq
    out = []
    for f in df.inputFiles():
        meta = pq.ParquetFile(f.removeprefix("file://")).metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            stats = {c: group.column(names.index(c)).statistics for c in columns}
            out.append((f, group.num_rows, {c: (x.min, x.max) for c, x in stats.items()}))
    return out


def test_one_old_transaction_reads_few_key_files(spark, monkeypatch):
    monkeypatch.setattr(R, "FILE_ROWS", 100)
    w = Warehouse(spark, scratch_path(spark, "keys-wh"))
    R.run_full_etl(w, Staged.from_driver(spark, SF001), C.BATCH2_AS_OF)
    groups = _footers(spark, w["fact_keys"], "transaction_id")
    assert len(groups) > 40
    top = max(g["transaction_id"][1] for _, _, g in groups)
    new = list(range(top + 1, top + 500))
    held = R.occupied(_ids(spark, 3, *new), 3, top + 499)
    met = [g for _, _, g in groups if any(
        g["transaction_id"][0] <= b and a <= g["transaction_id"][1] for a, b in held)]
    assert 0 < len(met) < len(groups) / 10


def test_rows_are_counted_above_the_last_shuffle(spark, wh):
    """A map stage that runs again cannot count a row twice: only result tasks count."""
    from starmart.operators.facts import conflict_marked, resolve_sales
    t = wh.tables()
    st = Staged.from_driver(spark, SF001)
    rows = conflict_marked(resolve_sales(st.sales, t["dim_date"], t["dim_store"], t["dim_customer"],
                                         t["dim_product"]),
                           wh["fact_keys"].select("transaction_id", "product_key"), "reference")
    seen = []
    from pyspark.sql.classic.dataframe import DataFrame
    whole = DataFrame.observe

    def observed(df, *args):
        out = whole(df, *args)
        seen.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    class Run:
        pass
    run = Run()
    run.wh, run.run_id = wh, 777
    DataFrame.observe = observed
    try:
        parts, met = R.write_fact(run, rows, 0, 6000)
    finally:
        DataFrame.observe = whole
        wh.drop_staging(777)
    assert parts == [] and met == rows.agg(F.sum("_met")).first()[0] > 0
    assert seen[0].index("CollectMetrics") < seen[0].index("Exchange")
    assert seen[0].count("CollectMetrics") == 1
    # Known keys keep only their place in the order.
    stub = rows.filter("_known").first()
    assert stub["unit_price"] is None and stub["date_key"] is not None


def test_files_skip_by_store_and_customer(spark, monkeypatch):
    """Boxes of (date, product, store, customer): at least half of the row groups are skipped."""
    import datetime as dt

    import oracle_queries as OQ
    monkeypatch.setattr(R, "FILE_ROWS", 100)
    w = Warehouse(spark, scratch_path(spark, "layout-wh"))
    R.run_incremental_etl(w, Staged.from_driver(spark, "/root/testdata/sf0.1"), dt.date(1998, 2, 1),
                          dt.date(1998, 4, 30), C.BATCH2_AS_OF)
    columns = ("date_key", "product_key", "store_key", "customer_key")
    groups = _footers(spark, w["fact_sales"], *columns)

    def share(low, high, column, keys):
        inside = [g for f, _, g in groups if low // 100 <= int(f.split("year_month=")[1][:6]) <= high // 100]
        met = [g for g in inside if g["date_key"][0] <= high and low <= g["date_key"][1]
               and any(g[column][0] <= k <= g[column][1] for k in keys)]
        return len(met) / len(inside)

    assert share(19980301, 19980331, "store_key", OQ.STORES) <= 0.5
    assert share(19980201, 19980430, "customer_key", OQ.CUSTOMERS) <= 0.5
    assert share(19980301, 19980331, "product_key", OQ.PRODUCTS) <= 0.5
    keys = w["fact_sales"].select("sales_key")
    assert keys.distinct().count() == keys.count() == keys.agg(F.max("sales_key")).first()[0]
