"""Q01-Q12: the analytic questions.

Tie-breaks are explicit wherever the reference leaves order open:
customer_key for RFM quintiles, store_key for store quartiles, (country,
region, store_name) for the top-50 stores, product_name for the top-5
products. Global NTILEs use the distributed ranking of ``operators.ranking``
instead of a single-partition window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import round_div, total
from ..operators.ranking import ntile_global, running_total, tiles
from .marts import _calendar


def q01_monthly_country(t) -> DataFrame:
    """Sales and customers by month and country, read from the mart."""
    return (t["mart_monthly_country"]
            .select("year_number", "month_number", "country", "total_sales", "nb_customers")
            .orderBy("year_number", "month_number", "country"))


def q02_seasonality(t) -> DataFrame:
    """Monthly sales per category with a centred 3-row moving average.

    The window is partitioned by category only, which is safe: its input is
    already one row per (category, month).
    """
    f = t["fact_sales"].select("date_key", "product_key", "total_amount")
    p = t["dim_product"].select("product_key", "category")
    monthly = (f.join(_calendar(t), "date_key").join(p, "product_key")
               .groupBy("year_number", "month_number", "category")
               .agg(total(F.sum("total_amount")).alias("sales")))
    w = (Window.partitionBy("category")
         .orderBy(F.col("year_number") * 12 + F.col("month_number"))
         .rowsBetween(-1, 1))
    return (monthly.select("category", "year_number", "month_number", "sales",
                           F.avg("sales").over(w).alias("sales_ma3"))
            .orderBy("category", "year_number", "month_number"))


def q03_store_ranking(t) -> DataFrame:
    """Top 50 store groups by sales, with the average ticket (a top-k, no full sort)."""
    f = t["fact_sales"].select("store_key", "total_amount")
    s = t["dim_store"].select("store_key", "country", "region", "store_name")
    agg = (f.join(s, "store_key")
           .groupBy("country", "region", "store_name")
           .agg(total(F.sum("total_amount")).alias("total_sales"),
                F.count(F.lit(1)).alias("nb_transactions")))
    return (agg.withColumn("avg_ticket", round_div(F.col("total_sales"), F.col("nb_transactions")))
            .orderBy(F.col("total_sales").desc(), "country", "region", "store_name")
            .limit(50))


def _share_of(col: str, tot) -> F.Column:
    """round(100 * col / total, 2); the total is an uncorrelated scalar subquery."""
    return round_div(F.col(col) * F.lit(100), tot, num_scale=2, den_scale=2)


def q04_category_mix(t) -> DataFrame:
    """Category mix from the product mart: sales, quantity, average price, share."""
    m = t["mart_top_products"]
    grand = m.agg(total(F.sum("total_sales"))).scalar()
    agg = m.groupBy("category").agg(total(F.sum("total_sales")).alias("sales"),
                                    F.sum("total_qty").cast("long").alias("qty"))
    return (agg.select("category", "sales", "qty",
                       round_div(F.col("sales"), F.col("qty")).alias("avg_price"),
                       _share_of("sales", grand).alias("sales_share_pct"))
            .orderBy(F.col("sales").desc(), "category"))


def q05_price_curve(t) -> DataFrame:
    """Quantity per rounded unit price, with a running total per category."""
    f = t["fact_sales"].select("product_key", "unit_price", "quantity")
    p = t["dim_product"].select("product_key", "category")
    per_bucket = (f.join(p, "product_key")
                  .groupBy("category", F.round("unit_price", 0).cast("decimal(10,0)")
                           .alias("price_bucket"))
                  .agg(F.sum("quantity").cast("long").alias("qty")))
    return running_total(per_bucket, "category", "price_bucket", "qty", "cum_qty").orderBy(
        "category", "price_bucket")


def q06_cohorts(t) -> DataFrame:
    """Cohort retention: first purchase month x months since (fixed form).

    Activity is reduced to distinct (customer, month) first: at most one row
    per customer and calendar month, so the per-customer window is bounded
    by the number of months even for a customer with a third of all sales. The
    distinct events of a cell are then counted on the (cohort, month) grid.
    """
    f = t["fact_sales"].select("date_key", "customer_key")
    activity = (f.join(_calendar(t), "date_key")
                .select("customer_key",
                        (F.col("year_number") * 12 + F.col("month_number")).alias("order_ym"))
                .distinct())
    per_customer = Window.partitionBy("customer_key")
    cells = (activity.withColumn("cohort_ym", F.min("order_ym").over(per_customer))
             .groupBy("cohort_ym", "order_ym").agg(F.count(F.lit(1)).alias("n")))
    # An event's text is fixed by its cohort, offset and month: one for each cell.
    grid = (cells.withColumn("month_offset", F.col("order_ym") - F.col("cohort_ym"))
            .groupBy("cohort_ym", "month_offset")
            .agg(F.count(F.lit(1)).alias("active_events"),
                 F.sum("n").cast("long").alias("active_customers")))
    per_cohort = Window.partitionBy("cohort_ym")
    size = F.max(F.when(F.col("month_offset") == 0, F.col("active_customers"))).over(per_cohort)
    return (grid.withColumn("cohort_size", size)
            .withColumn("retention_pct",
                        round_div(F.col("active_customers") * F.lit(100), F.col("cohort_size"),
                                  num_scale=0))
            .orderBy("cohort_ym", "month_offset"))


def q07_rfm(t) -> DataFrame:
    """RFM: quintiles of recency, frequency and monetary; customers per segment.

    Score 1 is the best group (descending order), as in the reference.
    """
    f = t["fact_sales"].select("date_key", "customer_key", "total_amount")
    # A date key is its date's digits: the latest one is the latest date, without the calendar.
    base = (f.groupBy("customer_key")
            .agg(F.max("date_key").alias("last_purchase"),
                 F.count(F.lit(1)).alias("frequency"),
                 total(F.sum("total_amount")).alias("monetary")))
    # One row per customer, written once; the boundaries of all three measures are found together.
    scored = tiles(base, 5, {"last_purchase": "r_score", "frequency": "f_score",
                             "monetary": "m_score"}, "customer_key")
    return (scored.groupBy("r_score", "f_score", "m_score")
            .agg(F.count(F.lit(1)).alias("nb_customers"),
                 total(F.sum("monetary")).alias("_sum"))
            .select("r_score", "f_score", "m_score", "nb_customers",
                    round_div(F.col("_sum"), F.col("nb_customers")).alias("avg_monetary"))
            .orderBy(F.col("r_score").desc(), F.col("f_score").desc(), F.col("m_score").desc()))


def q08_store_quartiles(t) -> DataFrame:
    """Store quartiles by sales, counted per country and region."""
    f = t["fact_sales"].select("store_key", "total_amount")
    s = t["dim_store"].select("store_key", "country", "region", "store_name")
    perf = (f.join(s, "store_key").groupBy("store_key", "country", "region", "store_name")
            .agg(total(F.sum("total_amount")).alias("total_sales")))
    seg = ntile_global(perf, 4, "total_sales", "store_key", "performance_quartile")
    return (seg.groupBy("country", "region", "performance_quartile")
            .agg(F.count(F.lit(1)).alias("nb_stores"),
                 total(F.sum("total_sales")).alias("_sum"))
            .select("country", "region", "performance_quartile", "nb_stores",
                    round_div(F.col("_sum"), F.col("nb_stores")).alias("avg_sales"))
            .orderBy("country", "region", "performance_quartile"))


def quantity_bucket(q: F.Column) -> F.Column:
    """'1-2', '3-5', '6-9', else '10+' (null and < 1 included, as written)."""
    return (F.when(q.between(1, 2), "1-2").when(q.between(3, 5), "3-5")
            .when(q.between(6, 9), "6-9").otherwise("10+"))


def q09_quantity_buckets(t) -> DataFrame:
    """Quantity buckets with fact-row count and average ticket."""
    f = t["fact_sales"].select("quantity", "total_amount")
    return (f.groupBy(quantity_bucket(F.col("quantity")).alias("qty_bucket"))
            .agg(F.count(F.lit(1)).alias("nb_transactions"),
                 total(F.sum("total_amount")).alias("_sum"))
            .select("qty_bucket", "nb_transactions",
                    round_div(F.col("_sum"), F.col("nb_transactions")).alias("avg_ticket"))
            .orderBy(F.col("nb_transactions").desc(), "qty_bucket"))


def q10_brand_share(t) -> DataFrame:
    """Brand contribution and share, from the product mart."""
    m = t["mart_top_products"]
    grand = m.agg(total(F.sum("total_sales"))).scalar()
    agg = m.groupBy("brand").agg(total(F.sum("total_sales")).alias("total_sales"),
                                 F.sum("total_qty").cast("long").alias("total_qty"))
    return (agg.withColumn("sales_share_pct", _share_of("total_sales", grand))
            .orderBy(F.col("total_sales").desc(), "brand"))


def q11_country_share(t) -> DataFrame:
    """Country share of total sales, from the monthly mart."""
    m = t["mart_monthly_country"]
    grand = m.agg(total(F.sum("total_sales"))).scalar()
    agg = m.groupBy("country").agg(total(F.sum("total_sales")).alias("total_sales"))
    return (agg.withColumn("market_share_pct", _share_of("total_sales", grand))
            .orderBy(F.col("total_sales").desc(), "country"))


def q12_top5_products(t) -> DataFrame:
    """Top 5 product names per month and customer country (WindowGroupLimit)."""
    f = t["fact_sales"].select("date_key", "customer_key", "product_key", "total_amount")
    c = t["dim_customer"].select("customer_key", "country")
    p = t["dim_product"].select("product_key", "product_name")
    monthly = (f.join(_calendar(t), "date_key").join(c, "customer_key").join(p, "product_key")
               .groupBy("year_number", "month_number", "country", "product_name")
               .agg(total(F.sum("total_amount")).alias("sales")))
    w = (Window.partitionBy("year_number", "month_number", "country")
         .orderBy(F.col("sales").desc(), F.col("product_name").asc()))
    return (monthly.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= 5)
            .orderBy("year_number", "month_number", "country", "rn")
            .select("year_number", "month_number", "country", "product_name", "sales"))


QUERIES = {
    "q01_monthly_country": q01_monthly_country,
    "q02_seasonality": q02_seasonality,
    "q03_store_ranking": q03_store_ranking,
    "q04_category_mix": q04_category_mix,
    "q05_price_curve": q05_price_curve,
    "q06_cohorts": q06_cohorts,
    "q07_rfm": q07_rfm,
    "q08_store_quartiles": q08_store_quartiles,
    "q09_quantity_buckets": q09_quantity_buckets,
    "q10_brand_share": q10_brand_share,
    "q11_country_share": q11_country_share,
    "q12_top5_products": q12_top5_products,
}
