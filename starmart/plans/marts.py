"""The three marts, grouped by attribute values (not keys).

Distinct customer counts are planned by Catalyst as a multi-phase distinct
aggregate: (group, customer) pairs are de-duplicated map-side first, so a
hot customer or country is pre-aggregated before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import total


def _calendar(t) -> DataFrame:
    return t["dim_date"].select("date_key", "year_number", "month_number")


def mart_monthly_country(t) -> DataFrame:
    """Sales and distinct customers per year, month and customer country."""
    f = t["fact_sales"].select("date_key", "customer_key", "total_amount")
    c = t["dim_customer"].select("customer_key", "country")
    return (f.join(_calendar(t), "date_key").join(c, "customer_key")
            .groupBy("year_number", "month_number", "country")
            .agg(total(F.sum("total_amount")).alias("total_sales"),
                 F.countDistinct("customer_key").alias("nb_customers")))


def mart_top_products(t) -> DataFrame:
    """Sales and quantity per category, brand and product name."""
    f = t["fact_sales"].select("product_key", "total_amount", "quantity")
    p = t["dim_product"].select("product_key", "category", "brand", "product_name")
    return (f.join(p, "product_key")
            .groupBy("category", "brand", "product_name")
            .agg(total(F.sum("total_amount")).alias("total_sales"),
                 F.sum("quantity").cast("long").alias("total_qty")))


#: The pairs that W23 is made of, kept as a table that every refresh appends to.
STORE_PAIRS = "store_customer_sales"


def store_pairs(facts: DataFrame) -> DataFrame:
    """Sales of each customer in each store. Pairs of several loads may be laid side by side:
    their sums add up and a customer counts once."""
    return facts.groupBy("store_key", "customer_key").agg(
        total(F.sum("total_amount")).alias("sales"))


def store_region_of(pairs: DataFrame, stores: DataFrame) -> DataFrame:
    s = stores.select("store_key", "region", "store_name")
    return (pairs.join(s, "store_key").groupBy("region", "store_name")
            .agg(total(F.sum("sales")).alias("total_sales"),
                 F.countDistinct("customer_key").alias("nb_customers")))


def mart_store_region(t) -> DataFrame:
    """Sales and distinct customers per region and store name."""
    return store_region_of(store_pairs(t["fact_sales"]), t["dim_store"])


MARTS = {
    "mart_monthly_country": mart_monthly_country,
    "mart_top_products": mart_top_products,
    "mart_store_region": mart_store_region,
}


# --- incremental refresh -------------------------------------------------------
# Dimension versions never change attributes (SCD2), so the rows a fact row
# contributes to W21 and W22 are fixed once loaded. W23 groups by store
# attributes, which SCD1 overwrites in place: its pairs of keys are kept instead.

def refresh_monthly_country(t, old: DataFrame, new_facts: DataFrame) -> DataFrame:
    """W21 for the year-months that received facts; other months are kept.

    Distinct customers cannot be added across loads, so each affected month
    is recomputed over the whole fact, pruned to those months by year_month.
    The month list is bounded by the calendar.
    """
    months = [r[0] for r in new_facts.select("year_month").distinct().collect()]
    if not months:
        return old
    fact = t["fact_sales"].filter(F.col("year_month").isin(months))
    fresh = mart_monthly_country({**t, "fact_sales": fact})
    kept = old.filter(~(F.col("year_number") * 100 + F.col("month_number")).isin(months))
    return kept.unionByName(fresh)


def refresh_top_products(t, old: DataFrame, new_facts: DataFrame) -> DataFrame:
    """Sums of the new facts added to the old mart, per group."""
    delta = mart_top_products({**t, "fact_sales": new_facts})
    return (old.unionByName(delta).groupBy("category", "brand", "product_name")
            .agg(total(F.sum("total_sales")).alias("total_sales"),
                 F.sum("total_qty").cast("long").alias("total_qty")))


INCREMENTAL = {
    "mart_monthly_country": refresh_monthly_country,
    "mart_top_products": refresh_top_products,
}
