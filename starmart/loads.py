"""W11, W13-W15 as pure DataFrame compositions (no writes).

``Tables`` maps table names to DataFrames. A dimension load takes the
tables before and returns the tables after plus the change feed; a fact
batch returns the new fact rows. The published form (``runs``) writes these
frames; tests and scenarios use them directly.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import config as C
from . import schemas as S
from .operators.facts import (SaleParts, conflict_columns, conflict_ignoring_append,
                              dedupe_in_order, existing_conflict_keys, resolve_for_order,
                              resolve_sales, with_sales_keys)
from .operators.ranking import max_key
from .operators.scd import DimDelta, most_rows, scd1_merge, scd2_merge
from .session import concurrently
from .sources import staging as stg
from .sources.calendar import calendar_of, dim_date

Tables = dict[str, DataFrame]


@dataclass
class Staged:
    customers: DataFrame
    products: DataFrame
    stores: DataFrame
    sales: DataFrame
    #: The same sales before the join of lines and headers, where the sources have them apart.
    parts: SaleParts | None = None

    @classmethod
    def from_driver(cls, spark: SparkSession, sf_dir: str) -> "Staged":
        return cls(stg.stage_customers(spark, sf_dir), stg.stage_products(spark, sf_dir),
                   stg.stage_stores(spark, sf_dir), stg.stage_sales(spark, sf_dir),
                   SaleParts(stg.sale_lines(spark, sf_dir), stg.sale_headers(spark, sf_dir),
                             stg.with_amounts))

    def batch2(self) -> "Staged":
        return Staged(stg.customers_batch2(self.customers), stg.products_batch2(self.products),
                      stg.stores_batch2(self.stores), self.sales, self.parts)


@dataclass
class DimLoad:
    tables: Tables
    deltas: dict[str, DimDelta]
    events: DataFrame


def empty_tables(spark: SparkSession, sales: DataFrame | None = None) -> Tables:
    """Empty tables, but for the calendar of ``sales``."""
    return {
        "dim_date": dim_date(spark) if sales is None else calendar_of(sales),
        "dim_customer": spark.createDataFrame([], S.DIM_CUSTOMER),
        "dim_product": spark.createDataFrame([], S.DIM_PRODUCT),
        "dim_store": spark.createDataFrame([], S.DIM_STORE),
        "fact_sales": spark.createDataFrame([], S.FACT_SALES),
    }


def load_dimensions(tables: Tables, staged: Staged, as_of: dt.date,
                    max_keys: dict[str, int] | None = None) -> DimLoad:
    """Customers, products (SCD2), then stores (SCD1); no loop, no collect.

    ``max_keys``: largest surrogate key per dimension, when known.
    """
    mk = max_keys or {}
    most = most_rows(staged.customers.select("customer_business_key"),
                     staged.products.select("product_business_key"))
    # No merge reads another's result: their jobs run beside each other.
    cust, prod, store = concurrently(
        staged.stores.sparkSession,
        lambda: scd2_merge(tables["dim_customer"], staged.customers, entity="customer",
                           key="customer_key", bk="customer_business_key", attrs=C.CUSTOMER_ATTRS,
                           as_of=as_of, after_key=mk.get("dim_customer"), most=most[0]),
        lambda: scd2_merge(tables["dim_product"], staged.products, entity="product",
                           key="product_key", bk="product_business_key", attrs=C.PRODUCT_ATTRS,
                           as_of=as_of, after_key=mk.get("dim_product"), most=most[1]),
        lambda: scd1_merge(tables["dim_store"], staged.stores, entity="store", key="store_key",
                           bk="store_business_key", attrs=C.STORE_ATTRS,
                           after_key=mk.get("dim_store")))
    out = dict(tables)
    out["dim_customer"] = cust.all_versions(tables["dim_customer"].filter(~F.col("is_current")))
    out["dim_product"] = prod.all_versions(tables["dim_product"].filter(~F.col("is_current")))
    out["dim_store"] = store.current
    events = cust.events.unionByName(prod.events).unionByName(store.events)
    return DimLoad(out, {"dim_customer": cust, "dim_product": prod, "dim_store": store}, events)


def fact_batch(tables: Tables, sales: DataFrame | SaleParts, *, mode: str = "reference",
               date_from: dt.date | None = None, date_to: dt.date | None = None,
               after_key: int | None = None) -> DataFrame:
    """W13 + W14 (+ W15's date range): new fact rows with sales keys assigned.

    A business conflict key is known before any lookup: the lines that the fact already has
    leave first. A reference key is known from the product lookup on. A first load meets
    nothing: its duplicates are settled in the fact's order.
    """
    dims = [tables[t] for t in ("dim_date", "dim_store", "dim_customer", "dim_product")]
    if date_from is not None and date_to is not None:
        sales = sales.filter(F.col("transaction_date").between(F.lit(date_from), F.lit(date_to)))
    start = max_key(tables["fact_sales"], "sales_key") if after_key is None else after_key
    if start == 0 and tables["fact_sales"].isEmpty():
        return with_sales_keys(resolve_for_order(sales, *dims, mode), start,
                               lambda rows: dedupe_in_order(rows, mode).drop("_met"))
    existing = existing_conflict_keys(tables["fact_sales"], tables["dim_product"], mode)
    if mode == "business" and isinstance(sales, SaleParts):
        sales, existing = sales.but(existing, conflict_columns(mode)), None
    fresh = conflict_ignoring_append(resolve_sales(sales, *dims), existing, mode)
    return with_sales_keys(fresh, start)
