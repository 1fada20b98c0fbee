"""Reads over the date-clustered fact.

The fact is stored under ``year_month=`` folders; inside a month, rows are in the
order of the interleaved bits of (customer, store, product, day) and cut into files
of a bounded number of rows. A date filter prunes folders (``PartitionFilters``); a filter
on any of the four columns skips the files and row groups whose min/max exclude it
(``PushedFilters``), as each holds a small box of the four. Transactions are found through
the key table, which is sorted by them: the months it names prune the fact's folders
while the query runs (``dynamicpruning``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.zorder import interleaved, scaled


def _as_date(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


def date_range_filter(fact: DataFrame, start, end) -> Column:
    """date_key in [start, end], plus the implied year_month bound for pruning."""
    s, e = _as_date(start), _as_date(end)
    cond = F.col("date_key").between(int(s.strftime("%Y%m%d")), int(e.strftime("%Y%m%d")))
    if "year_month" in fact.columns:
        cond = cond & F.col("year_month").between(s.year * 100 + s.month, e.year * 100 + e.month)
    return cond


def daily_totals(fact: DataFrame, start, end) -> DataFrame:
    return (fact.filter(date_range_filter(fact, start, end)).groupBy("date_key")
            .agg(F.count(F.lit(1)).alias("nb_lines"),
                 F.sum("total_amount").cast("decimal(20,2)").alias("total_sales")))


def _sums(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("nb_lines"), F.sum("quantity").cast("long").alias("quantity"),
        F.sum("total_amount").cast("decimal(20,2)").alias("total_sales"))


def daily_product_totals(fact: DataFrame, start, end, products=None) -> DataFrame:
    """Per day and product of a date range; only the product keys in ``products``, if given."""
    rows = fact.filter(date_range_filter(fact, start, end))
    if products is not None:
        rows = rows.filter(F.col("product_key").isin(list(products)))
    return _sums(rows, "date_key", "product_key")


def daily_store_totals(fact: DataFrame, start, end, stores) -> DataFrame:
    """Per day and store of a date range, for the store keys in ``stores``."""
    return _sums(fact.filter(date_range_filter(fact, start, end)
                             & F.col("store_key").isin(list(stores))), "date_key", "store_key")


def customer_period(fact: DataFrame, customers, start, end) -> DataFrame:
    """Every fact row of some customers in a date range."""
    return fact.filter(date_range_filter(fact, start, end)
                       & F.col("customer_key").isin(list(customers))).drop("year_month")


def layout_order(date_key: Column, tops: dict[str, int]) -> Column:
    """The place of a fact row inside its month; ``tops``: the highest key of each column."""
    # The folder has the month already: its day comes last of the four at each level of bits.
    keys = (scaled(F.col(c), max(0, tops.get(c) or 0))
            for c in ("customer_key", "store_key", "product_key"))
    return interleaved(*keys, scaled(date_key % 100, 31))


def transaction_lines(fact: DataFrame, keys: DataFrame, first: int, last: int) -> DataFrame:
    """Fact rows of the transactions ``first`` to ``last``.

    ``keys`` (sorted by transaction) says which months these fall in. That list has at
    most one row for each month of the calendar, which bounds the broadcast; the
    join on the folder column lets Spark skip all other folders.
    """
    bounds = F.col("transaction_id").between(first, last)
    months = keys.filter(bounds).select("year_month").distinct()
    return fact.filter(bounds).join(F.broadcast(months), "year_month", "left_semi").drop(
        "year_month")
