"""Calendar expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(d: Column) -> Column:
    """yyyymmdd as an integer."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def year_month(d: Column) -> Column:
    """yyyymm as an integer (the fact's partition column)."""
    return (F.year(d) * 100 + F.month(d)).cast("int")


def month_index(year: Column, month: Column) -> Column:
    """year * 12 + month, the month ordinal used by seasonality and cohorts."""
    return year * 12 + month


def lit_date(d: dt.date) -> Column:
    return F.lit(d).cast("date")
