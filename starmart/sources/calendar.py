"""The calendar dimension: the whole years that the staged sales touch."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.dates import date_key


def date_span(sales: DataFrame) -> tuple[dt.date | None, dt.date | None]:
    """First and last transaction date; (None, None) without any."""
    return tuple(sales.agg(F.min("transaction_date"), F.max("transaction_date")).first())


def calendar_of(sales: DataFrame) -> DataFrame:
    """The calendar that covers every dated sale of ``sales``."""
    return dim_date(sales.sparkSession, *date_span(sales))


def dim_date(spark: SparkSession, start: dt.date | None = None,
             end: dt.date | None = None) -> DataFrame:
    """One row per day of the years of ``start`` to ``end``; none without dates.

    day_of_week: 0 = Sunday .. 6 = Saturday; week_number is the ISO week.
    """
    known = start is not None and end is not None
    start, end = (dt.date(start.year, 1, 1), dt.date(end.year, 12, 31)) if known else (
        dt.date(1970, 1, 1), dt.date(1969, 12, 31))
    n_days = (end - start).days + 1
    d = F.col("full_date")
    dow = F.dayofweek(d) - 1
    holiday = F.lit(False)
    for m, day in C.HOLIDAYS:
        holiday = holiday | ((F.month(d) == m) & (F.dayofmonth(d) == day))
    return (spark.range(0, n_days)
            .select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("full_date"))
            .select(
                date_key(d).alias("date_key"),
                d,
                F.year(d).alias("year_number"),
                F.month(d).alias("month_number"),
                F.date_format(d, "MMMM").alias("month_name"),
                F.quarter(d).alias("quarter_number"),
                dow.alias("day_of_week"),
                dow.isin(0, 6).alias("is_weekend"),
                F.weekofyear(d).alias("week_number"),
                F.date_format(d, "EEEE").alias("day_name"),
                holiday.alias("is_holiday"),
            ))
