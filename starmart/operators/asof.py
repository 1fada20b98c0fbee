"""As-of lookups by binary search in a key's sorted versions.

A key's live versions start on different days (a batch closes what it replaces),
so they are at most one row for each day however many rows the key has elsewhere.
They become one sorted array beside the key; rows meet that one array in a
plain equi-join and find the last version that starts on or before their day by
doubling steps. No pair of a row and a version is formed: a key with ten years of daily
versions costs its sales twelve comparisons each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.dates import lit_date


def descending_powers(size: Column) -> Column:
    """Powers of two, the largest not above ``size`` first."""
    top = F.floor(F.log2(F.greatest(size, F.lit(1)))).cast("int")
    return F.transform(F.sequence(top, F.lit(0), F.lit(-1)), lambda k: F.pow(F.lit(2), k).cast("int"))


def count_until(ordered: Column, steps: Column, is_after) -> Column:
    """How many leading elements of a sorted array are not after the sought place.

    ``is_after(element)`` is false up to some element and true from then on; ``steps``
    are ``descending_powers`` of the array's size.
    """
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        ~is_after(F.get(ordered, at + step - 1)), at + step).otherwise(at))


def live_versions(dim: DataFrame, bk: str) -> DataFrame:
    """Versions that hold at least a day: ``_bk``, ``_from``, ``_to`` (open ones to 9999-12-31)
    and the dimension's columns."""
    return dim.withColumns({
        "_bk": F.col(bk), "_from": F.col("valid_from"),
        "_to": F.coalesce("valid_to", lit_date(C.OPEN_VALID_TO))}).filter(
        F.col("valid_from") <= F.coalesce("valid_to", lit_date(C.OPEN_VALID_TO)))


def version_arrays(dim: DataFrame, bk: str, key: str) -> DataFrame:
    """One row for each business key: its live versions by start, and the search steps.

    Of versions that start on one day (only a damaged dimension has two) the one that
    lasts longest is taken, then the highest key: partial aggregates keep an array within
    the number of days.
    """
    per_day = live_versions(dim, bk).groupBy("_bk", "_from").agg(
        F.max(F.struct("_to", F.col(key).alias("_key"))).alias("_v"))
    arrays = per_day.groupBy("_bk").agg(F.sort_array(F.collect_list(F.struct(
        "_from", F.col("_v._to").alias("_to"), F.col("_v._key").alias("_key")))).alias("_versions"))
    return arrays.withColumn("_steps", descending_powers(F.size("_versions")))


def as_of(rows: DataFrame, dim: DataFrame, *, bk: str, key: str, date_col: str) -> DataFrame:
    """``rows`` with the ``key`` of the version of ``dim`` valid on ``date_col`` (inner).

    Without overlaps (W16 reports them) that is the only valid one.
    """
    arrays = version_arrays(dim, bk, key)
    versions, day = F.col("_versions"), F.col(date_col)
    found = F.get(versions, count_until(versions, F.col("_steps"), lambda v: v["_from"] > day) - 1)
    met = rows.join(arrays, rows[bk] == arrays["_bk"], "inner")
    # Exploding the one match or none: the search is evaluated once.
    return met.select(*rows.columns, F.explode(F.filter(
        F.array(found), lambda v: v["_to"] >= day)).alias("_found")).select(
        *rows.columns, F.col("_found._key").alias(key))


def covered(rows: DataFrame, dim: DataFrame, *, bk: str, date_col: str, flag: str) -> DataFrame:
    """``rows`` with ``flag``: true where some version is valid on ``date_col``, else null.

    Right for overlapping versions too: a day is covered if more of the key's versions
    have begun by then than had ended before.
    """
    days = live_versions(dim, bk).groupBy("_bk", "_from").agg(F.max("_to").alias("_to"))
    arrays = days.groupBy("_bk").agg(
        F.sort_array(F.collect_list("_from")).alias("_starts"),
        F.sort_array(F.collect_list("_to")).alias("_ends")).withColumn(
        "_steps", descending_powers(F.size("_starts")))
    day = F.col(date_col)
    begun = count_until(F.col("_starts"), F.col("_steps"), lambda d: d > day)
    ended = count_until(F.col("_ends"), F.col("_steps"), lambda d: d >= day)
    met = rows.join(arrays, rows[bk] == arrays["_bk"], "left")
    return met.select(*rows.columns, F.when(begun > ended, F.lit(True)).alias(flag))
