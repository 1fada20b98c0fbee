"""Declared constraints re-aimed as table jobs that report violations.

Every check is a filter, an aggregate or an anti-join tagged with a reason
and unioned; nothing is collected. Output: (source, reason, record_key, n).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from .asof import covered, live_versions
from .ranking import running

REPORT_COLS = ["source", "reason", "record_key", "n"]


def _tag(df: DataFrame, source: str, reason: str, key: F.Column, n: F.Column | None = None):
    return df.select(F.lit(source).alias("source"), F.lit(reason).alias("reason"),
                     key.cast("string").alias("record_key"),
                     (n if n is not None else F.lit(1)).cast("long").alias("n"))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _key_text(*cols: str) -> F.Column:
    return F.concat_ws("|", *[F.col(c).cast("string") for c in cols])


def _duplicates(df: DataFrame, source: str, reason: str, keys: list[str]) -> DataFrame:
    """Keys present more than once (a partial aggregate: hot keys are combined map-side)."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return _tag(g, source, reason, _key_text(*keys), F.col("_n"))


def _overlaps(dim: DataFrame, source: str, bk: str, key: str) -> DataFrame:
    """Versions of one key whose (non-empty) validity intervals overlap.

    Each version is compared with the latest end among the versions that
    start before it: a running maximum that spans partitions, so neither pairs
    are formed nor the versions of one key brought into one task. Versions equal in
    start and key are told apart by their count: all but the first overlap it.
    """
    v = live_versions(dim, bk).groupBy(bk, "_from", key).agg(
        F.max("_to").alias("_end"), F.count(F.lit(1)).alias("_copies"))
    run = running(v, bk, [F.col("_from"), F.col(key)], F.col("_end"), "_prev_end", F.max,
                  inclusive=False)
    extra = F.col("_copies") - F.when(F.col("_from") <= F.col("_prev_end"), 0).otherwise(1)
    hit = run.withColumn("_hits", extra).filter("_hits > 0")
    return _tag(hit.select("*", F.explode(F.array_repeat(F.lit(1), F.col("_hits").cast("int")))),
                source, "overlapping_versions", _key_text(bk, key))


def uniqueness_report(tables: dict[str, DataFrame], staged_sales: DataFrame | None = None,
                      ) -> DataFrame:
    """One current row per business key, unique store key, unique
    (transaction_id, product_key), no overlapping versions; optionally the
    staged batch's repeated (transaction_id, product_business_key)."""
    cust, prod = tables["dim_customer"], tables["dim_product"]
    frames = [
        _duplicates(cust.filter("is_current"), "dim_customer", "two_current_rows",
                    ["customer_business_key"]),
        _duplicates(prod.filter("is_current"), "dim_product", "two_current_rows",
                    ["product_business_key"]),
        _duplicates(tables["dim_store"], "dim_store", "duplicate_business_key",
                    ["store_business_key"]),
        _duplicates(tables["fact_sales"], "fact_sales", "duplicate_conflict_key",
                    ["transaction_id", "product_key"]),
        _overlaps(cust, "dim_customer", "customer_business_key", "customer_key"),
        _overlaps(prod, "dim_product", "product_business_key", "product_key"),
    ]
    if staged_sales is not None:
        frames.append(_duplicates(staged_sales, "sales", "duplicate_in_batch",
                                  ["transaction_id", "product_business_key"]))
    return _union(frames)


SALE_KEY = ("transaction_id", "product_business_key", "store_business_key")
NOT_NULL = C.SALES_NOT_NULL


def reject_report(staged, tables: dict[str, DataFrame]) -> DataFrame:
    """Staged sales that the fact load would drop or that break NOT NULL,
    and staged dimension text over its declared length.

    Sales are read once: left joins tag each sale with what it found (the
    calendar; whether a key's versions cover the date, from one row of sorted days
    for each key), and the list of failed checks is exploded, one row per reason.
    """
    cal = tables["dim_date"].select(F.col("full_date").alias("transaction_date"),
                                    F.lit(True).alias("_date_ok"))
    # Only which required values are missing goes through the joins, not the values.
    missing = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(f"null_{c}")) for c in NOT_NULL]),
                       lambda x: x.isNotNull())
    s = staged.sales.select(*SALE_KEY, "customer_business_key", "transaction_date", F.when(
        F.size(missing) > 0, missing).alias("_missing")).join(cal, "transaction_date", "left")
    s = s.join(tables["dim_store"].select("store_business_key", F.lit(True).alias("_store_ok")),
               "store_business_key", "left")
    s = covered(s, tables["dim_customer"], bk="customer_business_key",
                date_col="transaction_date", flag="_customer_ok")
    s = covered(s, tables["dim_product"], bk="product_business_key",
                date_col="transaction_date", flag="_product_ok")
    checks = [(F.col("_date_ok").isNull(), "date_not_found"),
              (F.col("_store_ok").isNull(), "store_not_found"),
              (F.col("_customer_ok").isNull(), "customer_not_found"),
              (F.col("_product_ok").isNull(), "product_not_found")]
    reasons = F.concat(
        F.filter(F.array(*[F.when(cond, F.lit(r)) for cond, r in checks]), lambda x: x.isNotNull()),
        F.coalesce("_missing", F.array().cast("array<string>")))
    frames = [s.select(F.lit("sales").alias("source"), F.explode(reasons).alias("reason"),
                       _key_text(*SALE_KEY).alias("record_key"),
                       F.lit(1).cast("long").alias("n"))]
    for source, frame, bk in (("customers", staged.customers, "customer_business_key"),
                              ("stores", staged.stores, "store_business_key"),
                              ("products", staged.products, "product_business_key")):
        dim_checks = [(F.col(bk).isNull(), "null_business_key"),
                      *[(F.length(c) > n, f"too_long_{c}")
                        for c, n in C.VARCHAR_LIMITS[source].items()]]
        failed = F.filter(F.array(*[F.when(cond, F.lit(r)) for cond, r in dim_checks]),
                          lambda x: x.isNotNull())
        frames.append(frame.select(F.lit(source).alias("source"),
                                   F.explode(failed).alias("reason"),
                                   F.col(bk).cast("string").alias("record_key"),
                                   F.lit(1).cast("long").alias("n")))
    return _union(frames)
