"""Point-in-time lookups, fact resolution, conflict-ignoring append.

Join strategy: no side is hinted; every dimension is joined on its key and
left to Catalyst + AQE, which broadcast a side only when its measured size is under
the threshold and otherwise sort-merge, splitting skewed keys
(``spark.sql.adaptive.skewJoin.enabled``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..session import checkpoint_dir
from .asof import as_of
from .ranking import assign_keys

# Order used to keep one row of a duplicate group: all remaining fact columns.
FACT_ORDER = ["date_key", "customer_key", "store_key", "quantity", "unit_price",
              "total_amount", "discount_amount", "product_key", "product_business_key",
              "transaction_date"]
FACT_OUT = [c for c in C.FACT_COLUMNS if c != "sales_key"]


def pit_lookup(rows: DataFrame, dim: DataFrame, *, bk: str, key: str,
               date_col: str = "transaction_date") -> DataFrame:
    """Attach the version of ``dim`` valid on ``date_col`` (inner join).

    ``bk`` names the business key in both frames. Ranges are closed at both
    ends; an open version runs to 9999-12-31. An equi-join on the business key
    with one row of sorted versions for each key, searched for the date (``asof``):
    a key's many versions never meet its sales in pairs, and a key with a
    third of all sales is split across tasks by AQE's skew handling.
    """
    return as_of(rows, dim, bk=bk, key=key, date_col=date_col)


@dataclass
class SaleParts:
    """Staged sales before the join of their lines with what a transaction's lines share.

    ``headers``: transaction_id, transaction_date, customer_business_key. ``lines``: the
    other columns; ``amounts`` turns their raw numbers into quantity and money. The sales
    are the inner join by transaction, also where transactions repeat.
    """
    lines: DataFrame
    headers: DataFrame
    amounts: Callable[[DataFrame], DataFrame]

    def filter(self, condition: Column) -> "SaleParts":
        """The sales whose transactions meet a condition on the headers."""
        return SaleParts(self.lines, self.headers.filter(condition), self.amounts)

    def join(self, transactions: DataFrame, on: str, how: str) -> "SaleParts":
        """The sales whose transactions are (not) in a list; ``how``: left_semi or left_anti."""
        return SaleParts(self.lines, self.headers.join(transactions, on, how), self.amounts)

    def but(self, existing: DataFrame, keys: list[str]) -> "SaleParts":
        """The sales whose ``keys``, columns of the lines, are not in ``existing``."""
        return SaleParts(self.lines.join(existing, keys, "left_anti"), self.headers, self.amounts)


def resolve_sales(staged_sales: DataFrame | SaleParts, dim_date: DataFrame, dim_store: DataFrame,
                  dim_customer: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Resolve the four keys of staged sales. Unmatched rows drop out (W17 reports them).

    Of ``SaleParts`` the headers meet the calendar and the customers, so that only they
    are shuffled for these; the lines follow with raw numbers as far as the last lookup.
    """
    cal = dim_date.select(F.col("full_date").alias("transaction_date"), "date_key")
    stores = dim_store.select("store_business_key", "store_key")
    if isinstance(staged_sales, SaleParts):
        heads = pit_lookup(staged_sales.headers.join(cal, "transaction_date", "inner"),
                           dim_customer, bk="customer_business_key", key="customer_key")
        rows = staged_sales.lines.join(heads, "transaction_id", "inner").join(
            stores, "store_business_key", "inner")
    else:
        rows = staged_sales.join(cal, "transaction_date", "inner").join(
            stores, "store_business_key", "inner")
        rows = pit_lookup(rows, dim_customer, bk="customer_business_key", key="customer_key")
    rows = pit_lookup(rows, dim_product, bk="product_business_key", key="product_key")
    if isinstance(staged_sales, SaleParts):
        rows = staged_sales.amounts(rows)
    return rows.select(*FACT_OUT, "product_business_key", "transaction_date")


def conflict_columns(mode: str) -> list[str]:
    if mode == "reference":
        return ["transaction_id", "product_key"]
    if mode == "business":
        return ["transaction_id", "product_business_key"]
    raise ValueError(f"unknown conflict mode {mode!r}")


def dedupe_batch(batch: DataFrame, keys: list[str]) -> DataFrame:
    """One row per conflict key: the smallest by the remaining fact columns.

    A ``min(struct)`` aggregate, so a duplicate group holding a third of the
    batch is reduced map-side before the shuffle. ``_met``: how many rows had the key (a
    batch that was reduced in part brings its own).
    """
    rest = [c for c in FACT_ORDER if c not in keys]
    best = F.min(F.struct(*[F.col(c) for c in rest])).alias("_b")
    met = F.sum("_met") if "_met" in batch.columns else F.count(F.lit(1))
    return batch.groupBy(*keys).agg(best, met.alias("_met")).select(
        *keys, *[F.col(f"_b.{c}").alias(c) for c in rest], "_met")


#: Rows of a transaction up to which its duplicates may meet in one task.
NEAR_ROWS = 1000


def far_transactions(sales: DataFrame | SaleParts, dim_date: DataFrame) -> DataFrame:
    """Transactions whose duplicates the fact's order may keep apart, or that have very many rows.

    Duplicates of one day are neighbours in (date, product, transaction) order. Those of a
    transaction with several days, or without a number, are not.
    """
    def counted(rows: DataFrame) -> DataFrame:
        days = [F.min("date_key").alias("_lo"), F.max("date_key").alias("_hi")] if (
            "date_key" in rows.columns) else []
        per = rows.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("_n"), *days)
        far = (F.col("_n") > NEAR_ROWS) | F.col("transaction_id").isNull()
        if days:
            far |= F.col("_lo") < F.col("_hi")
        return per.filter(far).select("transaction_id")

    cal = dim_date.select(F.col("full_date").alias("transaction_date"), "date_key")
    if not isinstance(sales, SaleParts):
        return counted(sales.select("transaction_id", "transaction_date").join(
            cal, "transaction_date").drop("transaction_date"))
    return counted(sales.headers.select("transaction_id", "transaction_date").join(
        cal, "transaction_date").drop("transaction_date")).union(
        counted(sales.lines.select("transaction_id"))).filter("transaction_id is not null").distinct()


def resolve_for_order(sales: DataFrame | SaleParts, dim_date: DataFrame, dim_store: DataFrame,
                      dim_customer: DataFrame, dim_product: DataFrame, mode: str) -> DataFrame:
    """W13 + W14 of a first load, up to the fact's order: resolved sales with ``_met``.

    Every conflict key with more than one row has them side by side in that order, few
    enough for one task, where ``dedupe_in_order`` takes one: the batch is not shuffled for
    its duplicates. Far transactions are reduced here, map-side first.
    """
    dims = (dim_date, dim_store, dim_customer, dim_product)
    checkpoint_dir(dim_date.sparkSession)
    far = far_transactions(sales, dim_date).checkpoint(eager=True)
    one = F.lit(1).cast("long").alias("_met")
    if far.isEmpty():
        return resolve_sales(sales, *dims).select("*", one)
    if isinstance(sales, SaleParts):
        near, apart = (sales.join(far, "transaction_id", how) for how in ("left_anti", "left_semi"))
    else:
        far = far.withColumnRenamed("transaction_id", "_far")
        same = F.col("transaction_id").eqNullSafe(F.col("_far"))
        near, apart = (sales.join(far, same, how) for how in ("left_anti", "left_semi"))
    return resolve_sales(near, *dims).select("*", one).unionByName(
        dedupe_batch(resolve_sales(apart, *dims), conflict_columns(mode)))


def dedupe_in_order(ranged: DataFrame, mode: str) -> DataFrame:
    """W14 inside the range partitions of ``SALES_KEY_ORDER``, which no key spans."""
    return dedupe_batch(ranged, list(dict.fromkeys([*SALES_KEY_ORDER, *conflict_columns(mode)])))


def existing_conflict_keys(fact: DataFrame, dim_product: DataFrame, mode: str) -> DataFrame:
    """Conflict keys already in the fact; only two columns of the fact are read."""
    if mode == "reference":
        return fact.select("transaction_id", "product_key")
    return (fact.select("transaction_id", "product_key")
            .join(dim_product.select("product_key", "product_business_key"), "product_key")
            .select("transaction_id", "product_business_key"))


def conflict_ignoring_append(batch: DataFrame, existing: DataFrame | None,
                             mode: str = "reference") -> DataFrame:
    """Rows of ``batch`` whose conflict key is neither in ``existing`` nor repeated.

    ``existing`` holds the conflict keys already loaded (None for none).

    mode "reference": key (transaction_id, product_key), as the reference's
    unique constraint; "business": (transaction_id, product_business_key),
    which stays idempotent across dimension changes.
    """
    keys = conflict_columns(mode)
    fresh = dedupe_batch(batch, keys).drop("_met")
    if existing is None:
        return fresh
    return fresh.join(existing, keys, "left_anti")


def conflict_marked(batch: DataFrame, existing: DataFrame | None, mode: str) -> DataFrame:
    """W14 for a writer: every conflict key of the batch with ``_met`` and whether it is ``_known``.

    A known key is a stub of its place in the fact's order, so that the rows of the batch can be
    counted where the new ones are written: above the last shuffle, where a lost executor
    cannot make Spark count a row twice.
    """
    keys = conflict_columns(mode)
    met = dedupe_batch(batch, keys)
    if existing is None:
        return met.withColumn("_known", F.lit(False))
    old = existing.distinct().withColumn("_known", F.lit(True))
    met = met.join(old, keys, "left").withColumn("_known", F.coalesce("_known", F.lit(False)))
    stay = [*SALES_KEY_ORDER, "_met", "_known"]
    return met.select(*[c if c in stay else F.when(~F.col("_known"), F.col(c)).alias(c)
                        for c in met.columns])


SALES_KEY_ORDER = ["date_key", "product_key", "transaction_id"]


def with_sales_keys(rows: DataFrame, after: int, settle=None) -> DataFrame:
    """W09 on the fact: dense sales_key after the current maximum.

    Numbered in (date, product, transaction) order, which is also the
    fact's storage order (W25), so numbering and layout share one range
    shuffle. ``settle`` as in ``ranking.placed``.
    """
    keyed, _ = assign_keys(rows, [F.col(c) for c in SALES_KEY_ORDER], "sales_key", after,
                           settle=settle)
    return keyed.select(*C.FACT_COLUMNS, "transaction_date")
