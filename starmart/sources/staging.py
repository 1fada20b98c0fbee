"""Typed staging tables derived from the driver tables.

Each staged frame carries ``_seq`` (row order within the batch); it decides
which of several rows for one business key comes later. On the driver
tables it is the business key, which is unique there.

No join is hinted: Catalyst broadcasts ``nation`` and ``region`` from their
measured sizes.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.money import cents_of_double, cents_to_amount, whole_div
from .raw import read

CUSTOMER_COLS = ["customer_business_key", *C.CUSTOMER_ATTRS, "_seq"]
STORE_COLS = ["store_business_key", *C.STORE_ATTRS, "_seq"]
PRODUCT_COLS = ["product_business_key", *C.PRODUCT_ATTRS, "_seq"]
SALES_COLS = ["transaction_id", "transaction_date", "customer_business_key",
              "store_business_key", "product_business_key", "quantity",
              "unit_price", "total_amount", "discount_amount"]


def _days_after(start: dt.date, days) -> F.Column:
    return F.date_add(F.lit(start), days.cast("int"))


def stage_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customers_raw from customer x nation."""
    c = read(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = read(spark, sf_dir, "nation", "n_nationkey", "n_name")
    j = c.join(n, c.c_nationkey == n.n_nationkey, "left")
    key = F.col("c_custkey")
    return j.select(
        key.alias("customer_business_key"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.concat(F.lower("c_name"), F.lit("@mail.com")).alias("email"),
        F.when(key % 2 == 0, F.lit("Male")).otherwise(F.lit("Female")).alias("gender"),
        F.col("n_name").alias("country"),
        F.concat("n_name", F.lit("_"), "c_mktsegment").alias("city"),
        _days_after(dt.date(1950, 1, 1), (key * 37) % 20000).alias("birth_date"),
        key.alias("_seq"),
    )


def stage_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """stores_raw from supplier x nation x region."""
    s = read(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey")
    n = read(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = read(spark, sf_dir, "region", "r_regionkey", "r_name")
    geo = n.join(r, n.n_regionkey == r.r_regionkey, "left")
    j = s.join(geo, s.s_nationkey == geo.n_nationkey, "left")
    key = F.col("s_suppkey")
    store_type = F.element_at(F.array(*[F.lit(t) for t in C.STORE_TYPES]),
                              (key % 3 + 1).cast("int"))
    return j.select(
        key.alias("store_business_key"),
        F.col("s_name").alias("store_name"),
        F.col("n_name").alias("city"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("region"),
        store_type.alias("store_type"),
        _days_after(dt.date(2000, 1, 1), (key * 97) % 8000).alias("opening_date"),
        key.alias("_seq"),
    )


def stage_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """products_raw from part."""
    p = read(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size",
             "p_retailprice")
    return p.select(
        F.col("p_partkey").alias("product_business_key"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category"),
        F.concat(F.lit("S"), F.col("p_size").cast("string")).alias("subcategory"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("catalog_price"),
        F.col("p_partkey").alias("_seq"),
    )


def sale_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of W04 as read: keys, and the raw numbers that ``with_amounts`` turns into money."""
    li = read(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
              "l_quantity", "l_extendedprice", "l_discount")
    return li.select(F.col("l_orderkey").alias("transaction_id"),
                     F.col("l_suppkey").alias("store_business_key"),
                     F.col("l_partkey").alias("product_business_key"),
                     "l_quantity", "l_extendedprice", "l_discount")


def sale_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the lines of W04 share in a transaction: its date and customer."""
    o = read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    return o.select(F.col("o_orderkey").alias("transaction_id"),
                    F.to_date("o_orderdate").alias("transaction_date"),
                    F.col("o_custkey").alias("customer_business_key"))


def with_amounts(lines: DataFrame) -> DataFrame:
    """Money in exact cents in place of a line's raw numbers.

    total_amount = quantity * unit_price - discount_amount, as in the
    reference's post-load update.
    """
    qty = F.col("l_quantity").cast("long")
    ext = cents_of_double(F.col("l_extendedprice"))
    pct = cents_of_double(F.col("l_discount"))
    # Whole-number division; a sale of zero pieces has no unit price (null).
    unit_c = whole_div(ext * 2 + qty, F.nullif(qty * 2, F.lit(0)))
    disc_c = whole_div(ext * pct + 50, F.lit(100))
    raw = ("l_quantity", "l_extendedprice", "l_discount")
    return lines.select(
        *[c for c in lines.columns if c not in raw],
        qty.alias("quantity"),
        cents_to_amount(unit_c).alias("unit_price"),
        cents_to_amount(qty * unit_c - disc_c).alias("total_amount"),
        cents_to_amount(disc_c).alias("discount_amount"),
    )


def stage_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sales_raw from lineitem x orders, money in exact cents."""
    met = sale_lines(spark, sf_dir).join(sale_headers(spark, sf_dir), "transaction_id", "inner")
    return with_amounts(met).select(*SALES_COLS)


# --- second batch (changes applied on top of a first load) --------------------

def customers_batch2(staged: DataFrame) -> DataFrame:
    """Customers mod 7 = 0 move (city gets ``_moved``); mod 11 = 5 are absent."""
    k = F.col("customer_business_key")
    return (staged.filter(k % 11 != 5)
            .withColumn("city", F.when(k % 7 == 0, F.concat("city", F.lit("_moved")))
                        .otherwise(F.col("city"))))


def products_batch2(staged: DataFrame) -> DataFrame:
    """Products mod 13 = 0 get catalog_price + 1.00."""
    k = F.col("product_business_key")
    return staged.withColumn(
        "catalog_price",
        F.when(k % 13 == 0, (F.col("catalog_price") + F.lit(1)).cast("decimal(10,2)"))
        .otherwise(F.col("catalog_price")))


def stores_batch2(staged: DataFrame) -> DataFrame:
    """Stores mod 5 = 0 are renamed (``_renamed`` suffix)."""
    k = F.col("store_business_key")
    return staged.withColumn(
        "store_name", F.when(k % 5 == 0, F.concat("store_name", F.lit("_renamed")))
        .otherwise(F.col("store_name")))


# --- rows that the tables must refuse, for the quality reports -------------------

def _bad_dimension(staged: DataFrame, bk: str, limits: dict[str, int], null_mod: int,
                   long_mod: int) -> DataFrame:
    """Some rows lose their business key; others get every text one character too long."""
    k = F.col(bk)
    long = {c: F.when(k % long_mod == 0, F.repeat(F.lit("x"), n + 1)).otherwise(F.col(c))
            for c, n in limits.items()}
    return staged.withColumns({**long, bk: F.when(k % null_mod == 0, F.lit(None)).otherwise(k)})


def bad_customers(staged: DataFrame) -> DataFrame:
    return _bad_dimension(staged, "customer_business_key", C.VARCHAR_LIMITS["customers"], 251, 257)


def bad_stores(staged: DataFrame) -> DataFrame:
    return _bad_dimension(staged, "store_business_key", C.VARCHAR_LIMITS["stores"], 17, 19)


def bad_products(staged: DataFrame) -> DataFrame:
    return _bad_dimension(staged, "product_business_key", C.VARCHAR_LIMITS["products"], 263, 269)


def bad_sales(staged: DataFrame) -> DataFrame:
    """Sales 40 years late, of unknown stores or products, or without a required value."""
    t = F.col("transaction_id")
    none = {c: F.when(t % m == 0, F.lit(None)).otherwise(F.col(c)) for c, m in (
        ("transaction_id", 229), ("quantity", 233), ("unit_price", 239), ("total_amount", 241))}
    return staged.withColumns({
        "transaction_date": F.when(t % 211 == 0, F.add_months("transaction_date", 480))
        .otherwise(F.col("transaction_date")),
        "store_business_key": F.when(t % 223 == 0, F.col("store_business_key") + 10_000_000)
        .otherwise(F.col("store_business_key")),
        "product_business_key": F.when(t % 227 == 0, F.col("product_business_key") + 10_000_000)
        .otherwise(F.col("product_business_key")),
        **none})


def customer_moves(spark: SparkSession, sf_dir: str, customers: DataFrame) -> DataFrame:
    """Several staged rows for a customer: one for each order, which moves them."""
    o = read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderpriority")
    return (customers.drop("_seq").join(o, F.col("customer_business_key") == F.col("o_custkey"))
            .withColumn("city", F.concat("country", F.lit("_"), "o_orderpriority"))
            .withColumn("_seq", F.col("o_orderkey")).drop("o_orderkey", "o_custkey",
                                                          "o_orderpriority"))
