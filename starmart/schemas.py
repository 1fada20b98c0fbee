"""Warehouse table schemas (fixed DDL; nothing is inferred)."""

from __future__ import annotations

from pyspark.sql.types import (BooleanType, DateType, DecimalType, IntegerType, LongType,
                               StringType, StructField, StructType, TimestampType)

_S, _L, _D, _B = StringType(), LongType(), DateType(), BooleanType()
AMOUNT = DecimalType(10, 2)


def _f(name, t, nullable=True):
    return StructField(name, t, nullable)


DIM_CUSTOMER = StructType([
    _f("customer_key", _L), _f("customer_business_key", _L), _f("first_name", _S),
    _f("last_name", _S), _f("email", _S), _f("gender", _S), _f("country", _S), _f("city", _S),
    _f("birth_date", _D), _f("valid_from", _D), _f("valid_to", _D), _f("is_current", _B)])

DIM_PRODUCT = StructType([
    _f("product_key", _L), _f("product_business_key", _L), _f("product_name", _S),
    _f("brand", _S), _f("category", _S), _f("subcategory", _S), _f("catalog_price", AMOUNT),
    _f("valid_from", _D), _f("valid_to", _D), _f("is_current", _B)])

DIM_STORE = StructType([
    _f("store_key", _L), _f("store_business_key", _L), _f("store_name", _S), _f("city", _S),
    _f("country", _S), _f("region", _S), _f("store_type", _S), _f("opening_date", _D)])

FACT_SALES = StructType([
    _f("sales_key", _L), _f("date_key", IntegerType()), _f("customer_key", _L),
    _f("store_key", _L), _f("product_key", _L), _f("transaction_id", _L), _f("quantity", _L),
    _f("unit_price", AMOUNT), _f("total_amount", AMOUNT), _f("discount_amount", AMOUNT)])

ETL_RUNS = StructType([
    _f("run_id", _L), _f("kind", _S), _f("status", _S), _f("error_message", _S),
    _f("at", TimestampType())])

ETL_EVENTS = StructType([
    _f("run_id", _L), _f("step", _S), _f("level", _S), _f("message", _S),
    _f("created_at", TimestampType())])

ETL_METRICS = StructType([
    _f("run_id", _L), _f("metric_name", _S), _f("metric_value", DecimalType(20, 2)),
    _f("created_at", TimestampType())])
