"""Readers for the driver tables (one Parquet file or folder per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Read one table; selecting ``cols`` here keeps the scan's ReadSchema narrow."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df
