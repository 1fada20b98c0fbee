"""The corpus pipeline: quality, toxicity, near-duplicates, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor
kept and calls one operator of ``starmart.llm``. All stages but the last
return the columns of ``documents``; each result is written as Parquet and
read again as the next stage's input, so a lost executor costs no more than
the stage that runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starmart.llm import decontaminate, minhash, packing, quality, toxicity
from starmart.llm.common import staged, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio."""
    return quality.quality_filter(docs, table(spark, sf_dir, "labels"))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose clauses score below one half."""
    return toxicity.toxicity_filter(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of 5-word shingle sets that share 0.8 or more."""
    return minhash.one_of_each(docs, k=5, num=80, den=100, bands=48, rows=6)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences for training: pieces of power-of-two lengths with their ids."""
    return packing.pack_binary(docs)


STAGES = [("quality", quality_rules), ("toxicity", toxicity_filter),
          ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("packing", pack)]

#: Hashed models and token ids have no SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
