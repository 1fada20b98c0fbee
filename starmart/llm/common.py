"""Small helpers shared by the text operators.

``staged`` cuts lineage with a table written once to the shared checkpoint
folder, so that every executor can read it after another one is lost.
"""

from __future__ import annotations

import ctypes
import re
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.session import scratch_path

#: The six ASCII white-space characters that separate words.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")

#: Rows in one Arrow batch handed to Python. Batches bound a worker's memory:
#: a batch of ordinary documents is a few MB, and one long text is held alone
#: by its own row in any case.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession, batch_rows: int = BATCH_ROWS) -> None:
    """Small Arrow batches, and this package on the path of local Python workers.

    A cluster gets the package with the job; a path it lacks does no harm.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch_rows))
    root = str(Path(__file__).resolve().parents[2])
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def staged(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once under the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Return a Python worker's freed memory to the system at the end of a task.

    Idle workers stay beside the executor while stages without Python run.
    """
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text) if text else []


def let(value, body):
    """``body(value)`` with ``value`` evaluated once per row.

    A column used inside a lambda would be evaluated again for each element;
    a lambda's own variable is not.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def prefix_offsets(totals: DataFrame, key: str, *weights: str) -> DataFrame:
    """Exclusive prefix sums of ``weights`` in the order of ``key``.

    ``totals`` has one row for each range partition, so the few numbers that
    pass through the driver grow with the partitions and not with the rows.
    """
    spark, running, out = totals.sparkSession, [0] * len(weights), []
    for row in sorted(totals.select(key, *weights).collect(), key=lambda r: r[0]):
        out.append((row[0], *running))
        running = [a + row[i + 1] for i, a in enumerate(running)]
    schema = f"{key} int, " + ", ".join(f"{w}_before long" for w in weights)
    return spark.createDataFrame(out, schema)
