"""Balanced contiguous shards from byte-size prefix sums (operator 1).

Documents are put in ``doc_id`` order by a range partitioning. Each range
adds up its own sizes; the totals of the ranges give every document's global
byte position, and the shard is where the middle of the document falls among
equal targets. Only (doc_id, size, checksum) is shuffled, never the text.

Defined cases: a null text has size 16 and the checksum of the empty string;
null ids come first; repeated ids stand together, in order of size and
checksum; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prefix_offsets, prepare, staged

#: Bytes counted for each document besides its text.
ROW_BYTES = 16


def _running(batches):
    """Position and byte prefix of each row inside its range partition."""
    pid, at, done = TaskContext.get().partitionId(), 0, 0
    for b in batches:
        size = b.column("size").to_numpy(zero_copy_only=False).astype(np.int64)
        ends = done + np.cumsum(size)
        n = len(size)
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("size"), b.column("text_crc32"),
             pa.array(np.full(n, pid, np.int32)), pa.array(np.arange(at, at + n)),
             pa.array(ends - size)],
            names=["doc_id", "size", "text_crc32", "pid", "idx", "bytes"])
        at, done = at + n, int(ends[-1]) if n else done


def shard_by_bytes(docs: DataFrame, n_shards: int = 40, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row.

    Law ``bytes``: with ``total`` bytes in all, a document that starts at byte
    ``s`` goes to shard ``floor((s + size / 2) * n_shards / total)``, so shard
    sizes differ from the target by less than one document at either end.
    """
    prepare(docs.sparkSession, batch_rows=10_000)
    text = F.coalesce(F.col(text_col), F.lit(""))
    sized = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    order = [F.col("doc_id").asc_nulls_first(), "size", "text_crc32"]
    placed = staged(
        sized.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
            _running, "doc_id long, size long, text_crc32 long, pid int, idx long, bytes long"),
        "shard")
    totals = (placed.groupBy("pid").agg(F.count(F.lit(1)).alias("rows"),
                                        F.sum("size").alias("size")))
    offsets = prefix_offsets(totals, "pid", "rows", "size").persist()
    total = placed.agg(F.sum("size")).first()[0] or 1
    # Integer arithmetic; decimals keep the product exact at any corpus size.
    twice_middle = (2 * (F.col("bytes") + F.col("size_before")) + F.col("size")).cast("decimal(38,0)")
    shard = F.least(F.lit(n_shards - 1), F.floor(
        twice_middle * n_shards / F.lit(2 * total)).cast("int"))
    cut = (placed.join(F.broadcast(offsets), "pid")
           .withColumn("row", F.col("idx") + F.col("rows_before"))
           .withColumn("shard", shard))
    first = cut.groupBy("shard").agg(F.min("row").alias("first_row"))
    return (cut.join(F.broadcast(first), "shard")
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("row") - F.col("first_row")).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
