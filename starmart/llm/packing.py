"""Power-of-two packing (operator 9).

Each document's ids, closed by an end id, are cut into pieces whose lengths
are powers of two: as many of ``max_len`` as fit, then the binary digits of
the rest, longest first. Pieces of equal length share a bucket, and a piece
is a whole sequence of its bucket, so no sequence crosses documents and none
is padded. Nothing is shuffled: a sequence's number is the writing task's
number and the row's place in it, as unique as a partition and a row are.

Defined cases: a null or empty text has the end id alone; repeated rows and
null ids are documents of their own; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BATCH_ROWS, give_back, prepare
from .tokens import LARGE_STORE, STORE, default_tokenizer, encoder, release

PIECES = ("doc_id long, start long, length long, bucket int, doc_tokens long, ids binary, "
          "sequence_id long, offset long")


def binary_lengths(n: int, max_len: int) -> list[int]:
    """``n`` as full lengths and then descending powers of two."""
    rest = n % max_len
    return [max_len] * (n // max_len) + [
        1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def _pieces(path: str, end_id: int, max_len: int, store: int):
    def run(batches):
        enc, number = encoder(path, store), TaskContext.get().partitionId() << 33
        for b in batches:
            rows = []
            ids_of = enc.batch(b.column("text").to_pylist())
            for doc_id, ids in zip(b.column("doc_id").to_pylist(), ids_of):
                raw = np.append(ids, end_id).astype("<u4").tobytes()
                n, start = len(ids) + 1, 0
                for length in binary_lengths(n, max_len):
                    rows.append((doc_id, start, length, length.bit_length() - 1, n,
                                 raw[4 * start:4 * (start + length)], number, 0))
                    start, number = start + length, number + 1
            long, cols = pa.int64(), list(zip(*rows)) or [()] * 8
            kinds = (long, long, long, pa.int32(), long, pa.binary(), long, long)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)],
                names=["doc_id", "start", "length", "bucket", "doc_tokens", "ids",
                       "sequence_id", "offset"])
        if store <= STORE:  # other stages use this worker next
            del enc
            release(path)
            give_back()
    return run


def pack_binary(docs: DataFrame, tokenizer: str | None = None, end_id: int = 1,
                max_len: int = 2048, id_col: str = "doc_id",
                text_col: str = "text", store: int = STORE // 3) -> DataFrame:
    """One row for each piece; ``bucket`` is the binary logarithm of its length.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit integers.
    ``store``: words that a worker keeps (see ``tokens``).
    """
    if max_len < 1 or max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")
    # Larger batches where the worker has the memory to itself.
    prepare(docs.sparkSession, batch_rows=1024 if store >= LARGE_STORE else BATCH_ROWS)
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                         F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(_pieces(
        tokenizer or default_tokenizer(), end_id, max_len, store), PIECES)


def write_buckets(packed: DataFrame, path: str) -> None:
    """The sequences as files, a folder for each bucket of equal lengths."""
    packed.write.partitionBy("bucket").parquet(path)
