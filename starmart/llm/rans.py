"""Token-id files by a static range asymmetric numeral system (operator 7).

One frequency table, counted over all ids and shared by every file, drives
independent blocks. A block holds up to ``LANES * STEPS`` ids dealt over
interleaved lanes that feed one word stream. Its checkpoint (the lanes'
states and its first word in the stream) lets any block be decoded alone, so
all blocks of a batch are decoded together, and a checksum of its ids guards it.

Jobs: ids are made once and written with their ``doc_id`` range; the table is
counted from what was written; the ranges are brought together, sorted and
encoded in one pass; the files are read back without another shuffle. A row of
a file is a run of whole documents with the blocks of their ids.

Defined cases: a null or empty text has the end id alone; null ids come
first; repeated ids are separate documents that stand together; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.session import default_parallelism, scratch_path

from .common import prefix_offsets, prepare, staged
from .tokens import LARGE_STORE, default_tokenizer, encoder

LANES, STEPS = 64, 128
BLOCK = LANES * STEPS
#: Binary digits of the table's total, and the least state of a lane.
BITS, LEAST = 20, 1 << 31
#: Ids after which a run of documents is closed, and blocks coded at once.
RUN_IDS, BLOCKS_AT_ONCE = 1 << 18, 256
#: Documents that one range is meant to hold.
RANGE_DOCS = 1 << 14

IDS = "pid int, doc_id long, n_tokens long, ids binary"
READ = "pid int, before long, doc_id long, n_tokens long, ids binary"
FILE = ("pid int, before long, doc_ids array<long>, lengths array<long>, words binary, "
        "word_counts array<int>, states binary, checksums array<long>")


# The shared table -----------------------------------------------------------

def scaled_table(counts: np.ndarray) -> np.ndarray:
    """Frequencies of at least 1 that add up to ``2 ** BITS``, in proportion."""
    total, n = 1 << BITS, len(counts)
    counts = counts.astype(np.float64) + 1e-9
    freq = 1 + np.floor(counts / counts.sum() * (total - n)).astype(np.int64)
    freq[int(np.argmax(freq))] += total - int(freq.sum())
    return freq


class Coder:
    """Codes whole arrays of blocks; the symbol ``n`` is padding and costs nothing."""

    def __init__(self, freq: np.ndarray):
        self.n = len(freq)
        self.freq = np.append(freq, 1 << BITS).astype(np.uint64)
        self.start = np.append(np.cumsum(freq) - freq, 0).astype(np.uint64)
        self.symbol = np.repeat(np.arange(self.n, dtype=np.uint32), freq)

    def encode(self, ids: np.ndarray) -> tuple[list[bytes], np.ndarray]:
        """The words and the lanes' states of each block of ``ids``."""
        blocks = -(-len(ids) // BLOCK)
        sym = np.full(blocks * BLOCK, self.n, np.uint32)
        sym[:len(ids)] = ids
        sym = sym.reshape(blocks, STEPS, LANES)
        x = np.full((blocks, LANES), LEAST, np.uint64)
        out = np.zeros((blocks, STEPS, LANES), np.uint32)
        sent = np.zeros((blocks, STEPS, LANES), bool)
        bits, word, room = np.uint64(BITS), np.uint64(32), np.uint64(63 - BITS)
        for t in range(STEPS - 1, -1, -1):
            s = sym[:, t]
            f = self.freq[s]
            full = x >= f << room
            sent[:, t], out[:, t] = full, x
            np.right_shift(x, word, out=x, where=full)
            q = x // f
            x -= q * f
            x += q << bits
            x += self.start[s]
        return [out[b][sent[b]].astype("<u4").tobytes() for b in range(blocks)], x

    def decode(self, words: np.ndarray, first: np.ndarray, states: np.ndarray) -> np.ndarray:
        """Ids of each block (padding included) from its own checkpoint."""
        x, at = states.copy(), first.astype(np.int64)
        flat = x.reshape(-1)
        words = np.append(words, np.zeros(LANES, words.dtype)).astype(np.uint64)
        out = np.empty((len(x), STEPS, LANES), np.uint32)
        low, bits, word = np.uint64((1 << BITS) - 1), np.uint64(BITS), np.uint64(32)
        for t in range(STEPS):
            slot = x & low
            s = self.symbol[slot]
            out[:, t] = s
            slot -= self.start[s]
            x >>= bits
            x *= self.freq[s]
            x += slot
            # Lanes that ran low take the block's next words in turn. Padding may
            # ask for words past the end; what it reads is never used.
            need = np.flatnonzero(flat < LEAST)
            taken = np.bincount(need // LANES, minlength=len(x))
            place = np.repeat(at - (np.cumsum(taken) - taken), taken)
            place += np.arange(len(need))
            flat[need] = (flat[need] << word) | words[np.minimum(place, len(words) - 1)]
            at += taken
        return out.reshape(len(x), BLOCK)


# Ids in ranges of doc_id ----------------------------------------------------

def _tokenise(path: str, end_id: int, bounds: list[int]):
    """Ids of each text with the range it belongs to; a hot id is dealt over its ranges."""
    edges = np.array(bounds, np.int64)

    def run(batches):
        enc, turn = encoder(path, LARGE_STORE), 0
        kind = "<u2" if max(enc.size, end_id + 1) <= 65536 else "<u4"
        end = np.array([end_id], kind).tobytes()
        for b in batches:
            ids = [x.astype(kind, copy=False).tobytes() + end
                   for x in enc.batch(b.column("text").to_pylist())]
            known = b.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            d = b.column("doc_id").fill_null(0).to_numpy()
            low = np.where(known, np.searchsorted(edges, d, "left"), 0)
            high = np.where(known, np.searchsorted(edges, d, "right"), 0)
            pids = low + (turn + np.arange(len(ids))) % (high - low + 1)
            turn += len(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pids.astype(np.int32)), b.column("doc_id"),
                 pa.array([len(x) // len(end) for x in ids], pa.int64()),
                 pa.array(ids, pa.binary())],
                names=["pid", "doc_id", "n_tokens", "ids"])
    return run


def ranged_ids(docs: DataFrame, tokenizer: str, end_id: int, id_col: str,
               text_col: str) -> tuple[DataFrame, int]:
    """Each document's ids with its range, made once; and the number of ranges."""
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                         F.col(text_col).cast("string").alias("text"))
    ranges = max(default_parallelism(docs.sparkSession), -(-narrow.count() // RANGE_DOCS))
    bounds = narrow.select("doc_id").na.drop().approxQuantile(
        "doc_id", [i / ranges for i in range(1, ranges)], 0.1 / ranges) if ranges > 1 else []
    made = narrow.mapInArrow(_tokenise(tokenizer, end_id, [int(x) for x in bounds]), IDS)
    return staged(made, "ids"), ranges


def _count(kind: str, n: int):
    def run(batches):
        total = np.zeros(n, np.int64)
        for b in batches:
            raw = b"".join(b.column("ids").to_pylist())
            total += np.bincount(np.frombuffer(raw, kind), minlength=n)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(total[met])],
                                         names=["id", "n"])
    return run


# Files ----------------------------------------------------------------------

def _encode(freq: np.ndarray, kind: str):
    """Runs of whole documents, coded; rows come range by range and in order."""
    def run(batches):
        coder, held, size, before = Coder(freq), [], 0, 0

        def close():
            ids = np.concatenate([np.frombuffer(r["ids"], kind) for r in held])
            words, states, sums = [], [], []
            for i in range(0, len(ids), BLOCK * BLOCKS_AT_ONCE):
                part = ids[i:i + BLOCK * BLOCKS_AT_ONCE]
                w, x = coder.encode(part)
                words += w
                states.append(x.astype("<u8").tobytes())
                sums += [zlib.crc32(part[j:j + BLOCK].astype("<u4").tobytes())
                         for j in range(0, len(part), BLOCK)]
            values = [held[0]["pid"], before, [r["doc_id"] for r in held],
                      [r["n_tokens"] for r in held], b"".join(words),
                      [len(w) // 4 for w in words], b"".join(states), sums]
            kinds = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()),
                     pa.binary(), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(values, kinds)],
                names=[x.split(" ")[0] for x in FILE.split(", ")])

        for b in batches:
            for r in b.to_pylist():
                other = held and r["pid"] != held[0]["pid"]
                if held and (other or size + r["n_tokens"] > RUN_IDS):
                    yield close()
                    before = 0 if other else before + size
                    held, size = [], 0
                held.append(r)
                size += r["n_tokens"]
        if held:
            yield close()
    return run


def _decode(freq: np.ndarray):
    def run(batches):
        coder = Coder(freq)
        for b in batches:
            rows = b.to_pylist()
            # The blocks of all runs at hand are decoded side by side.
            counts = np.array([n for r in rows for n in r["word_counts"]], np.int64)
            words = np.concatenate([np.frombuffer(r["words"], "<u4") for r in rows])
            states = np.concatenate([np.frombuffer(r["states"], "<u8") for r in rows])
            states, first = states.reshape(-1, LANES), np.cumsum(counts) - counts
            found = np.concatenate([
                coder.decode(words, first[i:i + BLOCKS_AT_ONCE], states[i:i + BLOCKS_AT_ONCE])
                for i in range(0, len(counts), BLOCKS_AT_ONCE)]).astype("<u4", copy=False)
            done = 0
            for r in rows:
                blocks = len(r["word_counts"])
                ids = found[done:done + blocks].reshape(-1)[:sum(r["lengths"])]
                done += blocks
                for k, want in enumerate(r["checksums"]):
                    if zlib.crc32(ids[k * BLOCK:(k + 1) * BLOCK].tobytes()) != want:
                        raise ValueError(f"block {k} of the run at {r['pid']}:{r['before']} is damaged")
                ends = np.cumsum(r["lengths"], dtype=np.int64)
                starts = ends - np.array(r["lengths"], np.int64)
                raw = ids.tobytes()
                for at in range(0, len(ends), 64):
                    to = min(at + 64, len(ends))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r["pid"]] * (to - at), pa.int32()),
                         pa.array(r["before"] + starts[at:to]),
                         pa.array(r["doc_ids"][at:to], pa.int64()),
                         pa.array(r["lengths"][at:to], pa.int64()),
                         pa.array([raw[4 * s:4 * e] for s, e in zip(starts[at:to], ends[at:to])],
                                  pa.binary())],
                        names=["pid", "before", "doc_id", "n_tokens", "ids"])
    return run


def write_files(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 2,
                id_col: str = "doc_id", text_col: str = "text") -> None:
    """``path``/table, /ranges and /blocks: the shared table, the ids of each range, the runs."""
    spark, tokenizer = docs.sparkSession, tokenizer or default_tokenizer()
    prepare(spark, batch_rows=1024)
    size = max(encoder(tokenizer).size, end_id + 1)
    kind = "<u2" if size <= 65536 else "<u4"
    ids, ranges = ranged_ids(docs, tokenizer, end_id, id_col, text_col)
    counts = np.zeros(size, np.int64)
    # At most one row for each id of the vocabulary reaches the driver.
    for r in (ids.select("ids").mapInArrow(_count(kind, size), "id long, n long")
              .groupBy("id").agg(F.sum("n").alias("n")).collect()):
        counts[r["id"]] = r["n"]
    freq = scaled_table(counts)
    spark.createDataFrame([(i, int(f)) for i, f in enumerate(freq)], "id long, freq long") \
        .coalesce(1).write.parquet(f"{path}/table")
    totals = ids.groupBy("pid").agg(F.sum("n_tokens").alias("ids"))
    prefix_offsets(totals, "pid", "ids").coalesce(1).write.parquet(f"{path}/ranges")
    dealt = ids.repartitionById(ranges, F.col("pid")).sortWithinPartitions(
        "pid", F.col("doc_id").asc_nulls_first(), "n_tokens", "ids")
    dealt.mapInArrow(_encode(freq, kind), FILE).write.option(
        "compression", "none").parquet(f"{path}/blocks")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian unsigned 32-bit) from the files."""
    prepare(spark, batch_rows=8)
    table = spark.read.parquet(f"{path}/table").orderBy("id").collect()
    freq = np.array([r["freq"] for r in table], np.int64)
    found = spark.read.schema(FILE).parquet(f"{path}/blocks").mapInArrow(_decode(freq), READ)
    ranges = spark.read.schema("pid int, ids_before long").parquet(f"{path}/ranges")
    # One row for each range, of which there is one for RANGE_DOCS documents.
    return found.join(F.broadcast(ranges), "pid").select(
        "doc_id", (F.col("before") + F.col("ids_before")).alias("start"), "n_tokens", "ids")


def round_trip(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2) -> DataFrame:
    """Write the files to the shared folder and read them back."""
    path = scratch_path(docs.sparkSession, "token-files")
    write_files(docs, path, tokenizer, end_id)
    return read_files(docs.sparkSession, path)
