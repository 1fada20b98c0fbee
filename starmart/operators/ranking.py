"""Exact global row numbers and NTILE without a single partition.

An unpartitioned window plans as ``Exchange SinglePartition``. Tiles need only their
boundary rows, which counts over value ranges find (``tiles``). Dense numbers:

1. range-partition on the order columns (which end in a unique tie-break),
   sort within partitions and tag rows with ``monotonically_increasing_id``
   (partition id in the upper bits, row index in the lower 33 bits);
2. checkpoint once: range bounds are sampled, so a recomputation could move
   rows between partitions;
3. count rows per partition (one small row per partition reaches the
   driver) and turn the counts into offsets;
4. rank = offset[partition] + index in partition + 1.

A hot value of the leading order column does not land in one task: the
range partitioner splits it on the tie-break columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir, default_parallelism

_LOW_BITS = (1 << 33) - 1


def placed(df: DataFrame, order: Sequence[Column | str], num_partitions: int | None = None,
           adaptive: bool = False, settle=None) -> DataFrame:
    """Rows in range partitions of ``order``, tagged with their partition and place.

    ``settle``: what is done with the rows of each range partition before they are sorted.

    By default an explicit count (spark.sql.shuffle.partitions), which AQE leaves
    alone. ``adaptive``: no count, so AQE may merge adjacent small ranges (it
    never splits them); partitions stay contiguous and in order.
    """
    if adaptive:
        ranged = df.repartitionByRange(*order)
    else:
        ranged = df.repartitionByRange(
            num_partitions or default_parallelism(df.sparkSession), *order)
    if settle:
        ranged = settle(ranged)
    return ranged.sortWithinPartitions(*order).withColumn("_mid", F.monotonically_increasing_id())


def row_number_global(df: DataFrame, order: Sequence[Column | str], name: str = "rn",
                      num_partitions: int | None = None,
                      adaptive: bool = False, settle=None) -> tuple[DataFrame, int]:
    """Add a dense 1-based rank ``name`` in ``order``; return (frame, row count).

    ``order`` must make rows unique, or ties get an arbitrary (but fixed once
    materialized) order.
    """
    checkpoint_dir(df.sparkSession)
    frozen = placed(df, order, num_partitions, adaptive, settle).checkpoint(eager=True)
    counts = (frozen.groupBy(F.shiftright("_mid", 33).alias("pid"))
              .agg(F.count(F.lit(1)).alias("n"))
              .collect())
    per_pid = {int(r["pid"]): int(r["n"]) for r in counts}
    top = max(per_pid) if per_pid else 0
    offsets, running = [], 0
    for pid in range(top + 1):
        offsets.append(running)
        running += per_pid.get(pid, 0)
    pid_col = F.shiftright("_mid", 33)
    offset = F.element_at(F.array(*[F.lit(o).cast("long") for o in offsets]),
                          (pid_col + 1).cast("int"))
    ranked = (frozen.withColumn(name, offset + F.col("_mid").bitwiseAND(F.lit(_LOW_BITS)) + 1)
              .drop("_mid"))
    return ranked, running


#: Bits of a value that one pass of counts tells apart. A pass brings at most so many (65,536)
#: counts for each boundary to the driver, as Arrow data, at any size of the table.
PASS_BITS = 16


def as_long(df: DataFrame, name: str) -> Column:
    """A whole number in the order of a date, decimal or whole-number column."""
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(kind, T.DecimalType):
        return (c * F.lit(10 ** kind.scale)).cast("long")
    if isinstance(kind, T.IntegralType):
        return c.cast("long")
    raise TypeError(f"{name}: no whole numbers for {kind.simpleString()}")


@dataclass
class _Boundary:
    """The row of a rank: its value among ``lo..hi``; then its key, where rows tie."""
    measure: int
    rank: int                 # among the rows of the range
    lo: int
    hi: int
    value: int | None = None  # found; the range is then one of keys
    key: int | None = None
    done: bool = False

    @property
    def shift(self) -> int:
        return max(0, (self.hi - self.lo).bit_length() - PASS_BITS)

    @property
    def place(self) -> tuple:
        return self.measure, self.value, self.lo, self.hi

    def narrow(self, buckets: np.ndarray, counts: np.ndarray, keys: tuple[int, int]) -> None:
        """Keep the bucket that holds the rank; buckets of this range in order, with their counts."""
        shift, reach = self.shift, np.cumsum(counts)
        at = int(np.searchsorted(reach, self.rank))
        bucket, held = int(buckets[at]), int(counts[at])
        self.rank -= int(reach[at]) - held
        self.lo, self.hi = self.lo + (bucket << shift), min(
            self.hi, self.lo + ((bucket + 1) << shift) - 1)
        if self.lo < self.hi:
            return
        if self.value is not None:
            self.key, self.done = self.lo, True
        else:
            self.value, self.done = self.lo, self.rank == held
            self.lo, self.hi = keys

    def before(self, value: Column, key: Column) -> Column:
        """Whether a row comes after this one in (value, key)."""
        later = value > self.value
        return later if self.key is None else later | ((value == self.value) & (key > self.key))


def tiles(df: DataFrame, n: int, measures: dict[str, str], key: str) -> DataFrame:
    """``NTILE(n) OVER (ORDER BY measure DESC NULLS FIRST, key)`` for each measure.

    ``measures`` names the tile column of each measure; ``key`` is unique. Only the last
    row of each tile but the last is looked for: counts over value ranges, refined around
    its rank until one value is left, then over the keys that tie there. Every pass
    serves all boundaries of all measures; each row is then compared with n - 1 literals.
    The rows are written once (the passes read them again), never numbered or joined.
    """
    checkpoint_dir(df.sparkSession)
    names = list(measures)
    wide = df.withColumns({**{f"_v{i}": as_long(df, m) for i, m in enumerate(names)},
                           "_k": as_long(df, key)})
    seen = Observation()
    held = [f"_v{i}" for i in range(len(names))] + ["_k"]
    frozen = wide.observe(seen, *[f(c).alias(f"{f.__name__}{c}") for c in held
                                  for f in (F.min, F.max)]).checkpoint(eager=True)
    span = {c: tuple(int(seen.get.get(f"{f}{c}") or 0) for f in ("min", "max")) for c in held}
    # Descending values ascend as their complement; a null comes before the highest value.
    value = [F.coalesce(F.bitwise_not(F.col(f"_v{i}")), F.lit(~span[f"_v{i}"][1] - 1))
             for i in range(len(names))]
    key_of = F.coalesce(F.col("_k"), F.lit(span["_k"][0] - 1))
    keys = (span["_k"][0] - 1, span["_k"][1])

    def counted(places: list[_Boundary]) -> dict[tuple, tuple[np.ndarray, np.ndarray]]:
        cases = []
        for j, b in enumerate(places):
            x = value[b.measure] if b.value is None else key_of
            inside = x.between(b.lo, b.hi)
            if b.value is not None:
                inside &= value[b.measure] == b.value
            cases.append(F.when(inside, F.struct(
                F.lit(j).alias("j"), F.shiftright(x - F.lit(b.lo), b.shift).alias("bucket"))))
        met = frozen.select(F.explode(F.filter(F.array(*cases), lambda c: c.isNotNull())).alias("c"))
        got = met.groupBy("c.j", "c.bucket").agg(F.count(F.lit(1)).alias("n")).toArrow().sort_by(
            [("j", "ascending"), ("bucket", "ascending")])
        j, bucket, n = (got.column(c).to_numpy() for c in ("j", "bucket", "n"))
        cut = np.searchsorted(j, np.arange(len(places) + 1))
        return {b.place: (bucket[lo:hi], n[lo:hi]) for b, lo, hi in zip(places, cut, cut[1:])}

    whole = [_Boundary(i, 0, ~span[f"_v{i}"][1] - 1, ~span[f"_v{i}"][0]) for i in range(len(names))]
    counts = counted(whole)
    total = int(counts[whole[0].place][1].sum())
    q, r = divmod(total, n)
    bounds = [_Boundary(w.measure, k * q + min(k, r), w.lo, w.hi)
              for w in whole for k in range(1, n) if total]
    while active := [b for b in bounds if not b.done]:
        for b in active:
            b.narrow(*counts[b.place], keys)
        places = {b.place: b for b in bounds if not b.done}
        counts = counted(list(places.values())) if places else {}
    out = frozen
    for i, m in enumerate(names):
        passed = [b.before(value[i], key_of).cast("int") for b in bounds if b.measure == i]
        out = out.withColumn(measures[m], reduce(lambda a, c: a + c, passed, F.lit(1)))
    return out.drop(*held)


def ntile_global(df: DataFrame, n: int, measure: str, key: str, name: str) -> DataFrame:
    """W26 for one measure: descending, ties by ``key`` ascending."""
    return tiles(df, n, {measure: name}, key)


def assign_keys(df: DataFrame, order: Sequence[Column | str], key: str,
                start_after: int | Column, num_partitions: int | None = None,
                settle=None) -> tuple[DataFrame, int]:
    """Dense surrogate keys start_after + 1, + 2, ... in ``order``; and how many."""
    ranked, n = row_number_global(df, order, "_rk", num_partitions, settle=settle)
    base = start_after if isinstance(start_after, Column) else F.lit(int(start_after))
    return ranked.withColumn(key, (base + F.col("_rk")).cast("long")).drop("_rk"), n


def running(df: DataFrame, group: str, order: Sequence[Column | str], value: Column, name: str,
            fold, num_partitions: int | None = None, inclusive: bool = True) -> DataFrame:
    """``fold`` (F.sum, F.max, ...; associative) of ``value`` over a group's rows so far.

    (group, order) must be unique. A group may span range partitions: each
    partition folds its own rows of a group, and what the earlier partitions hold
    of the group is added from one row for each (partition, group) that meet.
    ``inclusive``: the row itself counts.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    frozen = (df.withColumn("_value", value)
              .repartitionByRange(num_partitions or default_parallelism(spark), group, *order)
              .withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True))
    inside = Window.partitionBy("_pid", group).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    earlier = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    before = (frozen.groupBy("_pid", group).agg(fold("_value").alias("_fold"))
              .withColumn("_before", fold("_fold").over(earlier))
              .filter(F.col("_before").isNotNull())
              .select(F.col("_pid").alias("_p"), F.col(group).alias("_g"), "_before"))
    # Only groups that span partitions have a row here: at most one for each partition edge.
    met = frozen.withColumn("_in", fold("_value").over(inside)).join(
        before, (F.col("_pid") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")), "left")
    both = F.array("_in", "_before")
    folded = (F.aggregate(F.filter(both, lambda x: x.isNotNull()), F.lit(0).cast("long"),
                          lambda a, x: a + x) if fold is F.sum else F.array_max(both))
    out = F.when(F.coalesce("_in", "_before").isNotNull(), folded)
    return met.withColumn(name, out).drop("_pid", "_p", "_g", "_in", "_before", "_value")


def running_total(df: DataFrame, group: str, order: str, value: str, name: str,
                  num_partitions: int | None = None) -> DataFrame:
    """Running sum of the whole-number column ``value`` by ``order`` within ``group``."""
    return running(df, group, [order], F.col(value).cast("long"), name, F.sum, num_partitions)


def max_key(df: DataFrame, key: str) -> int:
    """Largest existing key, 0 for an empty table (one scalar to the driver)."""
    v = df.agg(F.max(key)).first()[0]
    return int(v) if v is not None else 0
