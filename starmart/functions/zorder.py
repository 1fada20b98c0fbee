"""Space-filling order: the interleaved bits of several small numbers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bits of each number; four numbers make 32-bit places.
BITS = 8


def scaled(key: Column, top: int) -> Column:
    """``key`` in 0..top as a number of ``BITS`` bits, in order."""
    return F.floor(key * F.lit(float(1 << BITS) / (top + 1))).cast("long")


def interleaved(*numbers: Column) -> Column:
    """Rows that lie close in every number lie close in this one."""
    bits = []
    for bit in range(BITS):
        for i, x in enumerate(numbers):
            at = bit * len(numbers) + len(numbers) - 1 - i
            bits.append(F.shiftleft(F.shiftright(x, bit).bitwiseAND(F.lit(1).cast("long")), at))
    return reduce(lambda a, b: a.bitwiseOR(b), bits)
