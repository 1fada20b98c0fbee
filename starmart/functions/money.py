"""Exact money arithmetic on Spark decimals.

Amounts are ``decimal(10,2)`` in the fact and ``decimal(20,2)`` once summed.
Ratios are rounded half away from zero with integer arithmetic on
``decimal(38,0)`` so that no intermediate rounding can shift a result.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

AMOUNT = DecimalType(10, 2)
TOTAL = DecimalType(20, 2)


def cents_of_double(c: Column) -> Column:
    """Whole cents of a money value stored as double."""
    return F.round(c * F.lit(100)).cast("long")


def cents_to_amount(c: Column) -> Column:
    """Integral cents -> decimal(10,2), exactly."""
    return (c.cast("decimal(20,0)") / F.lit(100)).cast(AMOUNT)


def whole_div(a: Column, b: Column) -> Column:
    """Quotient of two whole numbers, cut towards zero; null when ``b`` is null or 0."""
    return F.call_function("div", a, F.nullif(b, F.lit(0).cast("long")))


def total(c: Column) -> Column:
    return c.cast(TOTAL)


def _units(c: Column, scale: int) -> Column:
    """Exact integer count of 10^-scale units held in ``c``."""
    if scale:
        c = c * F.lit(10 ** scale)
    return c.cast("decimal(38,0)")


def round_div(num: Column, den: Column, *, scale: int = 2, num_scale: int = 2,
              den_scale: int = 0, precision: int = 20) -> Column:
    """round(num / den, scale), half away from zero; null when den is 0 or null.

    ``num_scale`` / ``den_scale`` are the decimal scales of the operands
    (0 for integral columns).
    """
    a = _units(num, num_scale)
    b = _units(den, den_scale)
    shift = scale + den_scale - num_scale
    if shift > 0:
        a = a * F.lit(10 ** shift)
    elif shift < 0:
        b = b * F.lit(10 ** (-shift))
    n = F.abs(a) * F.lit(2) + F.abs(b)
    d = F.abs(b) * F.lit(2)
    q = ((n - n % d) / d).cast("decimal(38,0)")
    signed = F.when((a < 0) != (b < 0), -q).otherwise(q)
    unit = F.lit(Decimal(1).scaleb(-scale)) if scale else F.lit(1)
    out = (signed * unit).cast(DecimalType(precision, scale))
    return F.when(b == 0, F.lit(None).cast(DecimalType(precision, scale))).otherwise(out)
