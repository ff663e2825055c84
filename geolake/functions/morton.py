"""Cells of a plane cut again and again into 2 x 2 parts, numbered along a Z-shaped curve.

A place's curve number has two halves of 28 bits a side, so that 56 cuts are told apart, as far as doubles go. A cell is known by
the leading bits with a one before them; cells of different size differ too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bits a side in a half, cuts in a half, cuts in all; bits of a number that a cut takes.
HALF, CUTS = 28, 28
LEVELS, STEP = 2 * CUTS, 2


def _spread(value: Column) -> Column:
    """A 31-bit number with its bits moved apart: its binary digits read as digits of base four."""
    return F.conv(F.bin(value), 4, 10).cast("bigint")


def interleave(x: Column, y: Column) -> Column:
    """A 62-bit number of two whole numbers in [0, 2^31)."""
    return _spread(x.cast("bigint")).bitwiseOR(F.shiftleft(_spread(y.cast("bigint")), 1))


def halves(x: Column, y: Column, low: Sequence[float], extent: float) -> tuple[Column, Column]:
    """Curve number of a place in the square of side ``extent`` above ``low``: its upper and its lower half."""
    top = (1 << (2 * HALF)) - 1

    def step(v: Column, least: float) -> Column:
        part = (v - least) / extent if extent > 0 else F.lit(0.0)
        return F.greatest(F.least(F.floor(part * float(1 << (2 * HALF))), F.lit(top)), F.lit(0))

    a, b = step(x, low[0]), step(y, low[1])
    low_bits = (1 << HALF) - 1
    return interleave(F.shiftright(a, HALF), F.shiftright(b, HALF)), interleave(a.bitwiseAND(low_bits), b.bitwiseAND(low_bits))


def shared_cuts(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    """How many cuts leave two places in one cell."""
    def same(one: Column, other: Column) -> Column:
        gap = one.bitwiseXOR(other)
        return F.when(gap == 0, CUTS).otherwise(F.floor((2 * HALF - F.length(F.bin(gap))) / STEP).cast("int"))

    return F.when(a[0] == b[0], CUTS + same(a[1], b[1])).otherwise(same(a[0], b[0]))


def cell(high: Column, low: Column, cuts: Column) -> Column:
    """The cell of a place after so many cuts."""
    def lead(half: Column, n: Column) -> Column:
        bits = n * STEP
        return F.call_function("shiftright", half, F.lit(2 * HALF) - bits) + F.call_function("shiftleft", F.lit(1).cast("bigint"), bits)

    zero = F.lit(0).cast("bigint")
    cuts = cuts.cast("int")
    return F.struct(lead(high, F.least(cuts, F.lit(CUTS))).alias("h"), F.when(cuts > CUTS, lead(low, cuts - CUTS)).otherwise(zero).alias("l"))
