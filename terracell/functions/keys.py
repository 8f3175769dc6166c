"""Compact cell keys: a coarse 16-bit key (resolution 3) and a fine 32-bit key (resolution 8).

All native expressions. Keys are signed: shift pairs wrap the sign, so no cast can overflow.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Index bits of an otherwise empty cell of resolution 3 and 8, and key bounds.
BASE3, BASE8 = 0x0830000FFFFFFFFF, 0x08800000000FFFFF
LOWEST, HIGHEST, SEVERAL = -32768, 32695, 32767


def wrapped(value: Column, bits: int) -> Column:
    """The low ``bits`` of a long as a signed number."""
    return F.shiftright(F.shiftleft(value, 64 - bits), 64 - bits)


def coarse(cell: Column) -> Column:
    return wrapped(F.shiftrightunsigned(cell, 36), 16).cast("smallint")


def fine(cell: Column) -> Column:
    return wrapped(F.shiftrightunsigned(cell, 20), 32).cast("int")


def from_coarse(key: Column) -> Column:
    return F.shiftleft(key.cast("long").bitwiseAND(0xFFFF), 36).bitwiseOR(F.lit(BASE3))


def from_fine(key: Column) -> Column:
    return F.shiftleft(key.cast("long").bitwiseAND(0xFFFFFFFF), 20).bitwiseOR(F.lit(BASE8))


def parent(key: Column) -> Column:
    """Resolution-2 key of a coarse key: its last digit set to 7."""
    return key.cast("int").bitwiseOR(7)


def children(key: Column) -> tuple[Column, Column]:
    """First and last coarse key under the same parent."""
    first = key.cast("int").bitwiseAND(-8)
    return first, first + 6


def common_cell(cells: Column) -> Column:
    """The one coarse key of an array, or SEVERAL."""
    one = F.array_distinct(cells)
    return F.when(F.size(one) == 1, one[0]).otherwise(F.lit(SEVERAL)).cast("smallint")
