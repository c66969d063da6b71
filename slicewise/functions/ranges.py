"""Fixed-width range buckets."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def range_start(value: Column, width: Column | int, mode: str = "truncate") -> Column:
    """Lower end of the bucket as bigint: ``value - value % width``.

    ``truncate`` uses the remainder that takes the sign of the value, so with width 5 both -3 and 3 fall in bucket 0
    and -7 in bucket -5. ``floor`` gives buckets of equal width on both sides of zero. A value with no bigint
    bucket (NaN, out of range) gives NULL, as NULL does.
    """
    width = width if isinstance(width, Column) else F.lit(int(width))
    if mode == "truncate":
        rest = value % width
    elif mode == "floor":
        rest = F.pmod(value, width)
    else:
        raise ValueError(f"unknown range mode: {mode}")
    return (value - rest).try_cast("bigint")


def range_end(start: Column, width: Column | int) -> Column:
    width = width if isinstance(width, Column) else F.lit(int(width))
    return F.try_add(start, width.cast("bigint"))


def range_label(start: Column, end: Column) -> Column:
    """Text of a bucket; NULL for the NULL bucket."""
    return F.concat(start.cast("string"), F.lit(" <-> "), end.cast("string"))


def checked_width(width: int) -> int:
    if int(width) <= 0:
        raise ValueError(f"the range width must be a positive whole number, not {width}")
    return int(width)
