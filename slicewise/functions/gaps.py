"""Percentage gaps. A zero denominator gives NULL, which a verdict reads as Fail."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _ratio(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def point_gap(table_count: Column, group_count: Column) -> Column:
    """How far the table exceeds the group, in percent of the group."""
    return _ratio(table_count - group_count, group_count) * 100


def trend_gap(table_count: Column, group_count: Column) -> Column:
    """Group minus table, in percent of the table; never above 0 while the group is part of the table."""
    return _ratio((group_count - table_count) * 100, table_count)


def average_gap(past_table_count: Column, past_count: Column) -> Column:
    """The point gap of the past averages. The current count has no part in it."""
    return _ratio(past_table_count - past_count, past_count) * 100


def change_gap(current: Column, past: Column) -> Column:
    """Current against past, in percent of the past (an extra measure beside the two above)."""
    return _ratio(current - past, past) * 100
