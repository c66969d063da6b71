"""Predicates on the date column of a table.

A slice is the set of rows of one date. The comparison is written on the column itself wherever its type allows
it, so that partition pruning and Parquet row-group filters apply.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F, types as T

Day = dt.date | str | Column


def day_column(day: Day) -> Column:
    return day if isinstance(day, Column) else F.lit(str(day)).cast("date")


def quoted(name: str) -> str:
    """A column name for SQL text, dots and spaces included."""
    return "`" + name.replace("`", "``") + "`"


def ref(name: str) -> Column:
    """A column by its exact name."""
    return F.col(quoted(name))


def date_of(column: str) -> Column:
    return F.to_date(ref(column))


def on_day(df: DataFrame, column: str, day: Day) -> Column:
    if isinstance(df.schema[column].dataType, T.StringType):
        return ref(column) == day_column(day).cast("string")
    return date_of(column) == day_column(day)


def between_days(df: DataFrame, column: str, low: Day, high: Day) -> Column:
    """Both ends inclusive."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return ref(column).between(day_column(low).cast("string"), day_column(high).cast("string"))
    return date_of(column).between(day_column(low), day_column(high))


def in_days(df: DataFrame, column: str, days: list[Day]) -> Column:
    if isinstance(df.schema[column].dataType, T.StringType):
        return ref(column).isin(*[day_column(d).cast("string") for d in days])
    return date_of(column).isin(*[day_column(d) for d in days])


def shift(day: Day, days: int) -> Column:
    """Calendar shift over year ends too: 2024-01-03 minus 5 days is 2023-12-29."""
    return F.date_add(day_column(day), days)
