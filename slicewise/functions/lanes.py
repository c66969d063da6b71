"""Typed unpivot: many columns of different types as rows, with no cast of numbers to text.

Each row carries the number of its column and one filled value out of several lanes: ``text`` (strings, dates,
booleans), ``whole`` (integers), one lane for every decimal type, ``single`` and ``real`` (floating point). Group keys and
minima stay in the column's own type, so the text of a value, made only for the groups that come out of the aggregation,
does not depend on the columns beside it. Only the lanes that are needed exist.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .slices import quoted, ref

DECIMAL = "exact"


def lane_of(dtype: T.DataType) -> str:
    if isinstance(dtype, T.IntegralType):
        return "whole"
    if isinstance(dtype, T.DecimalType):
        return f"{DECIMAL}_{dtype.precision}_{dtype.scale}"
    if isinstance(dtype, T.FloatType):
        return "single"
    if isinstance(dtype, T.FractionalType):
        return "real"
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)):
        raise TypeError(f"a column of type {dtype.simpleString()} must be flattened before it is profiled")
    return "text"


def lane_map(df: DataFrame, columns: list[str]) -> dict[str, str]:
    return {c: lane_of(df.schema[c].dataType) for c in columns}


def lanes_in(df: DataFrame, columns: list[str]) -> list[str]:
    """The lanes in use, text first and binary fractions last."""
    order = {"text": 0, "whole": 1, "single": 3, "real": 4}
    return sorted(set(lane_map(df, columns).values()), key=lambda lane: (order.get(lane, 2), lane))


def lane_type(lane: str) -> str:
    """The SQL type of a lane's values."""
    if lane.startswith(DECIMAL):
        return "decimal({}, {})".format(*lane.split("_")[1:])
    return {"text": "string", "whole": "bigint", "single": "float", "real": "double"}[lane]


def unpivot_lanes(
    df: DataFrame, columns: list[str], keep: list[str] | None = None, beside: dict[str, list[str]] | None = None
) -> DataFrame:
    """One row per input row and column: the kept columns, ``column_no``, the lanes in use and what stands ``beside`` them.

    ``beside`` names further columns of the result, each with one expression per unpivoted column.
    """
    beside = beside or {}
    lanes, own = lanes_in(df, columns), lane_map(df, columns)
    cells = []
    for number, name in enumerate(columns):
        filled = [f"CAST({quoted(name) if own[name] == lane else 'NULL'} AS {lane_type(lane)})" for lane in lanes]
        cells.append(", ".join([str(number), *filled, *(sql[number] for sql in beside.values())]))
    rows = F.expr(f"stack({len(columns)}, {', '.join(cells)})").alias("column_no", *lanes, *beside)
    return df.select(*[ref(k) for k in keep or []], rows)


def column_name_of(number: Column, columns: list[str]) -> Column:
    """The name behind a ``column_no``."""
    return F.get(F.array(*[F.lit(c) for c in columns]), number)


def lane_text(lanes: list[str], prefix: str = "") -> Column:
    return F.coalesce(*[F.col(prefix + lane).cast("string") for lane in lanes])


def lane_number(lanes: list[str], prefix: str = "") -> Column:
    numeric = [lane for lane in lanes if lane != "text"]
    if not numeric:
        return F.lit(None).cast("double")
    return F.coalesce(*[F.col(prefix + lane).cast("double") for lane in numeric])


def lanes_empty(lanes: list[str]) -> Column:
    """True where the unpivoted value is NULL."""
    return F.expr(" AND ".join(f"{lane} IS NULL" for lane in lanes))
