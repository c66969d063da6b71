"""Column profiles of one slice: value groups, whole-column rows, and the choice between the two.

``value`` rows hold one group of equal values each; the NULL group is a group with count 0, as ``count(column)``
gives it. ``column`` rows hold the whole column with NULLs counted.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.lanes import (
    column_name_of,
    lane_map,
    lane_number,
    lane_text,
    lanes_in,
    unpivot_lanes,
)
from ..functions.slices import quoted

# From this many groups on, a column is summed up in one row.
GATE = 5

PROFILE_COLUMNS = [
    "column_name",
    "stat_kind",
    "column_value",
    "table_count",
    "group_count",
    "min_value",
    "max_value",
    "min_number",
    "max_number",
]


def one_zero_sql(name: str, lane: str) -> str:
    """The column as profiled; adding 0.0 turns -0.0 into 0.0, which group-by treats as equal too."""
    return f"({quoted(name)} + 0.0D)" if lane == "real" else quoted(name)


def one_zero(name: str, lane: str) -> Column:
    return F.expr(one_zero_sql(name, lane))


def as_number(value: Column, lane: str) -> Column:
    return (F.lit(None) if lane == "text" else value).cast("double")


def slot_words(gate: int) -> int:
    """How many 64-bit words keep a column of many values far above ``gate`` used slots."""
    return max(1, -(-gate // 16))


def used_slots(values: list[str], gate: int, name: str) -> list[Column]:
    """Aggregates that mark one slot per hashed value: ``bit_or`` of single bits, cheap and generated as code.

    Equal values, and NULLs, share a slot. So the number of marked slots is a lower bound of the number of groups: a
    column that marks ``gate`` slots has at least ``gate`` groups. Fewer marks leave the question open.
    """
    slot, words = f"xxhash64({', '.join(values)})", slot_words(gate)
    bit = f"shiftleft(1L, CAST({slot} & 63 AS INT))"
    if words == 1:
        return [F.expr(f"bit_or({bit})").alias(f"{name}_0")]
    word = f"pmod(shiftright({slot}, 6), {words})"
    return [F.expr(f"bit_or(IF({word} = {w}, {bit}, 0L))").alias(f"{name}_{w}") for w in range(words)]


def marked(row: dict, gate: int, name: str) -> int:
    """Marked slots in a fetched row of ``used_slots``."""
    return sum(((row[f"{name}_{w}"] or 0) & (2**64 - 1)).bit_count() for w in range(slot_words(gate)))


def text_end(end: Callable[[str], Column], value: str | Column) -> Column:
    """Minimum or maximum of a text inside a grouped aggregate that must not sort its input.

    Spark sorts all rows by key for an aggregate whose buffer holds text, unless another aggregate beside it keeps its buffer
    as an object: then all of them live in a hash map. An empty set is such a buffer, and the condition on it always holds. (A
    task that meets more than ``spark.sql.objectHashAggregate.sortBased.fallbackThreshold`` keys still sorts what is left.)
    """
    objects = F.collect_set(F.lit(None).cast("int"))
    return F.when(F.size(objects) == 0, end(value))


def ends_of(lane: str) -> list[Column]:
    """Minimum and maximum of an unpivoted lane."""
    ends = [(f.__name__, text_end(f, lane) if lane == "text" else f(lane)) for f in (F.min, F.max)]
    return [value.alias(f"{name}_{lane}") for name, value in ends]


def extremes(name: str, lane: str, alias: str, rows: Column | None = None) -> list[Column]:
    """Minimum and maximum of a column, of some rows only when a condition is given."""
    value = one_zero(name, lane)
    value = value if rows is None else F.when(rows, value)
    return [F.min(value).alias(f"min_{alias}"), F.max(value).alias(f"max_{alias}")]


def _column_rows(wide: DataFrame, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """Whole-column rows from one row with ``table_count`` and extremes; ``columns``: name -> (alias, lane)."""
    per_column = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col(f"min_{alias}").cast("string").alias("min_value"),
            F.col(f"max_{alias}").cast("string").alias("max_value"),
            as_number(F.col(f"min_{alias}"), lane).alias("min_number"),
            as_number(F.col(f"max_{alias}"), lane).alias("max_number"),
        )
        for name, (alias, lane) in columns.items()
    ]
    return (
        wide.filter("table_count > 0")
        .select("table_count", F.inline(F.array(*per_column)))
        .withColumns(
            {
                "stat_kind": F.lit("column"),
                "column_value": F.lit(None).cast("string"),
                "group_count": F.col("table_count"),
            }
        )
        .select(*PROFILE_COLUMNS)
    )


def by_text(df: DataFrame, columns: list[str]) -> list[list[str]]:
    """Numeric columns and text columns apart: extremes of text keep a whole aggregate from being generated as code."""
    lanes = lane_map(df, columns)
    parts = [c for c in columns if lanes[c] != "text"], [c for c in columns if lanes[c] == "text"]
    return [part for part in parts if part]


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def column_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """One whole-column row per column; one aggregate for all numeric columns and one for all text columns."""
    lanes, frames = lane_map(df, columns), []
    for part in by_text(df, columns):
        ends = [end for i, c in enumerate(part) for end in extremes(c, lanes[c], str(i))]
        wide = df.agg(F.count("*").alias("table_count"), *ends)
        frames.append(_column_rows(wide, {c: (str(i), lanes[c]) for i, c in enumerate(part)}))
    return union_all(frames)


def value_groups(df: DataFrame, columns: list[str], keep: list[str] | None = None) -> DataFrame:
    """``keep..., column_no``, lanes and ``n``: rows per value of several columns, by one unpivot and one group-by.

    Rows are counted per value before the shuffle, so a value that holds much of the table travels as one row per
    task.
    """
    keys = [*(keep or []), "column_no", *lanes_in(df, columns)]
    return unpivot_lanes(df, columns, keep).groupBy(*keys).agg(F.count("*").alias("n"))


def multi_column_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Value rows of several columns, whatever their number of groups.

    The table count is a count of the slice on its own, which reads no profiled column.
    """
    lanes = lanes_in(df, columns)
    value, number = lane_text(lanes), lane_number(lanes)
    return value_groups(df, columns).select(
        column_name_of(F.col("column_no"), columns).alias("column_name"),
        F.lit("value").alias("stat_kind"),
        value.alias("column_value"),
        df.agg(F.count("*")).scalar().alias("table_count"),
        F.when(value.isNull(), 0).otherwise(F.col("n")).cast("bigint").alias("group_count"),
        value.alias("min_value"),
        value.alias("max_value"),
        number.alias("min_number"),
        number.alias("max_number"),
    )


def value_profile(df: DataFrame, column: str) -> DataFrame:
    """Value rows of one column."""
    return multi_column_profile(df, [column])


def gate_groups(groups: DataFrame, keys: list[str], lanes: list[str], gate: int) -> DataFrame:
    """Value rows of keys with fewer than ``gate`` groups, one whole-column row for the other keys.

    Meant for groups that ``used_slots`` has shown to be few, since the groups of a key meet in one task.
    """
    of_key, numeric = Window.partitionBy(*keys), [lane for lane in lanes if lane != "text"]

    def ends(end: str) -> tuple[Column, Column]:
        text = F.coalesce(*[F.col(f"{end}_{lane}").cast("string") for lane in lanes])
        number = F.coalesce(*[F.col(f"{end}_{lane}").cast("double") for lane in numeric], F.lit(None).cast("double"))
        return text, number

    known = groups.withColumns(
        {
            "groups": F.count("*").over(of_key),
            "total": F.sum("n").over(of_key),
            "place": F.row_number().over(of_key.orderBy(*lanes)),
        }
        | {f"{f.__name__}_{lane}": f(lane).over(of_key) for lane in lanes for f in (F.min, F.max)}
    ).filter((F.col("groups") < gate) | (F.col("place") == 1))
    few, value, number = F.col("groups") < gate, lane_text(lanes), lane_number(lanes)
    (min_text, min_number), (max_text, max_number) = ends("min"), ends("max")
    return known.select(
        *keys,
        F.when(few, F.lit("value")).otherwise(F.lit("column")).alias("stat_kind"),
        F.when(few, value).alias("column_value"),
        F.when(few & value.isNull(), 0).when(few, F.col("n")).otherwise(F.col("total")).cast("bigint").alias("group_count"),
        F.when(few, value).otherwise(min_text).alias("min_value"),
        F.when(few, value).otherwise(max_text).alias("max_value"),
        F.when(few, number).otherwise(min_number).alias("min_number"),
        F.when(few, number).otherwise(max_number).alias("max_number"),
    )


def gated_profile(df: DataFrame, columns: list[str], gate: int = GATE) -> DataFrame:
    """Value rows for columns with fewer than ``gate`` groups, one whole-column row for the others.

    The NULL group counts as a group. An empty slice has no rows.

    A first aggregate, run at once, brings one row to the driver: marked slots of every column and extremes of the numeric
    ones. Columns it proves to reach the gate are done with (text still needs its extremes). Only the others, whose
    values are few, are counted by value, so no column with many values is ever shuffled, and the second scan reads the
    columns that compress best. Their groups decide exactly.
    """
    lanes, spark = lane_map(df, columns), df.sparkSession
    first = [F.count("*").alias("table_count")]
    for i, c in enumerate(columns):
        first += used_slots([one_zero_sql(c, lanes[c])], gate, f"slots{i}")
        first += extremes(c, lanes[c], str(i)) if lanes[c] != "text" else []
    fetched = df.agg(*first).toArrow()
    row = fetched.to_pylist()[0]
    proven = [c for i, c in enumerate(columns) if marked(row, gate, f"slots{i}") >= gate]
    open_ = [c for c in columns if c not in proven]

    frames = []
    done = {c: (str(columns.index(c)), lanes[c]) for c in proven if lanes[c] != "text"}
    if done:
        frames.append(_column_rows(spark.createDataFrame(fetched), done))
    if [c for c in proven if lanes[c] == "text"]:
        frames.append(column_profile(df, [c for c in proven if lanes[c] == "text"]))
    if open_:
        counted = gate_groups(value_groups(df, open_), ["column_no"], lanes_in(df, open_), gate)
        named = counted.withColumns(
            {
                "column_name": column_name_of(F.col("column_no"), open_),
                "table_count": F.lit(row["table_count"]).cast("bigint"),
            }
        )
        frames.append(named.select(*PROFILE_COLUMNS))
    return union_all(frames)
