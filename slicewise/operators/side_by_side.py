"""A slice beside an earlier slice, value by value, column by column or bucket by bucket.

Every comparison reads both slices in one scan and counts them in one group-by: a full outer join of two profiles
on the value is the same as one conditional count per value. NULL matches nothing in an equi-join, so the NULL
group of each side is a row of its own unless ``null_safe`` is set.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.lanes import (
    column_name_of,
    lane_map,
    lane_of,
    lane_number,
    lane_text,
    lanes_empty,
    lanes_in,
    unpivot_lanes,
)
from ..functions.ranges import checked_width, range_end, range_label, range_start
from ..functions.slices import Day, day_column, in_days, on_day, ref
from .profiles import as_number, by_text, extremes, marked, one_zero, one_zero_sql, union_all, used_slots

# Both slices must reach this many groups for a whole-column comparison.
PAIR_GATE = 4
SIDE = "is_present"


def two_slices(df: DataFrame, date_column: str, present: Day, prior: Day, columns: list[str]) -> DataFrame:
    """Both slices from one scan, marked by ``is_present``."""
    return df.filter(in_days(df, date_column, [present, prior])).select(
        on_day(df, date_column, present).alias(SIDE), *[ref(c) for c in columns]
    )


def _sides(present: Day, prior: Day, name: Column, cells: dict[str, tuple[Column, Column]]) -> list[Column]:
    """The output cells of both sides; a side without rows (count NULL) is NULL throughout."""
    here, before = cells["group_count"][0].isNotNull(), cells["group_count"][1].isNotNull()
    out = [F.when(here, day_column(present)).alias("dt"), F.when(here, name).alias("column_name")]
    out += [F.when(here, pair[0]).alias(key) for key, pair in cells.items()]
    out += [F.when(before, day_column(prior)).alias("past_dt"), F.when(before, name).alias("past_column_name")]
    out += [F.when(before, pair[1]).alias(f"past_{key}") for key, pair in cells.items()]
    return out


def _null_side(is_null: Column, null_safe: bool) -> Column:
    """A group key that keeps the NULL groups of the two sides apart."""
    side = F.lit(None).cast("boolean") if null_safe else F.when(is_null, F.col(SIDE))
    return side.alias("null_side")


def _count_sides() -> list[Column]:
    return [F.count_if(F.col(SIDE)).alias("here"), F.count_if(~F.col(SIDE)).alias("before")]


def _value_pairs(rows: DataFrame, lanes: list[str], columns: list[str], present: Day, prior: Day, null_safe: bool):
    groups = rows.groupBy("column_no", *lanes, _null_side(lanes_empty(lanes), null_safe)).agg(*_count_sides())
    value, number = lane_text(lanes), lane_number(lanes)

    def count(side: str) -> Column:
        return F.when(F.col(side) > 0, F.when(value.isNull(), 0).otherwise(F.col(side))).cast("bigint")

    cells = {
        "column_value": (value, value),
        "group_count": (count("here"), count("before")),
        "min_value": (value, value),
        "max_value": (value, value),
        "min_number": (number, number),
        "max_number": (number, number),
    }
    return groups.select(*_sides(present, prior, column_name_of(F.col("column_no"), columns), cells))


def value_profile_vs_prior(
    df: DataFrame, date_column: str, present: Day, prior: Day, columns: list[str], null_safe: bool = False
) -> DataFrame:
    """Value groups of two slices, full outer on (column, value)."""
    rows = unpivot_lanes(two_slices(df, date_column, present, prior, columns), columns, keep=[SIDE])
    return _value_pairs(rows, lanes_in(df, columns), columns, present, prior, null_safe)


def _column_pairs(wide: DataFrame, columns: dict[str, tuple[str, str]], present: Day, prior: Day) -> DataFrame:
    """Whole-column rows of both sides from one row of counts and extremes; ``columns``: name -> (alias, lane)."""
    per_column = []
    for name, (alias, lane) in columns.items():
        cells = {"column_value": (F.lit(None).cast("string"),) * 2}
        cells["group_count"] = tuple(F.when(F.col(s) > 0, F.col(s)) for s in ("here", "before"))
        both = {end: [F.col(f"{end}_{alias}_{s}") for s in ("here", "before")] for end in ("min", "max")}
        cells |= {f"{end}_value": tuple(x.cast("string") for x in both[end]) for end in both}
        cells |= {f"{end}_number": tuple(as_number(x, lane) for x in both[end]) for end in both}
        per_column.append(F.struct(*_sides(present, prior, F.lit(name), cells)))
    return wide.filter("here + before > 0").select(F.inline(F.array(*per_column)))


def _side_extremes(name: str, lane: str, alias: str) -> list[Column]:
    here = F.col(SIDE)
    return extremes(name, lane, f"{alias}_here", here) + extremes(name, lane, f"{alias}_before", ~here)


def column_profile_vs_prior(
    df: DataFrame, date_column: str, present: Day, prior: Day, columns: list[str]
) -> DataFrame:
    """Whole-column rows of two slices side by side; one aggregate for all numeric and one for all text columns."""
    lanes, frames = lane_map(df, columns), []
    for part in by_text(df, columns):
        ends = [end for i, c in enumerate(part) for end in _side_extremes(c, lanes[c], str(i))]
        wide = two_slices(df, date_column, present, prior, part).agg(*_count_sides(), *ends)
        frames.append(_column_pairs(wide, {c: (str(i), lanes[c]) for i, c in enumerate(part)}, present, prior))
    return union_all(frames)


def histogram_vs_prior(
    df: DataFrame,
    date_column: str,
    present: Day,
    prior: Day,
    column: str,
    width: int,
    mode: str = "truncate",
    null_safe: bool = False,
) -> DataFrame:
    """Histogram buckets of two slices, full outer on the bucket."""
    width, here = checked_width(width), F.col(SIDE)
    value = F.col("value")
    rows = two_slices(df, date_column, present, prior, [column]).select(
        SIDE,
        one_zero(column, lane_of(df.schema[column].dataType)).alias("value"),
        range_start(ref(column), width, mode).alias("range_start"),
    )
    groups = rows.groupBy("range_start", _null_side(F.col("range_start").isNull(), null_safe)).agg(
        *_count_sides(),
        F.min(F.when(here, value)).alias("min_here"),
        F.max(F.when(here, value)).alias("max_here"),
        F.min(F.when(~here, value)).alias("min_before"),
        F.max(F.when(~here, value)).alias("max_before"),
    )
    start, end = F.col("range_start"), range_end(F.col("range_start"), width)

    def count(side: str) -> Column:
        return F.when(F.col(side) > 0, F.when(start.isNull(), 0).otherwise(F.col(side))).cast("bigint")

    cells = {
        "column_value": (range_label(start, end),) * 2,
        "group_count": (count("here"), count("before")),
        "min_number": (F.col("min_here").cast("double"), F.col("min_before").cast("double")),
        "max_number": (F.col("max_here").cast("double"), F.col("max_before").cast("double")),
        "range_start": (start, start),
        "range_end": (end, end),
    }
    return groups.select(*_sides(present, prior, F.lit(column), cells))


def _reached(sides: DataFrame, columns: list[str], gate: int) -> set[str]:
    """The columns with at least ``gate`` groups on both sides, exactly.

    One aggregate over all columns proves most cases by marked slots, with one row per side fetched. What a side leaves
    open has few values there; those are counted, and one row per open side and column is fetched.
    """
    lanes = lane_map(sides, columns)
    slots = [m for i, c in enumerate(columns) for m in used_slots([one_zero_sql(c, lanes[c])], gate, f"slots{i}")]
    rows = {r[SIDE]: r for r in sides.groupBy(SIDE).agg(*slots).toArrow().to_pylist()}
    if len(rows) < 2:
        return set()
    open_ = {
        c: [side for side in rows if marked(rows[side], gate, f"slots{i}") < gate] for i, c in enumerate(columns)
    }
    reached = {c for c in columns if not open_[c]}
    left = [c for c in columns if open_[c]]
    if left:
        asked = reduce(
            lambda a, b: a | b,
            [(F.col("column_no") == i) & F.col(SIDE).isin(open_[c]) for i, c in enumerate(left)],
        )
        groups = unpivot_lanes(sides, left, keep=[SIDE]).filter(asked).select(SIDE, "column_no", *lanes_in(sides, left))
        counts = groups.distinct().groupBy("column_no", SIDE).agg(F.count("*").alias("n")).collect()
        enough = {(r["column_no"], r[SIDE]) for r in counts if r["n"] >= gate}
        reached |= {c for i, c in enumerate(left) if all((i, side) in enough for side in open_[c])}
    return reached


def gated_profile_pair(
    df: DataFrame,
    date_column: str,
    present: Day,
    prior: Day,
    columns: list[str],
    gate: int = PAIR_GATE,
    null_safe: bool = False,
) -> DataFrame:
    """Whole-column comparison where both slices reach the gate, value comparison for all other columns."""
    reached = _reached(two_slices(df, date_column, present, prior, columns), columns, gate)
    whole = [c for c in columns if c in reached]
    valued = [c for c in columns if c not in reached]
    frames = []
    if whole:
        pairs = column_profile_vs_prior(df, date_column, present, prior, whole)
        frames.append(pairs.withColumn("stat_kind", F.lit("column")))
    if valued:
        pairs = value_profile_vs_prior(df, date_column, present, prior, valued, null_safe)
        frames.append(pairs.withColumn("stat_kind", F.lit("value")))
    return union_all(frames)
