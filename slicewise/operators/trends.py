"""Trends over the slices of a table. The windows run over daily aggregates, never over rows of the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from ..functions.gaps import change_gap
from ..functions.lanes import column_name_of, lane_number, lane_text, lanes_empty, lanes_in, unpivot_lanes
from ..functions.rule_text import band_verdict
from ..functions.slices import Day, between_days, date_of, day_column, ref
from ..layout import fit
from .history import SCOPE, STAT_KEYS, Run, of_runs, of_scope
from .profiles import by_text, text_end, union_all, value_groups

DAY = "batch_date"
DAILY_SCHEMA = """
    batch_date date, column_name string, n_rows bigint, n_null bigint, n_distinct bigint, min_value string,
    max_value string, min_number double, max_number double, mean_number double, null_share double
"""


def _days(df: DataFrame, date_column: str, columns: list[str]) -> DataFrame:
    return df.select(date_of(date_column).alias(DAY), *[ref(c) for c in columns])


def _past(look_back: int, *keys: str) -> WindowSpec:
    """The ``look_back`` calendar days before the row's own day; days without rows do not count."""
    if look_back < 1:
        raise ValueError("the look-back must be at least one day")
    return Window.partitionBy(*keys).orderBy(F.unix_date(DAY)).rangeBetween(-look_back, -1)


def _verdict(gap: Column, band: str | None) -> Column:
    """No past, no verdict."""
    return F.when(gap.isNotNull(), band_verdict(gap, F.lit(band).cast("string")))


def table_trend(df: DataFrame, date_column: str, table_name: str, look_back: int, band: str) -> DataFrame:
    """Rows per date against the average of the days before, change in percent, and verdict under a band."""
    daily = _days(df, date_column, []).groupBy(DAY).agg(F.count("*").alias("n_rows"))
    named = daily.withColumn("table_name", F.lit(table_name))
    past = F.avg("n_rows").over(_past(look_back, "table_name"))
    return (
        named.withColumn("past_average", past)
        .withColumn("change_percentage", change_gap(F.col("n_rows"), F.col("past_average")))
        .withColumn("status", _verdict(F.col("change_percentage"), band))
    )


def column_trend(
    df: DataFrame, date_column: str, columns: list[str], look_back: int, exact_distinct: bool = True
) -> DataFrame:
    """Null share, distinct values, extremes and mean per column and date, with the past averages of three of them.

    The exact distinct count groups by value first, which shuffles as many rows as there are values per day; with
    ``exact_distinct=False`` an approximate count needs one small row per task.
    """
    past = _past(look_back, "column_name")
    daily = union_all([_daily(df, date_column, part, exact_distinct) for part in by_text(df, columns)])
    return daily.withColumns(
        {
            "past_null_share": F.avg("null_share").over(past),
            "past_distinct": F.avg("n_distinct").over(past),
            "past_mean": F.avg("mean_number").over(past),
        }
    )


def _daily(df: DataFrame, date_column: str, columns: list[str], exact_distinct: bool) -> DataFrame:
    """Daily facts of columns that are all numeric or all text."""
    lanes = lanes_in(df, columns)
    is_text, days = lanes == ["text"], _days(df, date_column, columns)
    if exact_distinct:
        cells = value_groups(days, columns, keep=[DAY])
        distinct = F.count_if(~F.col("empty"))
    else:
        cells = unpivot_lanes(days, columns, keep=[DAY]).withColumn("n", F.lit(1))
        distinct = F.approx_count_distinct("text") if is_text else F.approx_count_distinct("number")
    cells = cells.withColumns({"empty": lanes_empty(lanes), "number": lane_number(lanes)})
    filled = F.sum(F.when(F.col("number").isNotNull(), F.col("n"))).cast("double")
    daily = (
        cells.groupBy(DAY, "column_no")
        .agg(
            F.sum("n").alias("n_rows"),
            F.sum(F.when(F.col("empty"), F.col("n")).otherwise(0)).alias("n_null"),
            distinct.alias("n_distinct"),
            *([text_end(F.min, "text").alias("min_value"), text_end(F.max, "text").alias("max_value")] if is_text else []),
            F.min("number").alias("min_number"),
            F.max("number").alias("max_number"),
            F.try_divide(F.sum(F.col("number") * F.col("n")), filled).alias("mean_number"),
        )
        .withColumn("column_name", column_name_of(F.col("column_no"), columns))
        .withColumn("null_share", F.col("n_null").cast("double") / F.col("n_rows").cast("double"))
    )
    return fit(daily, DAILY_SCHEMA)


def column_value_trend(df: DataFrame, date_column: str, columns: list[str], look_back: int) -> DataFrame:
    """Count per value and date against the average count of the same value on the days before.

    Days on which the value is absent do not count, as in the history average. NULL is a value with count 0.
    """
    lanes = lanes_in(df, columns)
    daily = value_groups(_days(df, date_column, columns), columns, keep=[DAY])
    shown = daily.select(
        DAY,
        column_name_of(F.col("column_no"), columns).alias("column_name"),
        lane_text(lanes).alias("column_value"),
        F.when(lanes_empty(lanes), 0).otherwise(F.col("n")).cast("bigint").alias("group_count"),
    )
    past = F.avg("group_count").over(_past(look_back, "column_name", "column_value"))
    return shown.withColumn("past_average", past).withColumn(
        "change_percentage", change_gap(F.col("group_count"), F.col("past_average"))
    )


def zero_slices(df: DataFrame, date_column: str, low: Day, high: Day) -> DataFrame:
    """Dates of the span, both ends included, on which the table has no row."""
    span = F.sequence(day_column(low), day_column(high))
    spine = df.sparkSession.range(1).select(F.explode(span).alias("slice_date"))
    present = (
        df.filter(between_days(df, date_column, low, high)).select(date_of(date_column).alias("slice_date")).distinct()
    )
    return spine.join(present, "slice_date", "left_anti")


def threshold_suggest(history: DataFrame, spread: float = 3.0, scope: Run | None = None, runs: str = "all") -> DataFrame:
    """Mean and standard deviation of the stored group counts per statistic, and mean plus or minus ``spread`` of it.

    Statistics of different projects, sub-projects, pipelines or scenarios are never mixed; with ``scope`` only those of
    that run's scenario are taken. ``runs="all"`` counts every stored row, so a date that was run again counts again;
    ``"newest"`` takes the newest run of each date.
    """
    rows = of_scope(history, scope) if scope else history
    counts = of_runs(rows, runs).groupBy(*SCOPE, *STAT_KEYS).agg(
        F.count("*").alias("n_stored"),
        F.avg("error_records_count").alias("mean_count"),
        F.stddev_samp("error_records_count").alias("stddev_count"),
    )
    reach = F.lit(float(spread)) * F.col("stddev_count")
    return counts.withColumns(
        {"suggested_low": F.col("mean_count") - reach, "suggested_high": F.col("mean_count") + reach}
    )
