"""Fixed-width histograms of numeric columns.

Rows are counted per bucket before the shuffle, so what is shuffled grows with the number of buckets only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.lanes import lane_of
from ..functions.ranges import checked_width, range_end, range_label, range_start
from ..functions.slices import ref
from .profiles import one_zero


def _buckets(df: DataFrame, value: Column, width: int, mode: str) -> DataFrame:
    rows = df.select(value.alias("value"), range_start(value, width, mode).alias("range_start"))
    return rows.groupBy("range_start").agg(
        F.count("*").alias("rows"), F.min("value").alias("low"), F.max("value").alias("high")
    )


def _layout(buckets: DataFrame, column: str, width: int) -> DataFrame:
    start, end = F.col("range_start"), range_end(F.col("range_start"), width)
    return buckets.select(
        F.lit(column).alias("column_name"),
        F.lit("range").alias("stat_kind"),
        range_label(start, end).alias("column_value"),
        *([F.col("table_count")] if "table_count" in buckets.columns else []),
        F.when(start.isNull(), 0).otherwise(F.col("rows")).cast("bigint").alias("group_count"),
        F.col("low").cast("double").alias("min_number"),
        F.col("high").cast("double").alias("max_number"),
        start.alias("range_start"),
        end.alias("range_end"),
    )


def _numeric(df: DataFrame, column: str) -> Column:
    if lane_of(df.schema[column].dataType) == "text":
        raise TypeError(f"{column} is not numeric")
    return one_zero(column, lane_of(df.schema[column].dataType))


def range_histogram(
    df: DataFrame, column: str, width: int, mode: str = "truncate", sort: bool = False
) -> DataFrame:
    """Count, minimum and maximum per bucket; the bucket of NULL values has no label and count 0.

    ``sort`` orders by the bucket start. (A sort by the label would put ``10 <-> 15`` before ``5 <-> 10``.)
    """
    width = checked_width(width)
    result = _layout(_buckets(df, _numeric(df, column), width, mode), column, width)
    return result.orderBy("range_start") if sort else result


def bounded_histogram(
    df: DataFrame, column: str, low: int, high: int, width: int, mode: str = "truncate"
) -> DataFrame:
    """Histogram of the values in ``low..high``, both ends included, beside the unfiltered row count.

    A value equal to the high bound opens one more bucket. The bounds reach the scan as a filter; the row count is a
    count of its own that reads no profiled column.
    """
    width, value = checked_width(width), _numeric(df, column)
    dtype = df.schema[column].dataType
    kept = ref(column).between(F.lit(low).cast(dtype), F.lit(high).cast(dtype))
    total = df.agg(F.count("*")).scalar()
    buckets = _buckets(df.filter(kept), value, width, mode).withColumn("table_count", total)
    return _layout(buckets, column, width)
