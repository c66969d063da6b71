"""Control tables: which columns to profile, and the rules to judge them by."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The marks inside ``additional_info``, e.g. ``0<->10000<->500`` for low, high and width.
INFO_MARK = "<->"
DIGITS = "^[0-9]+$"


def local_table(spark: SparkSession, rows: pa.Table) -> DataFrame:
    """Rows at hand as a table. Spark knows its size and broadcasts it, or not, by that."""
    return spark.createDataFrame(rows)


def settle(df: DataFrame) -> DataFrame:
    """A control table read once: plans that use it several times do not read it again."""
    return local_table(df.sparkSession, df.toArrow())


def _info_parts(info: Column) -> Column:
    """Parts of ``additional_info``; empty parts at its end do not count."""
    return F.split(F.regexp_replace(info, "(<->)+$", ""), INFO_MARK)


def parse_requests(requests: DataFrame) -> DataFrame:
    """Add ``request_mode``, ``low``, ``high`` and ``width`` to column requests.

    ``plain``: no bounds, no histogram (not three parts). ``bounded``: a range filter, and a histogram when the width
    is a positive whole number. ``rejected``: three parts with bounds that are no digit strings (empty, negative or
    with decimals); such a request is not profiled. The bounds stay text here; they are cast to the type of the
    column they are compared with.
    """
    parts = _info_parts(F.coalesce("additional_info", F.lit("")))
    three = F.size(parts) == 3
    bounded = three & F.get(parts, F.lit(0)).rlike(DIGITS) & F.get(parts, F.lit(1)).rlike(DIGITS)
    width = F.when(F.get(parts, F.lit(2)).rlike(DIGITS), F.get(parts, F.lit(2)).try_cast("int"))
    return requests.withColumns(
        {
            "request_mode": F.when(bounded, "bounded").when(three, "rejected").otherwise("plain"),
            "low": F.when(bounded, F.get(parts, F.lit(0))),
            "high": F.when(bounded, F.get(parts, F.lit(1))),
            "width": F.when(bounded & (width > 0), width),
        }
    )


def requests_for(requests: DataFrame, project_id: int, scenario_id: int, pipeline_id: int) -> DataFrame:
    return requests.filter(
        (F.col("project_id") == project_id)
        & (F.col("scenario_id") == scenario_id)
        & (F.col("pipeline_id") == pipeline_id)
    )


def rules_for(rules: DataFrame, project_id: int, sub_project_id: int, pipeline_id: int) -> DataFrame:
    return rules.filter(
        (F.col("project_id") == project_id)
        & (F.col("sub_project_id") == sub_project_id)
        & (F.col("pipeline_id") == pipeline_id)
    )


def one_rule_per_column(rules: DataFrame) -> DataFrame:
    """``column_name, rule, trend_rule``: of several rules of a column the one with the smallest text."""
    first = F.min(F.struct("rule", "trend_rule")).alias("first")
    return rules.groupBy("column_name").agg(first).select("column_name", "first.rule", "first.trend_rule")
