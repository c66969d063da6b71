"""Row checks and query checks."""

from __future__ import annotations

import dataclasses
import datetime as dt
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.lanes import lanes_empty, lanes_in, unpivot_lanes
from ..functions.rule_text import FAIL, PASS
from ..functions.slices import ref
from ..sources.slices import query_dataset


@dataclasses.dataclass(frozen=True)
class Check:
    """One rule for the values of a column. NULL breaks only ``not_null``."""

    kind: str
    column: str
    values: tuple[Any, ...] = ()
    low: Any = None
    high: Any = None
    pattern: str = ""

    def violated(self) -> Column:
        value = ref(self.column)
        if self.kind == "not_null":
            return value.isNull()
        if self.kind == "in_set":
            return ~value.isin(*self.values)
        if self.kind == "in_range":
            return ~value.between(self.low, self.high)
        if self.kind == "matches":
            return ~value.rlike(self.pattern)
        raise ValueError(f"unknown check: {self.kind}")


def not_null(column: str) -> Check:
    return Check("not_null", column)


def unique(column: str) -> Check:
    return Check("unique", column)


def in_set(column: str, *values: Any) -> Check:
    return Check("in_set", column, values=values)


def in_range(column: str, low: Any, high: Any) -> Check:
    return Check("in_range", column, low=low, high=high)


def matches(column: str, pattern: str) -> Check:
    return Check("matches", column, pattern=pattern)


def _repeated_rows(df: DataFrame, checks: list[tuple[int, Check]]) -> DataFrame:
    """``check_no, repeated``: rows whose value occurs more than once, all unique checks in one group-by."""
    columns = [c.column for _, c in checks]
    lanes = lanes_in(df, columns)
    numbers = F.array(*[F.lit(no) for no, _ in checks])
    return (
        unpivot_lanes(df, columns)
        .filter(~lanes_empty(lanes))
        .groupBy("column_no", *lanes)
        .agg(F.count("*").alias("n"))
        .filter("n > 1")
        .groupBy(F.get(numbers, F.col("column_no")).alias("check_no"))
        .agg(F.sum("n").alias("repeated"))
    )


def dq_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """One row per check with the number of rows that break it; all but the unique checks are counted in one pass."""
    numbered = list(enumerate(checks))
    single = [(no, c) for no, c in numbered if c.kind != "unique"]
    grouped = [(no, c) for no, c in numbered if c.kind == "unique"]
    counts = [F.count_if(c.violated()).alias(f"v{no}") for no, c in single]
    per_check = [
        F.struct(
            F.lit(no).alias("check_no"),
            F.lit(c.kind).alias("check_name"),
            F.lit(c.column).alias("column_name"),
            (F.lit(None).cast("bigint") if c.kind == "unique" else F.col(f"v{no}")).alias("counted"),
        )
        for no, c in numbered
    ]
    rows = df.agg(F.count("*").alias("table_count"), *counts).select("table_count", F.inline(F.array(*per_check)))
    if grouped:
        rows = rows.join(_repeated_rows(df, grouped), "check_no", "left")
    else:
        rows = rows.withColumn("repeated", F.lit(None).cast("bigint"))
    failing = F.coalesce("counted", "repeated", F.lit(0).cast("bigint"))
    return rows.select(
        "check_no",
        "check_name",
        "column_name",
        "table_count",
        failing.alias("failing_rows"),
        (F.try_divide(failing.cast("double"), F.col("table_count").cast("double")) * 100).alias("failing_percentage"),
        F.when(failing == 0, PASS).otherwise(FAIL).alias("status"),
    )


def custom_query(
    spark: SparkSession, text: str, batch_date: dt.date | str, views: dict[str, DataFrame] | None = None
) -> DataFrame:
    """One row for a query that returns violating rows: how many there are, and Pass when there is none."""
    found = query_dataset(spark, text, batch_date, views)
    return found.agg(
        F.count("*").alias("n_violations"), F.when(F.count("*") == 0, PASS).otherwise(FAIL).alias("status")
    )
