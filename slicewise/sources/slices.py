"""Reading date slices of a table and finding which slices exist."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.slices import Day, date_of, day_column, in_days, on_day, ref, shift


def slice_scan(df: DataFrame, date_column: str, day: Day, columns: list[str] | None = None) -> DataFrame:
    """Rows of one date; all wanted columns come from one scan."""
    rows = df.filter(on_day(df, date_column, day))
    return rows.select(*[ref(c) for c in columns]) if columns else rows


def latest_slice_date(df: DataFrame, date_column: str) -> DataFrame:
    """One row, ``max_date``: the newest date of the table, NULL for an empty one."""
    return df.agg(F.max(ref(date_column)).alias("newest")).select(F.to_date("newest").alias("max_date"))


def slice_probe(df: DataFrame, date_column: str, day: Day) -> DataFrame:
    """One row with the date when the slice has any row, otherwise none; stops at the first row found."""
    return df.filter(on_day(df, date_column, day)).limit(1).select(day_column(day).alias("slice_date"))


def slice_exists(df: DataFrame, date_column: str, days: list[Day]) -> DataFrame:
    """Each asked date with ``present`` true or false, in one pruned scan."""
    asked = df.sparkSession.range(1).select(F.explode(F.array(*[day_column(d) for d in days])).alias("slice_date"))
    found = (
        df.filter(in_days(df, date_column, days))
        .select(date_of(date_column).alias("slice_date"), F.lit(True).alias("found"))
        .distinct()
    )
    return asked.join(found, "slice_date", "left").select("slice_date", F.col("found").isNotNull().alias("present"))


def prior_slice_date(df: DataFrame, date_column: str, start: Day, step: int = -1, max_steps: int = 7) -> DataFrame:
    """One row, ``prior_date``: the first date with rows on the way from ``start`` in strides of ``step`` days.

    The first stride leads to the first candidate and ``max_steps`` more may follow; NULL when none has rows. All
    candidates are looked up in one pruned scan instead of one probe per date.
    """
    if step == 0:
        raise ValueError("the step must not be 0")
    days = [shift(start, step * i) for i in range(1, max_steps + 2)]
    nearest = F.max if step < 0 else F.min
    return df.filter(in_days(df, date_column, days)).agg(nearest(date_of(date_column)).alias("prior_date"))


def table_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def slice_count(df: DataFrame, date_column: str, day: Day) -> DataFrame:
    return table_count(df.filter(on_day(df, date_column, day)))


def latest_slice_count(df: DataFrame, date_column: str) -> DataFrame:
    """Row count of the newest slice. The newest date is a scalar subquery, so a partitioned table is pruned by it."""
    newest = df.agg(F.max(ref(date_column))).scalar()
    dtype = df.schema[date_column].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        day_start = F.date_trunc("day", newest).cast(dtype)
        return table_count(df.filter(ref(date_column) >= day_start))
    return table_count(df.filter(ref(date_column) == newest))


def query_dataset(
    spark: SparkSession, text: str, batch_date: dt.date | str, views: dict[str, DataFrame] | None = None
) -> DataFrame:
    """The result of an SQL text in which ``:batch_date`` stands for the batch date (bound, not spliced in).

    ``views`` are visible to the text under their names while it is read; views of these names are as before afterwards.
    """
    mine = {t.name for t in spark.catalog.listTables() if t.isTemporary} if views else set()
    before = {name: spark.table(name) for name in views or {} if name.lower() in mine}
    try:
        for name, view in (views or {}).items():
            view.createOrReplaceTempView(name)
        return spark.sql(text, args={"batch_date": dt.date.fromisoformat(str(batch_date))})
    finally:
        for name in views or {}:
            spark.catalog.dropTempView(name)
        for name, view in before.items():
            view.createOrReplaceTempView(name)
