"""The history of column statistics: writing it, reading it back, and its averages.

A written row belongs to one run (project, sub-project, pipeline, scenario, batch date, sequence), in it to one table or
side list, and there to one check. Tables are laid out by ``batch_date`` and ``run_key``, which names all of these; writing
the same part of a run again replaces its rows and no others, so neither a repeated job nor a lost executor leaves a run in
the table twice. A run with a new sequence adds to the history.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.lanes import column_name_of, lane_number, lane_text, lanes_in
from ..functions.slices import Day, date_of, day_column, ref, shift
from ..layout import STATS_SCHEMA, fit
from .profiles import value_groups

# What makes two statistics of different dates the same statistic.
STAT_KEYS = ["table_name", "column_name", "filter_condition", "stat_kind", "column_value"]
SCOPE = ["project_id", "sub_project_id", "pipeline_id", "scenario_id"]
PARTITIONS = ["batch_date", "run_key"]
# What a run is written in parts by, where a table has these columns.
PARTS = ["table_name", "check_name"]
# NULL is written as a mark of its own, so that an empty text stays one.
CSV = {"header": True, "escape": '"', "nullValue": "\\N"}


@dataclasses.dataclass(frozen=True)
class Run:
    """The identity of one scenario run."""

    project_id: int
    sub_project_id: int
    pipeline_id: int
    scenario_id: int
    batch_date: dt.date | str
    batch_sequence: int
    scenario_name: str = ""

    def columns(self) -> dict[str, Column]:
        ids = ["project_id", "sub_project_id", "pipeline_id", "scenario_id", "batch_sequence"]
        return {name: F.lit(getattr(self, name)).cast("int") for name in ids} | {
            "batch_date": day_column(self.batch_date)
        }


def to_stats(profile: DataFrame, run: Run, table_name: str) -> DataFrame:
    """Profile rows as history rows of a run. The group count keeps the name it has in the history layout."""
    tags = {"table_name": F.lit(table_name)}
    if "additional_info" in profile.columns:  # bounds and width tell requests of one column apart
        tags["filter_condition"] = F.expr("nullif(additional_info, 'NA')")
    tagged = profile.withColumns(run.columns() | tags)
    return fit(tagged.withColumnRenamed("group_count", "error_records_count"), STATS_SCHEMA)


def stats_of_all_slices(df: DataFrame, date_column: str, columns: list[str], run: Run, table_name: str) -> DataFrame:
    """Value statistics of every slice in one pass, as history rows dated by their slice.

    Fills a history at the start, for columns that are profiled by value.
    """
    lanes = lanes_in(df, columns)
    days = df.select(date_of(date_column).alias("batch_date"), *[ref(c) for c in columns])
    totals = days.groupBy(F.col("batch_date").alias("day")).agg(F.count("*").alias("table_count"))
    groups = value_groups(days, columns, keep=["batch_date"]).join(totals, F.expr("batch_date <=> day"))
    value, number = lane_text(lanes), lane_number(lanes)
    rows = groups.select(
        "batch_date",
        column_name_of(F.col("column_no"), columns).alias("column_name"),
        F.lit("value").alias("stat_kind"),
        value.alias("column_value"),
        "table_count",
        F.when(value.isNull(), 0).otherwise(F.col("n")).alias("error_records_count"),
        value.alias("min_value"),
        value.alias("max_value"),
        number.alias("min_number"),
        number.alias("max_number"),
    )
    tags = {name: column for name, column in run.columns().items() if name != "batch_date"}
    return fit(rows.withColumns(tags | {"table_name": F.lit(table_name)}), STATS_SCHEMA)


def run_key_of(df: DataFrame) -> Column:
    sequence = "batch_sequence" if "batch_sequence" in df.columns else "batch_seq_id"
    ids = ["project_id", "sub_project_id", "pipeline_id", "scenario_id", sequence]
    parts = [F.coalesce(F.col(c), F.lit("x")) if c in df.columns else F.lit("x") for c in PARTS]
    ids = [F.coalesce(F.col(i).cast("string"), F.lit("x")) for i in ids]
    return F.concat_ws("-", *ids, F.md5(F.concat_ws("\n", *parts).cast("binary")))


def run_ids(run: Run) -> list[int]:
    return [run.project_id, run.sub_project_id, run.pipeline_id, run.scenario_id, run.batch_sequence]


def table_key(run: Run, table_name: str) -> str:
    """The ``run_key`` of the rows of one table in one run."""
    part = hashlib.md5("\n".join([table_name, *["x"] * (len(PARTS) - 1)]).encode()).hexdigest()
    return "-".join([*map(str, run_ids(run)), part])


def write_part(
    df: DataFrame, path: str, run: Run, table_name: str, fmt: str = "parquet", run_key: str | None = None
) -> None:
    """Write all rows of one table of a run, replacing what an earlier try of it wrote, also if there are none now."""
    writer = df.drop("batch_date").write.format(fmt).mode("overwrite")
    key = run_key or table_key(run, table_name)
    (writer.options(**CSV) if fmt == "csv" else writer).save(f"{path}/batch_date={run.batch_date}/run_key={key}")


def clear_part(spark: SparkSession, path: str, run: Run, run_key: str, layout: str, fmt: str = "parquet") -> None:
    """Leave a part of a run without rows."""
    write_part(fit(spark.createDataFrame([], layout), layout), path, run, "", fmt, run_key)


def write_rows(df: DataFrame, path: str, fmt: str = "parquet", replace_runs: bool = True) -> None:
    """Write statistics, validation rows or scenario statuses (``fmt``: parquet, orc, csv, json).

    ``replace_runs=False`` appends without replacing, as a plain append does.
    """
    writer = df.withColumn("run_key", run_key_of(df)).write.format(fmt).partitionBy(*PARTITIONS)
    if fmt == "csv":
        writer = writer.options(**CSV)
    if replace_runs:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").save(path)
    else:
        writer.mode("append").save(path)


def write_table(df: DataFrame, name: str, fmt: str = "parquet", replace_runs: bool = True) -> None:
    """As ``write_rows``, to a table of the catalog, which is made with the same folders when it does not exist."""
    spark, rows = df.sparkSession, df.withColumn("run_key", run_key_of(df))
    if not spark.catalog.tableExists(name):
        rows.write.format(fmt).partitionBy(*PARTITIONS).saveAsTable(name)
        return
    ordered = rows.select(*spark.table(name).columns)
    if not replace_runs:
        ordered.write.insertInto(name)
        return
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        ordered.write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)


def read_rows(spark: SparkSession, path: str, ddl: str, fmt: str = "parquet") -> DataFrame:
    """Read a written table with its layout; a filter on ``batch_date`` prunes folders."""
    reader = spark.read.format(fmt).schema(f"{ddl.strip()}, run_key string")
    if fmt == "csv":
        reader = reader.options(multiLine=True, **CSV)
    return reader.load(path).drop("run_key")


def of_scope(history: DataFrame, run: Run, table_name: str | None = None) -> DataFrame:
    """History rows of the same project, sub-project, pipeline and scenario (and table)."""
    mine = [F.col(name) == getattr(run, name) for name in SCOPE]
    if table_name:
        mine.append(F.col("table_name") == table_name)
    return history.filter(reduce(lambda a, b: a & b, mine))


def current_stats(history: DataFrame, day: Day, batch_sequence: int) -> DataFrame:
    return history.filter((F.col("batch_date") == day_column(day)) & (F.col("batch_sequence") == batch_sequence))


def past_stats(history: DataFrame, day: Day, look_back: int) -> DataFrame:
    """Rows of the last ``look_back`` days and of the day itself, both ends included."""
    return history.filter(F.col("batch_date").between(shift(day, -look_back), day_column(day)))


def newest_runs(history: DataFrame) -> DataFrame:
    """Only the rows of the highest sequence of each scope, table and date; an older run's rows go with it."""
    keys = [*SCOPE, "batch_date", "table_name"]
    newest = history.groupBy(*[F.col(k).alias(f"newest_{k}") for k in keys]).agg(F.max("batch_sequence").alias("newest"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"newest_{k}")) for k in keys])
    return history.join(newest, same & F.col("batch_sequence").eqNullSafe(F.col("newest")), "left_semi")


def of_runs(history: DataFrame, runs: str) -> DataFrame:
    """``all`` stored rows, or those of the ``newest`` run of each date."""
    if runs not in ("all", "newest"):
        raise ValueError(f"unknown choice of runs: {runs}")
    return newest_runs(history) if runs == "newest" else history


def average_of(rows: DataFrame) -> DataFrame:
    """Past averages per statistic over the stored rows, cut to whole numbers."""
    return rows.groupBy(*STAT_KEYS).agg(
        F.avg("table_count").cast("bigint").alias("past_table_count"),
        F.avg("error_records_count").cast("bigint").alias("past_count"),
    )


def history_average(history: DataFrame, day: Day, look_back: int, runs: str = "all") -> DataFrame:
    """Average table count and group count per statistic over the past window, today included.

    ``runs="all"`` weighs every stored row the same, so a repeated date counts again; ``"newest"`` takes the newest run
    of each date.
    """
    return average_of(of_runs(past_stats(history, day, look_back), runs))
