"""Judging statistics against their past and against rules, and summing verdicts up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.gaps import average_gap, change_gap, point_gap, trend_gap
from ..functions.rule_text import ABORT, FAIL, PASS, band_verdict, rule_operator, rule_verdict
from ..functions.slices import Day, day_column
from ..layout import STATUS_SCHEMA, VALIDATION_SCHEMA, fit
from ..sources.control import one_rule_per_column, parse_requests, settle
from .history import STAT_KEYS, Run, average_of

NO_RULE = "no rule for this column"
JUDGED_SCHEMA = VALIDATION_SCHEMA.rstrip() + ", stat_kind string, past_column_value string"


def _join_key(name: str) -> Column:
    """The value to join on: NULL groups match nothing, whole-column rows match each other."""
    return F.when(F.col("stat_kind") == "column", F.lit("")).otherwise(F.col(name))


def pair_with_past(current: DataFrame, past: DataFrame) -> DataFrame:
    """Full outer join of current statistics and past averages on table, column, kind and value."""
    here = current.select(
        *[F.col(k).alias(k) for k in STAT_KEYS], "table_count", "error_records_count", _join_key("column_value").alias("key")
    )
    before = past.select(
        *[F.col(k).alias(f"past_{k}") for k in STAT_KEYS],
        F.col("past_table_count"),
        F.col("past_count"),
        _join_key("column_value").alias("past_key"),
    )
    same = (
        (F.col("table_name") == F.col("past_table_name"))
        & (F.col("column_name") == F.col("past_column_name"))
        & F.col("filter_condition").eqNullSafe(F.col("past_filter_condition"))
        & (F.col("stat_kind") == F.col("past_stat_kind"))
        & (F.col("key") == F.col("past_key"))
    )
    return here.join(before, same, "full_outer").drop("key", "past_key")


def _first(name: str) -> Column:
    return F.coalesce(F.col(name), F.col(f"past_{name}"))


def trend_compare(current: DataFrame, past: DataFrame) -> DataFrame:
    """Current statistics beside past averages; a side without the value counts 0.

    ``column_value`` is NULL for a value seen only in the past, whose name stays in ``past_column_value``.
    """
    return pair_with_past(current, past).select(
        _first("table_name").alias("table_name"),
        _first("column_name").alias("column_name"),
        _first("stat_kind").alias("stat_kind"),
        "column_value",
        "past_column_value",
        *[
            F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
            for c in ("table_count", "error_records_count", "past_table_count", "past_count")
        ],
    )


def with_point_gap(current: DataFrame) -> DataFrame:
    return current.withColumn("error_percentage", point_gap(F.col("table_count"), F.col("error_records_count")))


def with_trend_gaps(compared: DataFrame) -> DataFrame:
    """Gaps of ``trend_compare``; ``change_percentage`` is the extra current-against-past measure."""
    return compared.withColumns(
        {
            "error_percentage": trend_gap(F.col("table_count"), F.col("error_records_count")),
            "average_error_percentage": average_gap(F.col("past_table_count"), F.col("past_count")),
            "change_percentage": change_gap(F.col("error_records_count"), F.col("past_count")),
        }
    )


def with_trend_status(gaps: DataFrame, band: Column) -> DataFrame:
    """``trend_status`` under a band such as ``-15%<->15%``; a NULL gap fails."""
    return gaps.withColumn("trend_status", band_verdict(F.col("average_error_percentage"), band))


def column_settings(requests: DataFrame, rules: DataFrame) -> DataFrame:
    """``column_name, number_of_partitions, rule, trend_rule, has_rule``, one row per requested column.

    Of several requests of a column the longest look-back counts. Rejected requests are left out: they profile
    nothing, so nothing of theirs is judged.
    """
    wanted = (
        parse_requests(requests)
        .filter("request_mode <> 'rejected'")
        .groupBy("column_name")
        .agg(F.max("number_of_partitions").alias("number_of_partitions"))
    )
    rule = one_rule_per_column(rules).withColumn("has_rule", F.lit(True))
    joined = wanted.join(rule, "column_name", "left")
    return settle(joined.withColumn("has_rule", F.coalesce("has_rule", F.lit(False))))


def past_for_settings(history: DataFrame, settings: DataFrame, day: Day) -> DataFrame:
    """Past averages of the columns with a look-back, each over its own window.

    The longest look-back is a scalar subquery on the date column, so folders before it are not read.
    """
    longest = settings.agg(F.coalesce(F.max("number_of_partitions"), F.lit(0))).scalar()
    windows = settings.filter("number_of_partitions > 0").select("column_name", "number_of_partitions")
    rows = history.filter(
        (F.col("batch_date") >= F.date_sub(day_column(day), longest)) & (F.col("batch_date") <= day_column(day))
    ).join(windows, "column_name")
    return average_of(rows.filter(F.col("batch_date") >= F.date_sub(day_column(day), F.col("number_of_partitions"))))


def rule_status(current: DataFrame, past: DataFrame, settings: DataFrame) -> DataFrame:
    """Verdicts of the current statistics under the rule of their column, all columns and both modes in one plan.

    A column with a look-back is judged in trend mode (trend gap under the rule, past averages under the band), any
    other in point mode (point gap under the rule). A rule without an operator gives no rows. A column without a rule
    gives rows with no verdict and a comment.
    """
    trend = F.col("number_of_partitions") > 0
    known_here = F.col("column_name").isNotNull()
    paired = (
        pair_with_past(current, past)
        .withColumn("judged_column", _first("column_name"))
        .join(
            settings.withColumnRenamed("column_name", "setting_column"),
            F.col("judged_column") == F.col("setting_column"),
        )
        .filter(trend | known_here)
        .filter(~F.col("has_rule") | rule_operator(F.col("rule")).isNotNull())
    )
    zero = F.lit(0).cast("bigint")
    table_count, group_count = F.coalesce("table_count", zero), F.coalesce("error_records_count", zero)
    past_table = F.when(trend, F.coalesce("past_table_count", zero))
    past_count = F.when(trend, F.coalesce("past_count", zero))
    gap = F.when(trend, trend_gap(table_count, group_count)).otherwise(point_gap(table_count, group_count))
    past_gap = F.when(trend, average_gap(past_table, past_count))
    judged = paired.select(
        _first("table_name").alias("table_name"),
        _first("filter_condition").alias("filter_condition"),
        F.col("judged_column").alias("column_name"),
        _first("stat_kind").alias("stat_kind"),
        "column_value",
        F.when(trend, F.col("past_column_value")).alias("past_column_value"),
        table_count.alias("table_count"),
        group_count.alias("error_records_count"),
        gap.alias("error_percentage"),
        F.col("rule").alias("threshold_percentage"),
        F.when(F.col("has_rule"), rule_verdict(gap, F.col("rule"))).alias("status"),
        past_table.alias("average_table_count"),
        past_count.alias("average_error_records_count"),
        past_gap.alias("full_average_percentage"),
        F.when(trend, F.col("trend_rule")).alias("trend_threshold_percentage"),
        F.when(~F.col("has_rule"), F.lit(NO_RULE)).alias("comments"),
        "has_rule",
    )
    band = F.col("trend_threshold_percentage")
    return judged.withColumn("trend_status", band_verdict(F.col("full_average_percentage"), band)).withColumn(
        "average_error_percentage", F.col("full_average_percentage").try_cast("bigint")
    )


def validation_rows(judged: DataFrame, run: Run) -> DataFrame:
    """Judged rows in the validation layout; the kind and the past-only value follow as two more columns."""
    tagged = judged.withColumns(run.columns() | {"scenario_name": F.lit(run.scenario_name)})
    return fit(tagged, JUDGED_SCHEMA)



def _scenario_verdict() -> Column:
    no_rule = F.count_if(F.coalesce(F.col("comments") == NO_RULE, F.lit(False)))
    failing = F.count_if(
        F.coalesce(F.col("status") == FAIL, F.lit(False)) | F.coalesce(F.col("trend_status") == FAIL, F.lit(False))
    )
    aborted = F.count_if(F.coalesce(F.col("status") == ABORT, F.lit(False)))
    return F.when(no_rule + aborted > 0, ABORT).when(failing > 0, FAIL).otherwise(PASS)


RUN_KEYS = ["project_id", "sub_project_id", "pipeline_id", "scenario_id", "scenario_name", "batch_date"]


def scenario_status(validation: DataFrame) -> DataFrame:
    """One status row per run found in the validation rows: Abort without a rule, Fail with a failing row, else Pass."""
    rows = validation.groupBy(*RUN_KEYS, F.col("batch_sequence").alias("batch_seq_id")).agg(
        _scenario_verdict().alias("status")
    )
    return fit(rows, STATUS_SCHEMA)


def run_status(validation: DataFrame, run: Run, start_time: str | None = None, end_time: str | None = None) -> DataFrame:
    """The status row of one run, which passes when it has no validation row at all."""
    comment = F.max(F.when(F.col("status") == ABORT, F.col("comments")))
    row = validation.agg(_scenario_verdict().alias("status"), comment.alias("comments"))
    return status_row(row, run, start_time, end_time)


def status_row(row: DataFrame, run: Run, start_time: str | None = None, end_time: str | None = None) -> DataFrame:
    tags = run.columns() | {"scenario_name": F.lit(run.scenario_name)}
    tagged = row.withColumns(
        tags | {"start_time": F.lit(start_time).cast("string"), "end_time": F.lit(end_time).cast("string")}
    )
    return fit(tagged.withColumnRenamed("batch_sequence", "batch_seq_id"), STATUS_SCHEMA)


def run_verdict(statuses: DataFrame) -> DataFrame:
    """One row, ``verdict``: fail on Abort, Fail or no status at all; pass when all are Pass; else NULL."""
    bad = F.count_if(F.col("status").isin(ABORT, FAIL))
    good = F.count_if(F.col("status") == PASS)
    return statuses.agg(
        F.count_distinct("status").alias("n_statuses"),
        F.when((bad > 0) | (F.count("*") == 0), "fail").when(good == F.count("*"), "pass").alias("verdict"),
    )
