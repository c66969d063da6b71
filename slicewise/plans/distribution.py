"""The distribution scenario: profile the requested columns of a slice, keep the profile, judge it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..layout import STATS_SCHEMA, STATUS_SCHEMA, fit
from ..operators.history import Run, clear_part, current_stats, of_scope, read_rows, table_key, to_stats, write_part, write_rows
from ..operators.manifest import ABORTED, JUDGED, OPEN, Part, enter, retract
from ..operators.requests import request_profile
from ..operators.side_by_side import PAIR_GATE, gated_profile_pair, histogram_vs_prior
from ..operators.verdicts import (
    JUDGED_SCHEMA,
    column_settings,
    past_for_settings,
    rule_status,
    run_status,
    validation_rows,
)
from ..session import shared_folder
from ..sources.control import requests_for, rules_for
from ..sources.slices import latest_slice_date, prior_slice_date, slice_probe, slice_scan


def _controls(requests: DataFrame, rules: DataFrame, run: Run, table_name: str) -> tuple[DataFrame, DataFrame]:
    asked = requests_for(requests, run.project_id, run.scenario_id, run.pipeline_id)
    return (
        asked.filter(F.col("table_name") == table_name),
        rules_for(rules, run.project_id, run.sub_project_id, run.pipeline_id),
    )


def profile_slice(observed: DataFrame, date_column: str, table_name: str, requests: DataFrame, run: Run) -> DataFrame:
    """History rows of the batch date."""
    rows = slice_scan(observed, date_column, run.batch_date)
    return to_stats(request_profile(rows, requests), run, table_name)


def judge_stats(history: DataFrame, table_name: str, requests: DataFrame, rules: DataFrame, run: Run) -> DataFrame:
    """Validation rows of the batch date from a history that holds its statistics already."""
    settings = column_settings(requests, rules)
    scope = of_scope(history, run, table_name)
    current = current_stats(scope, run.batch_date, run.batch_sequence)
    past = past_for_settings(scope, settings, run.batch_date)
    return validation_rows(rule_status(current, past, settings), run)


def judge_slice(
    observed: DataFrame,
    date_column: str,
    table_name: str,
    requests: DataFrame,
    rules: DataFrame,
    earlier: DataFrame,
    run: Run,
) -> DataFrame:
    """From request to verdict without result tables; ``earlier`` is the history before this run.

    The statistics of the slice, a few rows per request, are checkpointed: they are both the present and a part of the past,
    and the slice must not be scanned for each.
    """
    requests, rules = _controls(requests, rules, run, table_name)
    shared_folder(observed.sparkSession)
    stats = profile_slice(observed, date_column, table_name, requests, run).checkpoint()
    return judge_stats(fit(earlier, STATS_SCHEMA).unionByName(stats), table_name, requests, rules, run)


def _now() -> str:
    return dt.datetime.now().isoformat(sep=" ", timespec="seconds")


def run_distribution(
    observed: DataFrame,
    date_column: str,
    table_name: str,
    requests: DataFrame,
    rules: DataFrame,
    run: Run,
    folder: str,
    fmt: str = "parquet",
) -> DataFrame:
    """Run the scenario for one table and write ``stats``, ``validation`` and ``status`` under ``folder``.

    Returns the status row of the run, which is judged from the validation rows of all tables the run has written so far.
    Running a table again replaces its rows, also where there are fewer or none now. A batch date without rows, or no request
    at all, ends in an Abort row with a comment and leaves no statistics. An error writes an Abort row, marks the part in the
    run's manifest and is raised again; statistics that are written by then stay, for the averages of later days. Statistics
    are written before they are judged, so that the slice is scanned once for the profile and the verdicts read the small
    history only.
    """
    spark, start = observed.sparkSession, _now()
    requests, rules = _controls(requests, rules, run, table_name)
    part = Part(table_name, None, table_key(run, table_name))

    def abort(comment: str) -> DataFrame:
        told = {"status": F.lit("Abort"), "comments": F.lit(comment), "table_name": F.lit(table_name)}
        write_part(validation_rows(spark.range(1).withColumns(told), run), f"{folder}/validation", run, table_name, fmt)
        enter(spark, folder, run, [part], ABORTED)
        return finish_run(spark, run, folder, fmt, start)

    def nothing(comment: str) -> DataFrame:
        clear_part(spark, f"{folder}/stats", run, part.run_key, STATS_SCHEMA, fmt)
        return abort(comment)

    try:
        held = enter(spark, folder, run, [part], OPEN)
        if requests.isEmpty():
            return nothing("no column request")
        if slice_probe(observed, date_column, run.batch_date).isEmpty():
            return nothing("no rows for the batch date")
        write_part(profile_slice(observed, date_column, table_name, requests, run), f"{folder}/stats", run, table_name, fmt)
        history = read_rows(spark, f"{folder}/stats", STATS_SCHEMA, fmt)
        write_part(judge_stats(history, table_name, requests, rules, run), f"{folder}/validation", run, table_name, fmt)
        enter(spark, folder, run, [part], JUDGED, held)
        return finish_run(spark, run, folder, fmt, start)
    except Exception as error:
        abort(f"error: {type(error).__name__}")
        raise


def finish_run(spark: SparkSession, run: Run, folder: str, fmt: str, start: str) -> DataFrame:
    """Judge a run from the validation rows of all its tables, write the status row and return it as it is stored."""

    def mine(table: str, layout: str, sequence: str) -> DataFrame:
        rows = of_scope(read_rows(spark, f"{folder}/{table}", layout, fmt), run)
        return rows.filter((F.col("batch_date") == F.lit(str(run.batch_date)).cast("date")) & (F.col(sequence) == run.batch_sequence))

    status = run_status(mine("validation", JUDGED_SCHEMA, "batch_sequence"), run, start, _now())
    write_rows(status, f"{folder}/status", fmt)
    return mine("status", STATUS_SCHEMA, "batch_seq_id")


def run_distribution_tables(
    tables: dict[str, tuple[DataFrame, str]],
    requests: DataFrame,
    rules: DataFrame,
    run: Run,
    folder: str,
    fmt: str = "parquet",
) -> DataFrame:
    """Run the scenario for every table that the control rows name; returns the status row of the run.

    ``tables``: name -> (rows, date column). The control rows are all that the run has: statistics and validation rows of
    tables that an earlier try of it wrote and that are no longer asked for are taken back. A table that is not given is an
    error, before anything is written. A table that ends in an error leaves its Abort row and stops the run.
    """
    spark, start = requests.sparkSession, _now()
    asked = requests_for(requests, run.project_id, run.scenario_id, run.pipeline_id)
    names = sorted(r.table_name for r in asked.select("table_name").distinct().collect())
    unknown = [name for name in names if name not in tables]
    if unknown:
        raise ValueError(f"requests name tables that are not given: {', '.join(unknown)}")
    layouts = {"stats": STATS_SCHEMA, "validation": JUDGED_SCHEMA}
    retract(spark, folder, run, [Part(name, None, table_key(run, name)) for name in names], layouts, fmt)
    for name in names:
        status = run_distribution(*tables[name], name, requests, rules, run, folder, fmt)
    if not names:
        told = {"status": F.lit("Abort"), "comments": F.lit("no column request")}
        write_part(validation_rows(spark.range(1).withColumns(told), run), f"{folder}/validation", run, "", fmt)
        enter(spark, folder, run, [Part("", None, table_key(run, ""))], ABORTED)
        status = finish_run(spark, run, folder, fmt, start)
    return status


def compare_with_prior(
    observed: DataFrame,
    date_column: str,
    columns: list[str],
    widths: dict[str, int] | None = None,
    step: int = -1,
    gate: int = PAIR_GATE,
    null_safe: bool = False,
) -> DataFrame:
    """The newest slice beside the nearest earlier one that has rows, with histograms for the columns in ``widths``.

    The two dates are looked up first (one row each), so that the comparison scans exactly two slices.
    """
    present = latest_slice_date(observed, date_column).first()["max_date"]
    if present is None:
        raise ValueError("the table has no slice")
    prior = prior_slice_date(observed, date_column, present, step).first()["prior_date"]
    if prior is None:
        raise ValueError(f"no earlier slice within reach of {present}")
    result = gated_profile_pair(observed, date_column, present, prior, columns, gate, null_safe)
    for column, width in (widths or {}).items():
        ranges = histogram_vs_prior(observed, date_column, present, prior, column, width, null_safe=null_safe)
        result = result.unionByName(ranges.withColumn("stat_kind", F.lit("range")), allowMissingColumns=True)
    return result
