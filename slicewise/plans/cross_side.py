"""The parity scenarios: the same table or query on several sides."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..layout import VALIDATION_SCHEMA, fit
from ..operators.history import Run, of_scope, read_rows, write_rows
from ..operators.manifest import JUDGED, enter, parts_of, retract
from ..operators.parity import (
    SIDE_MARK,
    Sides,
    parity_status,
    result_json,
    result_set_parity,
    shape_parity,
    slice_sides,
)
from ..operators.verdicts import status_row
from ..sources.control import requests_for, settle

# Fixed value: the check id of a row count; any other check counts columns.
RECORD_COUNT_CHECK = 12
# Ours: the check id of a result comparison in control rows.
RESULT_CHECK = 20


def _rows(verdicts: DataFrame, sides: Sides, run: Run) -> DataFrame:
    tags = run.columns() | {
        "table_name": F.lit(SIDE_MARK.join(sides)),
        "scenario_name": F.lit(run.scenario_name),
    }
    return fit(verdicts.withColumns(tags), VALIDATION_SCHEMA)


def shape_validation(sides: Sides, run: Run, check_id: int | None = None) -> DataFrame:
    """Validation rows of the row and column counts (of one of them when ``check_id`` is given)."""
    if check_id is None:
        return _rows(shape_parity(sides).withColumnRenamed("side_counts", "comments"), sides, run)
    wanted = "Record Count" if check_id == RECORD_COUNT_CHECK else "Column Count"
    verdicts = shape_parity(sides, (wanted,)).withColumnRenamed("side_counts", "comments")
    return _rows(verdicts.withColumn("check_id", F.lit(str(check_id))), sides, run)


def result_validation(sides: dict[str, DataFrame], run: Run, limit: int) -> DataFrame:
    """The validation row of a result comparison, with the results as JSON in the comment."""
    verdict = result_set_parity(sides, limit).withColumn("comments", result_json(sides, limit).scalar())
    return _rows(verdict.withColumn("check_name", F.lit("Result")), sides, run)


def _now() -> str:
    return dt.datetime.now().isoformat(sep=" ", timespec="seconds")


def run_parity(validation: DataFrame, run: Run, folder: str, fmt: str = "parquet", complete: bool = False) -> DataFrame:
    """Write validation rows and the scenario status; returns the status row.

    A side list and check written before under this run is replaced, others stay, and the status sums all of them up. With
    ``complete`` the rows are all that the run has: what earlier tries of it wrote beyond them is taken back. An error ends in
    an Abort row and is raised again.
    """
    spark, start = validation.sparkSession, _now()
    try:
        validation = settle(validation)  # one row for each side list and check
        asked = parts_of(validation)
        held = enter(spark, folder, run, asked)
        write_rows(validation, f"{folder}/validation", fmt)
        if complete:
            held = retract(spark, folder, run, asked, {"validation": VALIDATION_SCHEMA}, fmt, held)
        enter(spark, folder, run, asked, JUDGED, held)
        kept = of_scope(read_rows(spark, f"{folder}/validation", VALIDATION_SCHEMA, fmt), run).filter(
            (F.col("batch_date") == F.lit(str(run.batch_date)).cast("date"))
            & (F.col("batch_sequence") == run.batch_sequence)
        )
        status = parity_status(kept).first()["status"]
        row = status_row(spark.range(1).select(F.lit(status).alias("status")), run, start, _now())
        write_rows(row, f"{folder}/status", fmt)
        return row
    except Exception as error:
        told = {"status": F.lit("Abort"), "comments": F.lit(f"error: {type(error).__name__}")}
        write_rows(status_row(spark.range(1).select(*[c.alias(n) for n, c in told.items()]), run, start, _now()), f"{folder}/status", fmt)
        raise


def run_parity_requests(
    requests: DataFrame,
    tables: dict[str, Sides],
    run: Run,
    folder: str,
    fmt: str = "parquet",
    result_check: int = RESULT_CHECK,
) -> DataFrame:
    """One parity scenario from control rows; returns the status row.

    Each request names a side list by ``table_name`` (a key of ``tables``) and a check: ``check_id`` 12 counts rows,
    ``result_check`` compares cells and takes its number of rows from ``filter_condition``, any other counts columns. With
    ``date_partition_columns`` the batch date's slice of each side is taken. All rows are written together. Requests that name
    no known list end in an Abort row and an error. The control rows are all that the run has: rows of checks that an earlier
    try of it wrote and that are no longer asked for are taken back, and count for its status no more.
    """
    asked = requests_for(requests, run.project_id, run.scenario_id, run.pipeline_id)
    # Control rows, one per side list and check.
    rows = asked.select("table_name", "check_id", "date_partition_columns", "filter_condition").distinct().collect()
    frames = []
    for row in sorted(rows, key=str):
        if row.table_name not in tables:
            run_parity_abort(asked.sparkSession, run, folder, fmt, f"no sides for {row.table_name}")
            raise ValueError(f"requests name a side list that is not given: {row.table_name}")
        sides, column = tables[row.table_name], (row.date_partition_columns or "NA").strip()
        if column not in ("", "NA"):
            sides = slice_sides(sides, column, run.batch_date)
        if row.check_id == result_check:
            frame = result_validation(sides, run, int(row.filter_condition)).withColumn("check_id", F.lit(str(row.check_id)))
        else:
            frame = shape_validation(sides, run, row.check_id)
        frames.append(fit(frame.withColumn("table_name", F.lit(row.table_name)), VALIDATION_SCHEMA))
    if not frames:
        retract(asked.sparkSession, folder, run, [], {"validation": VALIDATION_SCHEMA}, fmt)
        return run_parity_abort(asked.sparkSession, run, folder, fmt, "no parity request")
    return run_parity(reduce(DataFrame.unionByName, frames), run, folder, fmt, complete=True)


def run_parity_abort(spark: SparkSession, run: Run, folder: str, fmt: str, comment: str) -> DataFrame:
    """Write and return an Abort row."""
    told = spark.range(1).select(F.lit("Abort").alias("status"), F.lit(comment).alias("comments"))
    row = status_row(told, run, _now(), _now())
    write_rows(row, f"{folder}/status", fmt)
    return row
