"""The manifest of a run: which parts of the result tables it owns, and how far each has come.

A part is one table or side list and one check of a run. A later try of the run may ask for fewer parts; those it no longer
asks for are taken back by the manifest, since nothing in their rows says that they are out of date. Parts are entered before
their rows are written and leave after they are emptied, so a try that breaks off in between is put right by the next one.
"""

from __future__ import annotations

import dataclasses

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.slices import day_column
from ..layout import fit
from .history import PARTS, Run, clear_part, run_ids, run_key_of

# How far a part has come: entered; verdicts written; ended by an error or by missing input.
OPEN, JUDGED, ABORTED = "open", "judged", "aborted"
MANIFEST_SCHEMA = """
    project_id int, sub_project_id int, pipeline_id int, scenario_id int, batch_date date, batch_sequence int,
    table_name string, check_name string, run_key string, state string
"""


@dataclasses.dataclass(frozen=True)
class Part:
    """One part of a run; ``run_key`` names its folder."""

    table_name: str | None
    check_name: str | None
    run_key: str


def parts_of(rows: DataFrame) -> list[Part]:
    """The parts that some rows belong to; a run has one for each control row at most."""
    names = [F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in PARTS]
    found = rows.select(*names, run_key_of(rows).alias("run_key")).distinct().collect()
    return [Part(r.table_name, r.check_name, r.run_key) for r in sorted(found, key=str)]


def _folder(folder: str, run: Run) -> str:
    return f"{folder}/manifest/batch_date={run.batch_date}/run={'-'.join(map(str, run_ids(run)))}"


def read_manifest(spark: SparkSession, folder: str, run: Run) -> dict[Part, str]:
    """The parts of a run with their states; none for a run that has written nothing."""
    try:
        rows = spark.read.schema(MANIFEST_SCHEMA).parquet(_folder(folder, run)).collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return {Part(r.table_name, r.check_name, r.run_key): r.state for r in rows}


def write_manifest(spark: SparkSession, folder: str, run: Run, parts: dict[Part, str]) -> None:
    rows = [(*dataclasses.astuple(part), state) for part, state in parts.items()]
    df = spark.createDataFrame(rows, "table_name string, check_name string, run_key string, state string")
    fit(df.withColumns(run.columns()), MANIFEST_SCHEMA).coalesce(1).write.mode("overwrite").parquet(_folder(folder, run))


def enter(
    spark: SparkSession, folder: str, run: Run, parts: list[Part], state: str = OPEN, held: dict[Part, str] | None = None
) -> dict[Part, str]:
    """Add parts to the manifest, or set their state; returns the manifest. ``held``: what it is now, where that is known."""
    held = read_manifest(spark, folder, run) if held is None else held
    now = held | dict.fromkeys(parts, state)
    if now != held:
        write_manifest(spark, folder, run, now)
    return now


def retract(
    spark: SparkSession, folder: str, run: Run, asked: list[Part], tables: dict[str, str], fmt: str, held: dict[Part, str] | None = None
) -> dict[Part, str]:
    """Empty the parts of a run that are not among ``asked``, in each of ``tables`` (name: layout); returns the manifest."""
    held = read_manifest(spark, folder, run) if held is None else held
    gone = [part for part in held if part not in asked]
    for part in gone:
        for name, layout in tables.items():
            clear_part(spark, f"{folder}/{name}", run, part.run_key, layout, fmt)
    left = {part: state for part, state in held.items() if part in asked}
    if gone:
        write_manifest(spark, folder, run, left)
    return left


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The manifests of all runs, for those who want to know which runs ended early."""
    return spark.read.schema(MANIFEST_SCHEMA + ", run string").parquet(f"{folder}/manifest").drop("run")


def runs_in_state(spark: SparkSession, folder: str, day: str, state: str) -> DataFrame:
    """The parts of one batch date that are in a state, say ``ABORTED``."""
    return manifest(spark, folder).filter((F.col("batch_date") == day_column(day)) & (F.col("state") == state))
