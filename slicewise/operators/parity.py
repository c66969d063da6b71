"""Agreement between sides: the same table or query in different places.

``sides`` maps a label to its DataFrame, in order; the last side is the one that the others are held against in
``result_set_parity``. A side that could not be read is None: it has no counts and its checks fail.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.rule_text import FAIL, PASS
from ..functions.slices import Day, on_day, ref
from ..sources.slices import query_dataset

# Marks between the counts of sides, the JSON rows of a side, and the sides.
COUNT_MARK, ROW_MARK, SIDE_MARK = "||", ";", "|||"

Sides = dict[str, DataFrame | None]


def _any_session(sides: Sides) -> SparkSession:
    for side in sides.values():
        if side is not None:
            return side.sparkSession
    return SparkSession.active()


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def slice_sides(sides: Sides, date_column: str, day: Day) -> Sides:
    """The same slice of every side."""
    return {k: None if v is None else v.filter(on_day(v, date_column, day)) for k, v in sides.items()}


def side_shapes(sides: Sides, count_rows: bool = True) -> DataFrame:
    """``side_no, side, n_rows, n_columns``: one count per side, which needs no column of it.

    Without ``count_rows`` no side is read: ``n_rows`` is NULL, and column counts come from the schema.
    """
    spark = _any_session(sides)
    shapes = []
    for number, (label, side) in enumerate(sides.items()):
        counted = spark.range(1) if side is None or not count_rows else side.agg(F.count("*").alias("n"))
        shapes.append(
            counted.select(
                F.lit(number).alias("side_no"),
                F.lit(label).alias("side"),
                (F.lit(None) if side is None or not count_rows else F.col("n")).cast("bigint").alias("n_rows"),
                F.lit(None if side is None else len(side.columns)).cast("bigint").alias("n_columns"),
            )
        )
    return _union(shapes)


COUNTS = {"Record Count": "n_rows", "Column Count": "n_columns"}


def shape_parity(sides: Sides, checks: tuple[str, ...] = tuple(COUNTS)) -> DataFrame:
    """Row-count and column-count check: Pass when all sides have the same count and none is missing."""
    asked = [F.struct(F.lit(c).alias("check_name"), F.col(COUNTS[c]).alias("n")) for c in checks]
    checks = side_shapes(sides, "Record Count" in checks).select("side_no", F.inline(F.array(*asked)))
    # At most one entry per side is collected.
    listed = F.array_sort(F.collect_list(F.struct("side_no", F.coalesce(F.col("n").cast("string"), F.lit("NA")).alias("t"))))
    agree = (F.count("n") == F.count("*")) & (F.count_distinct("n") == 1)
    return checks.groupBy("check_name").agg(
        F.count_distinct("n").alias("n_distinct"),
        F.array_join(F.transform(listed, lambda s: s["t"]), COUNT_MARK).alias("side_counts"),
        F.when(agree, PASS).otherwise(FAIL).alias("status"),
    )


def query_parity(spark: SparkSession, queries: dict[str, str], batch_date, views: dict[str, DataFrame] | None = None) -> DataFrame:
    """``shape_parity`` of SQL texts, each with ``:batch_date`` bound."""
    return shape_parity({label: query_dataset(spark, text, batch_date, views) for label, text in queries.items()})


def first_rows(df: DataFrame, limit: int) -> DataFrame:
    """The first rows in the order of all columns, so that the choice is the same every time."""
    return df.orderBy(*[ref(c) for c in df.columns]).limit(limit)


def result_set_parity(sides: dict[str, DataFrame], limit: int | None = None) -> DataFrame:
    """Pass when every cell of every side occurs among the cells of the last side.

    Cells are compared as text; their column, row and number do not matter, and NULL is a cell. ``limit`` takes the first
    rows of each side only. Cells are reduced per task before the shuffle, so a frequent cell is no hot key.
    """
    last = len(sides) - 1
    cells = []
    for number, side in enumerate(sides.values()):
        rows = side if limit is None else first_rows(side, limit)
        cell = F.explode(F.array(*[ref(c).cast("string") for c in rows.columns])).alias("cell")
        cells.append(rows.select(cell).withColumn("in_last", F.lit(number == last)))
    known = _union(cells).groupBy("cell").agg(F.max("in_last").alias("in_last"))
    return known.agg(
        F.count("*").alias("n_cells"),
        F.count_if("in_last").alias("n_last_cells"),
        F.when(F.count("*") == F.count_if("in_last"), PASS).otherwise(FAIL).alias("status"),
    )


def result_json(sides: dict[str, DataFrame], limit: int) -> DataFrame:
    """One row, ``result``: the first rows of each side as JSON, joined in order.

    Needs a limit, since the text of a side is put together in one place.
    """
    if limit is None or limit < 1:
        raise ValueError("the number of rows per side must be positive")
    texts = []
    for number, side in enumerate(sides.values()):
        rows = first_rows(side, limit)
        columns = [ref(c).alias(f"k{i}") for i, c in enumerate(rows.columns)]
        entry = F.struct(*columns, F.to_json(F.struct(*[ref(c) for c in rows.columns])).alias("json"))
        ordered = F.sort_array(F.collect_list(entry))
        texts.append(
            rows.agg(F.array_join(F.transform(ordered, lambda e: e["json"]), ROW_MARK).alias("text")).select(
                F.lit(number).alias("side_no"), "text"
            )
        )
    listed = F.array_sort(F.collect_list(F.struct("side_no", "text")))
    return _union(texts).agg(F.array_join(F.transform(listed, lambda s: s["text"]), SIDE_MARK).alias("result"))


def parity_status(verdicts: DataFrame) -> DataFrame:
    """One row, ``status``: Fail when any side list failed, else Pass."""
    return verdicts.agg(F.when(F.bool_or(F.col("status") == FAIL), FAIL).otherwise(PASS).alias("status"))
