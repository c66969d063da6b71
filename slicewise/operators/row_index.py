"""Consecutive row numbers without a window over the whole table."""

from __future__ import annotations

from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.slices import ref
from ..session import shared_folder

# The low bits of ``monotonically_increasing_id`` hold the position inside a partition.
POSITION_BITS = 33


def _numbered(rows: DataFrame, name: str) -> DataFrame:
    """Rows that stay in their partitions, numbered by partition and position."""
    part = F.spark_partition_id().alias("part")
    counts = sorted((r["part"], r["n"]) for r in rows.groupBy(part).agg(F.count("*").alias("n")).collect())
    parts, offsets, total = [], [], 0
    for number, n in counts:
        parts.append(number)
        offsets.append(total)
        total += n
    table = pa.table({"part": pa.array(parts, pa.int32()), "offset": pa.array(offsets, pa.int64())})
    starts = rows.sparkSession.createDataFrame(table)
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    return (
        rows.select("*", part, position.alias("position"))
        .join(starts, "part")
        .withColumn(name, F.col("offset") + F.col("position") + 1)
        .drop("part", "position", "offset")
    )


def key_index(df: DataFrame, order_by: list[str], tie: list[str] | None = None, name: str = "row_index") -> DataFrame:
    """Numbers 1, 2, 3 ... in the order of ``order_by``, then ``tie``: a table of these columns and the number alone.

    Only these columns are read, sorted and written by the checkpoint. Rows that are equal in them follow each other in any
    order; they are spread over partitions, so a frequent key is no hot partition.
    """
    keys = [*order_by, *(c for c in tie or [] if c not in order_by)]
    spread = F.monotonically_increasing_id().alias("__tie")
    rows = df.select(*[ref(c) for c in keys], spread)
    order = [*[ref(c) for c in keys], F.col("__tie")]
    shared_folder(df.sparkSession)
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("__tie")
    return _numbered(rows.checkpoint(eager=True), name)


def row_index(
    df: DataFrame, order_by: list[str] | None = None, name: str = "row_index", settle: bool = True, tie: list[str] | None = None
) -> DataFrame:
    """Number the rows 1, 2, 3 ... in input order, or in the order of ``order_by``.

    Rows are counted per partition, the counts (one number each, to the driver) are added up, and every partition numbers its
    own rows from its offset: no row moves for the numbering.

    With ``order_by`` and ``tie``, columns that together tell all rows apart, the numbers are those of ``key_index``, and the
    rows are joined to them: of a wide table only the keys are sorted and written. Keys that are not unique are an error.

    Otherwise the rows themselves are written by a checkpoint first, since a second read of them may fall into other
    partitions, a file scan too while executors come and go; that costs a copy of the chosen columns. ``settle=False`` leaves
    it out for an input that is settled already. ``order_by`` without ``tie`` range-partitions by the key before; rows with the
    same key are spread by their position in the input, so a frequent key is no hot partition.
    """
    if order_by and tie is not None:
        keys = [*order_by, *(c for c in tie if c not in order_by)]
        index = key_index(df, order_by, tie, "__number")
        if not index.groupBy(*[ref(c) for c in keys]).count().filter("count > 1").isEmpty():
            raise ValueError(f"rows share the key {', '.join(keys)}: name more columns in tie")
        renamed = index.select(*[ref(c).alias(f"__key{i}") for i, c in enumerate(keys)], "__number")
        same = reduce(and_, [ref(c).eqNullSafe(F.col(f"__key{i}")) for i, c in enumerate(keys)])
        return df.join(renamed, same).select(*[ref(c) for c in df.columns], F.col("__number").alias(name))
    rows = df
    if order_by:
        spread = F.monotonically_increasing_id().alias("__tie")
        rows = df.select("*", spread).repartitionByRange(*order_by, "__tie").sortWithinPartitions(*order_by, "__tie").drop("__tie")
    if order_by or settle:
        shared_folder(df.sparkSession)
        rows = rows.checkpoint(eager=True)
    return _numbered(rows, name)
