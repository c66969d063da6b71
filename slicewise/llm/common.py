"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import scratch_path

FILTER_BITS = 1 << 26

# White space of a word split, as a pattern of both Java and Python.
SPACES = r"[\x20\x09-\x0D]+"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, tidy: bool = False) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, safe from lost executors, lineage cut.

    With ``tidy`` the shuffle files of the job go as soon as the table is complete; nothing reads them again.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true" if tidy else before)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def words_of(text: Column) -> Column:
    """The words of a text, split at ASCII white space; NULL has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once a row, also where ``body`` names it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """What tells rows apart: equal rows share it, rows of one id with different texts don't."""
    return [F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text).isNull(), F.col(text)).alias("text_key")]


def same_row(left: DataFrame, right: DataFrame) -> Column:
    """Equality on ``row_key``; a NULL id equals a NULL id."""
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["text_key"] == right["text_key"])


def likely_rows(rows: DataFrame, keys: DataFrame, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """The ``rows`` whose ``key`` is one of ``keys``, and a few others; they stay where they are.

    ``keys`` are hashed into ``bits`` bits, one row for each 64 of them with a key: 1,048,576 rows of 16 bytes at most, which are
    broadcast. With many more keys than bits all rows pass, so an exact join has to follow.
    """
    bit = F.pmod(F.xxhash64(key), F.lit(bits))
    marked = keys.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("of_slot"))
    slots = written(marked.agg(F.expr("bit_or(shiftleft(1L, CAST(bit & 63 AS INT)))").alias("mask")), "filter")
    placed = rows.select(F.struct(*rows.columns).alias("row"), bit.alias("bit"))
    met = placed.join(F.broadcast(slots), F.shiftright("bit", 6) == F.col("of_slot"))
    return met.filter("shiftrightunsigned(mask, CAST(bit & 63 AS INT)) & 1L = 1").select("row.*")


def dealt_out(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows sorted by keys, equal ones together, in as many tasks as a shuffle has.

    Their number is given, since adaptive execution would merge tasks by their bytes, which are few where comparing costs.
    """
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(width, *keys).sortWithinPartitions(*keys)


def runs(batches: Iterable[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The rows of each run of equal keys, from batches sorted by them; a run may go on in the next batch."""
    kept: list[pd.DataFrame] = []
    for batch in batches:
        if batch.empty:
            continue
        new = np.zeros(len(batch), dtype=bool)
        for key in keys:
            values = batch[key].to_numpy()
            new[1:] |= values[1:] != values[:-1]
            new[0] |= not kept or kept[-1][key].iloc[-1] != values[0]
        starts = np.flatnonzero(new)
        if not len(starts):
            kept.append(batch)
            continue
        head = batch.iloc[: starts[0]]
        if kept:
            yield pd.concat([*kept, head]) if len(head) else pd.concat(kept)
        for a, b in zip(starts[:-1], starts[1:]):
            yield batch.iloc[a:b]
        kept = [batch.iloc[starts[-1] :]]
    if kept:
        yield pd.concat(kept)


def runs_of(batches: Iterable[pa.RecordBatch], key: str, columns: list[str]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """Each run of equal keys with the other ``columns`` of its rows, one row at a time, from batches sorted by the key."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for row in zip(*(batch.column(c) for c in (key, *columns))):
                yield tuple(x.as_py() for x in row)

    for value, group in groupby(rows(), key=itemgetter(0)):
        yield value, (row[1:] for row in group)
