"""Flattening nested records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.slices import ref

# Fixed value: the mark between the parts of a flattened name, e.g. ``parent~child``.
NAME_MARK = "~"


def array_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]


def _leaves(value: Column, name: str, dtype: T.DataType) -> list[Column]:
    if not isinstance(dtype, T.StructType):
        return [value.alias(name)]
    return [
        leaf
        for field in dtype.fields
        for leaf in _leaves(value.getField(field.name), f"{name}{NAME_MARK}{field.name}", field.dataType)
    ]


def flatten(df: DataFrame, keep_empty: bool = False, keep_structs: bool = True) -> DataFrame:
    """Explode each array column, then add every field of every struct, at all levels, as ``parent~child``.

    Several array columns multiply within their record. Records with an empty or NULL array are dropped unless
    ``keep_empty``. An exploded column goes once its fields are there; an exploded array of plain values keeps its
    values under its name. Plain struct columns stay beside their fields unless ``keep_structs`` is false.
    """
    arrays = array_columns(df)
    rows, unnest = df, F.explode_outer if keep_empty else F.explode
    for name in arrays:
        rows = rows.withColumn(name, unnest(ref(name)))
    kept, added = [], []
    for field in rows.schema.fields:
        nested = isinstance(field.dataType, T.StructType)
        if nested:
            added += _leaves(ref(field.name), field.name, field.dataType)
        if not nested or (keep_structs and field.name not in arrays):
            kept.append(ref(field.name))
    return rows.select(*kept, *added)


def nested_record_count(df: DataFrame) -> DataFrame:
    """Records before any explode."""
    return df.agg(F.count("*").alias("n_records"))
