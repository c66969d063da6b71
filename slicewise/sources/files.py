"""Files as data: profiles of text files, JSON records and merged file sets."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.profiles import text_end

# Suffixes of files whose size says nothing about the bytes of their lines.
COMPRESSED = r"\.(gz|bz2|zst|lz4|snappy|deflate)$"


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with their file and place: whether they come from its first split, and their order within a split."""
    return (
        spark.read.option("lineSep", "\n")
        .option("recursiveFileLookup", "true")
        .text(path)
        .select(
            "value",
            F.col("_metadata.file_path").alias("file_path"),
            (F.col("_metadata.file_block_start") == 0).alias("in_head"),
            F.monotonically_increasing_id().alias("id"),
        )
    )


def _files(spark: SparkSession, path: str | list[str], list_empty: bool) -> DataFrame:
    """Facts of every file. The content column is not read.

    Scans leave empty files out, so their names are taken from the file listing, which the driver holds anyway; their
    modification time stays NULL.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    facts = reader.select(
        F.col("_metadata.file_path").alias("file_path"), F.col("modificationTime").alias("modified"), F.col("length").alias("size")
    )
    if not list_empty:
        return facts
    names = spark.createDataFrame(pa.table({"file_path": pa.array(reader.inputFiles(), pa.string())}))
    # The listing writes an empty authority as three slashes, the scan as one.
    listed = names.withColumn("file_path", F.regexp_replace("file_path", "^([a-z0-9]+):///", "$1:/"))
    return listed.join(facts, "file_path", "left").withColumn("size", F.coalesce("size", F.lit(0).cast("bigint")))


def file_profile(spark: SparkSession, path: str | list[str], project_id: str, list_empty: bool = False) -> DataFrame:
    """Per file: project, modification time, number of newlines, name, first line, size, and a joined text form.

    Empty files have no lines to scan; with ``list_empty`` they are named from the driver's listing of all files.

    ``n_lines`` also counts a last line that has no newline; ``n_newlines`` does not. For an uncompressed file the
    difference shows in its size: every newline is one byte beyond the bytes of the lines. Large files are read in
    splits, and a file sends one partial row per split to the shuffle. Lines are not sorted: each task keeps the first line
    it has seen of a file in a hash map, and only of a file's head can that be the header.
    """
    read = (
        _lines(spark, path)
        .groupBy("file_path")
        .agg(
            F.count("*").alias("n_lines"),
            F.sum(F.octet_length("value")).alias("n_bytes"),
            text_end(lambda line: F.min_by(line, F.when(F.col("in_head"), F.col("id"))), F.when(F.col("in_head"), F.col("value"))).alias("header"),
        )
    )
    whole = _files(spark, path, list_empty).join(read, "file_path", "left")
    n_lines = F.coalesce("n_lines", F.lit(0).cast("bigint"))
    last_open = (F.col("size") - F.coalesce("n_bytes", F.lit(0))) < n_lines
    newlines = F.when(~F.col("file_path").rlike(COMPRESSED), n_lines - F.when(last_open, 1).otherwise(0))
    return whole.select(
        F.lit(str(project_id)).alias("project_id"),
        "modified",
        n_lines.alias("n_lines"),
        newlines.cast("bigint").alias("n_newlines"),
        "file_path",
        F.url_decode(F.substring_index("file_path", "/", -1)).alias("file_name"),
        F.coalesce("header", F.lit("")).alias("header"),
        "size",
    ).withColumn(
        "profile_text",
        F.array_join(
            F.array(
                "project_id",
                F.date_format("modified", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
                F.coalesce("n_newlines", "n_lines").cast("string"),
                "file_path",
                "header",
                F.col("size").cast("string"),
            ),
            "|||",
            "",
        ),
    )


def line_consistency(spark: SparkSession, path: str | list[str], delimiter: str) -> DataFrame:
    """Per file: fields of the header line, number of lines, and lines with another number of fields.

    Lines are first counted per file and field count, with numbers only in the aggregate, so that it runs as generated
    code and the shuffle carries one row per file, field count and task.
    """
    fields = F.size(F.split(F.col("value"), "\\Q" + delimiter + "\\E")).alias("n_fields")
    counted = (
        _lines(spark, path)
        .select("file_path", F.when(F.col("in_head"), F.col("id")).alias("head_id"), fields)
        .groupBy("file_path", "n_fields")
        .agg(F.count("*").alias("n"), F.min("head_id").alias("head_id"))
    )
    per_file = counted.groupBy("file_path").agg(
        F.min_by("n_fields", "head_id").alias("n_header_fields"),
        F.min_by("n", "head_id").alias("n_good"),
        F.sum("n").alias("n_lines"),
    )
    bad = F.col("n_lines") - F.col("n_good")
    return per_file.select(
        "file_path",
        "n_header_fields",
        "n_lines",
        bad.alias("n_bad_lines"),
        F.when(bad == 0, "Pass").otherwise("Fail").alias("status"),
    )


def read_json(spark: SparkSession, path: str | list[str], schema: str | None = None) -> DataFrame:
    """JSON records; a given schema saves the extra read that infers one."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def json_field_profile(df: DataFrame, column: str) -> DataFrame:
    """Per top-level key of a JSON text column: rows that carry it, beside the number of rows."""
    keys = df.select(F.explode(F.json_object_keys(column)).alias("key"))
    return keys.groupBy("key").agg(F.count("*").alias("n")).withColumn("n_rows", df.agg(F.count("*")).scalar())


def merge_frames(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames under the union of their columns; what a frame lacks is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def merge_files(spark: SparkSession, paths: list[str], fmt: str = "parquet") -> DataFrame:
    """Merge file sets whose columns may differ. Self-describing formats take one scan; CSV one per path."""
    if fmt in ("parquet", "orc"):
        return spark.read.format(fmt).option("mergeSchema", "true").load(paths)
    if fmt == "json":
        return spark.read.json(paths)
    return merge_frames([spark.read.format(fmt).option("header", "true").load(p) for p in paths])
