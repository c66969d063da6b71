"""Removal of boilerplate lines, found by the number of distinct sites that show them.

A HyperLogLog sketch of its sites is kept per line hash and merged by aggregation, before the shuffle and after it. Lines
whose estimate lies near the threshold are counted exactly, so the outcome is that of exact counts. Only DataFrame
functions are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .common import let, row_key, same_row, written

LG_K = 12
SIGMAS = 6


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def trimmed(line: Column) -> Column:
    return F.regexp_replace(line, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")


def line_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", site: str = "source") -> DataFrame:
    """One row per line with a word: row key, line number, site, size and two hashes of the trimmed line (96 bits)."""
    rows = docs.select(*row_key(doc_id, text), F.col(site).cast("string").alias("site"), F.posexplode(lines_of(F.col(text))).alias("line_no", "raw"))
    rows = rows.withColumn("line", trimmed(F.col("raw"))).filter("line <> ''")
    return rows.select("doc_id", "text_key", "line_no", "site", F.char_length("line").alias("size"), F.xxhash64("line").alias("h1"), F.hash("line").alias("h2"))


def near_band(min_sites: int, lg_k: int = LG_K) -> tuple[int, int]:
    """The estimates that do not settle on which side of ``min_sites`` a count lies."""
    error = SIGMAS * 1.04 / math.sqrt(2**lg_k)
    return math.floor(min_sites * (1 - error)), math.ceil(min_sites * (1 + error))


def spread_lines(lines: DataFrame, min_sites: int, lg_k: int = LG_K, min_texts: int = 1) -> DataFrame:
    """(h1, h2, n_sites) of the lines on ``min_sites`` or more distinct sites and in ``min_texts`` or more distinct texts.

    ``n_sites`` is exact near the threshold and estimated above it. A NULL site is no site. Texts are counted exactly.
    """
    low, high = near_band(min_sites, lg_k)
    sketched = lines.groupBy("h1", "h2").agg(F.hll_sketch_agg("site", F.lit(lg_k)).alias("sketch"))
    guessed = sketched.select("h1", "h2", F.hll_sketch_estimate("sketch").alias("guess")).filter(F.col("guess") >= low)
    guessed = written(guessed, "line-guesses")
    near = guessed.filter(F.col("guess") <= high).select("h1", "h2")
    pairs = lines.select("h1", "h2", "site").join(near, ["h1", "h2"], "left_semi").distinct()
    exact = pairs.groupBy("h1", "h2").agg(F.count("site").alias("n_sites")).filter(F.col("n_sites") >= min_sites)
    sure = guessed.filter(F.col("guess") > high).select("h1", "h2", F.col("guess").alias("n_sites"))
    spread = sure.unionAll(exact)
    if min_texts <= 1:
        return spread
    spread = written(spread, "lines-on-sites")
    texts = lines.select("h1", "h2", "text_key").join(spread, ["h1", "h2"], "left_semi").distinct()
    many = texts.groupBy("h1", "h2").agg(F.count("*").alias("n_texts")).filter(F.col("n_texts") >= min_texts)
    return spread.join(many, ["h1", "h2"], "left_semi")


def drop_spread_lines(
    docs: DataFrame, min_sites: int = 10, doc_id: str = "doc_id", text: str = "text", site: str = "source", min_texts: int = 1
) -> DataFrame:
    """``doc_id, text_key, positions, most_sites`` of the rows that lose lines: the line numbers to remove.

    A line is boilerplate if it stands on ``min_sites`` or more sites, in ``min_texts`` or more distinct texts, and is removed
    wherever it stands. Lines of a text copied to many sites stand in one distinct text, so ``min_texts`` leaves copies of
    whole documents to the deduplication of documents. Lines are compared without white space around them; lines without a
    word stay. NULL and empty texts have no lines. Equal rows get equal results.
    """
    lines = written(line_table(docs, doc_id, text, site), "lines")
    spread = written(spread_lines(lines, min_sites, min_texts=min_texts), "line-spread")
    hit = lines.join(spread, ["h1", "h2"]).groupBy("doc_id", "text_key").agg(
        F.collect_set("line_no").alias("positions"), F.max("n_sites").alias("most_sites")
    )
    return hit.select("doc_id", "text_key", "positions", "most_sites")


def without_lines(text: Column, positions: Column) -> Column:
    """The text without the lines of these numbers; the cost grows with the text, not with lines times positions."""

    def kept(lines: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), positions)
        return F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")

    return let(lines_of(text), kept)


def clean_documents(
    docs: DataFrame, min_sites: int = 10, doc_id: str = "doc_id", text: str = "text", site: str = "source", min_texts: int = 1
) -> DataFrame:
    """Every row of ``docs`` as ``row`` (all its columns), with ``cleaned`` text, ``n_lines`` and ``n_removed``.

    See ``drop_spread_lines``. ``cleaned`` is the text itself where nothing is removed, NULL included.
    """
    hit = drop_spread_lines(docs, min_sites, doc_id, text, site, min_texts)
    left = docs.select(*row_key(doc_id, text), F.struct(*docs.columns).alias("row"))
    joined = left.join(hit.hint("shuffle_hash"), same_row(left, hit), "left")
    whole = F.col("row")[text]
    return joined.select(
        "row",
        F.when(F.col("positions").isNull(), whole).otherwise(without_lines(whole, F.col("positions"))).alias("cleaned"),
        F.size(F.filter(lines_of(whole), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))).cast("long").alias("n_lines"),
        F.coalesce(F.size("positions"), F.lit(0)).cast("long").alias("n_removed"),
    )
