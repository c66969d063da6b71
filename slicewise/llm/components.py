"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import written


def _large_star(pairs: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or the node itself)."""
    both = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("at")).agg(F.least(F.min("b"), F.first("a")).alias("least"))
    near = both.join(least, F.col("a") == F.col("at")).filter("b > a")
    return near.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to its smallest neighbour."""
    least = pairs.groupBy(F.col("a").alias("at")).agg(F.min("b").alias("least"))
    near = pairs.join(least, F.col("a") == F.col("at"))
    others = near.filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    own = least.select(F.col("at").alias("a"), F.col("least").alias("b"))
    return others.unionAll(own).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (two columns of one orderable type, no NULLs) that is not a root itself.

    The root is the smallest node of a component. Loops and repeated edges do not matter; no edges give no rows. Links are
    written after every round, and one row a round comes to the driver.
    """
    a, b = edges.columns
    pairs = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct()
    pairs, seen = written(pairs, "links"), None
    while True:
        print_of = pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")).first()
        if print_of == seen or not print_of.n:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = print_of
        pairs = written(_small_star(written(_large_star(pairs), "links")), "links")
