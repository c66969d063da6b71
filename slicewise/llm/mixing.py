"""Mixing to target weights: token weights raked to marginals, documents sampled by the calibrated probabilities.

Iterative proportional fitting runs on the cells (combinations of the dimensions' values), whose number does not grow with
the documents: each step sums the weights of one dimension and scales them to its targets, no cell beyond the tokens it has.
The tokens wanted of a cell over those it has are the chance of each of its documents.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .common import words_of, written

MAX_ROUNDS, TOLERANCE, STALLED = 30, 1e-3, 0.98
SEED, POWER, KEEP = 17, 0.8, 0.4


def _label(column: Column) -> Column:
    """A value as text; NULL is a value of its own, apart from every text."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit("NULL"))


def cells_of(rows: DataFrame, dims: list[str], tokens: str) -> DataFrame:
    """Tokens and documents of every combination of the dimensions that has tokens."""
    cells = rows.groupBy(*dims).agg(F.sum(tokens).alias("tokens"), F.count("*").alias("docs"))
    return cells.filter("tokens > 0")


def tempered(cells: DataFrame, dim: str, power: float) -> DataFrame:
    """(value, share) of a dimension: its token shares to a power below one, which lifts what is rare; 0 makes all equal."""
    sums = cells.groupBy(F.col(dim).alias("value")).agg(F.sum("tokens").alias("t"))
    lifted = sums.select("value", F.pow("t", F.lit(power)).alias("share"))
    return lifted


def rake(
    cells: DataFrame,
    targets: dict[str, DataFrame],
    most: Column | None = None,
    max_rounds: int = MAX_ROUNDS,
    tolerance: float = TOLERANCE,
) -> tuple[DataFrame, float, int]:
    """(cells with ``weight``, largest error, rounds): weights that sum to one and meet the marginals.

    ``targets``: per dimension (value, share), shares of any scale. Values without tokens are left out and the rest scaled
    up; cells of a value without a target get no weight. ``most``: an upper bound of a cell's weight; what a bounded cell
    lacks goes to the other cells of its values. It ends when a round changes no marginal by more than ``tolerance``, after
    ``max_rounds``, or when rounds no longer bring the marginals closer, as with targets that exclude each other or bounds
    that leave no room; the error tells.
    """
    shares, weighed = {}, cells.withColumn("weight", F.col("tokens").cast("double"))
    for i, (dim, target) in enumerate(targets.items()):
        told = target.groupBy(F.col("value").alias("of")).agg(F.sum("share").alias("share")).filter("share > 0")
        present = told.join(cells.select(F.col(dim).alias("of")).distinct(), "of", "left_semi")
        total = present.agg(F.sum("share")).first()[0]
        shares[dim] = f"share_{i}"
        held = written(present.select("of", (F.col("share") / F.lit(total)).alias("share")), "targets")
        weighed = weighed.join(held.select(F.col("of").alias(dim), F.col("share").alias(shares[dim])), dim)
    weighed, error, rounds = written(weighed.select(*cells.columns, *shares.values(), "weight"), "cells"), 0.0, 0
    while rounds < max_rounds:
        weighed = weighed.withColumn("off", F.lit(0.0))
        # A table a step, with one join: in one plan each step holds the one before twice, and its relations stay on the driver.
        for dim, share in shares.items():
            scale = weighed.groupBy(F.col(dim).alias("of")).agg((F.max(share) / F.sum("weight")).alias("scale"))
            weight, off = F.col("weight") * F.col("scale"), F.abs(F.col("scale") - 1)
            scaled = weighed.join(scale, F.col(dim) == F.col("of")).select(
                *cells.columns,
                *shares.values(),
                (weight if most is None else F.least(weight, most)).alias("weight"),
                F.greatest("off", off).alias("off"),
            )
            weighed = written(scaled, "cells")
        before, error, rounds = error, weighed.agg(F.max("off")).first()[0] or 0.0, rounds + 1
        if error <= tolerance or rounds > 1 and error > STALLED * before:
            break
    return weighed.select(*cells.columns, "weight"), error, rounds


def draw(seed: int, *identity: Column) -> Column:
    """A number in [0, 1) from what identifies a row: the same in every run and on every executor."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *identity), 11) / F.lit(float(1 << 53))


def mix(
    docs: DataFrame,
    dims: dict[str, Column],
    tokens: Column,
    targets: dict[str, DataFrame] | None = None,
    power: float = POWER,
    keep: float = KEEP,
    seed: int = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``docs`` as ``row`` with ``labels`` (dimension values), ``n_tokens``, ``weight``, ``probability``, ``sampled`` and ``target_error``.

    ``target_error`` is the same in every row: by how much, as a share, the marginal that is furthest off misses its target. It
    is at most ``TOLERANCE`` where the targets are met, and more where they exclude each other or ask for more than there is.
    The sample has the share ``keep`` of all tokens in expectation. ``dims``: an expression for each dimension; NULL is a value of its own. Dimensions without targets get ``tempered``
    ones. Texts without tokens have probability 0. Equal rows are drawn together. An empty table gives an empty result.
    """
    names = [f"dim_{i}" for i in range(len(dims))]
    labels = [_label(c).alias(n) for n, c in zip(names, dims.values())]
    counted = written(docs.select(*labels, tokens.cast("long").alias("n_tokens")), "dimensions")
    cells = written(cells_of(counted, names, "n_tokens"), "cells")
    goals = {}
    for name, dim in zip(names, dims):
        given = (targets or {}).get(dim)
        goals[name] = tempered(cells, name, power) if given is None else given.select(_label(F.col("value")).alias("value"), "share")
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    wanted = F.lit(float(keep * total))
    weighed, error, _ = rake(cells, goals, F.col("tokens") / wanted)
    chance = F.least(F.col("weight") * wanted / F.col("tokens"), F.lit(1.0))
    chances = weighed.select(*[F.col(n).alias(f"of_{n}") for n in names], F.round("weight", 9).alias("weight"), chance.alias("probability"))
    chances = written(chances, "chances")
    whole = docs.select(
        *labels, tokens.cast("long").alias("n_tokens"), draw(seed, F.col(doc_id), F.col(text)).alias("drawn"), F.struct(*docs.columns).alias("row")
    )
    meet = reduce(lambda a, b: a & b, [F.col(n) == F.col(f"of_{n}") for n in names])
    joined = whole.join(chances, meet, "left")
    chance = F.when(F.col("n_tokens") > 0, F.coalesce("probability", F.lit(0.0))).otherwise(0.0)
    shown = F.struct(*[F.when(F.col(n) != "NULL", F.substr(n, F.lit(2))).alias(d) for n, d in zip(names, dims)])
    return joined.select(
        "row", shown.alias("labels"), "n_tokens", F.coalesce("weight", F.lit(0.0)).alias("weight"), chance.alias("probability"),
        (F.col("drawn") < chance).alias("sampled"), F.lit(float(error)).alias("target_error"),
    )


def layout_topic(text: Column) -> Column:
    """A stand-in for a topic where the documents carry none: the layout of a text. NULL has none."""
    return F.when(F.contains(text, F.lit(" | ")), "table").when(F.contains(text, F.lit("\n")), "pages").when(text.isNotNull(), "paragraph")


def mix_documents(docs: DataFrame, power: float = POWER, keep: float = KEEP) -> DataFrame:
    """``mix`` over source, language and topic of a table laid out like ``documents``."""
    tokens = F.size(words_of(F.col("text")))
    return mix(docs, {"source": F.col("source"), "lang": F.col("lang"), "topic": layout_topic(F.col("text"))}, tokens, power=power, keep=keep)
