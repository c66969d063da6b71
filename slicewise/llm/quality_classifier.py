"""Quality scores: random Fourier features of document statistics, ridge regression, isotonic calibration.

The features approximate a Gaussian kernel over the statistics of a whole text. Every partition sums its share of the normal
equations, per fold; the sums of the other folds give each fold a model that has not seen it, and the scores of these
models are what the calibration is fitted on. Only sums whose size is fixed by the number of features reach the driver.
"""

from __future__ import annotations

import dataclasses
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import written

FEATURES, FOLDS, RIDGE, SEED = 256, 5, 1.0, 11
BINS = 2048
CLASSES = [b"#*$%&|<>", b".,;:", b"!?", b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"\n", b" \t", b"-_/\\()[]{}\"'"]
NAMES = [
    "log_words", "mean_word", "sd_word", "max_word", "distinct_words", "distinct_pairs", "top_word", "log_line", "distinct_lines",
    "byte_entropy", "beyond_ascii", *[f"class_{i}" for i in range(len(CLASSES))],
]
_CLASS_OF = np.full(256, len(CLASSES), dtype=np.int64)
for _i, _c in enumerate(CLASSES):
    _CLASS_OF[list(_c)] = _i


def statistics(text: str | None) -> list[float]:
    """The statistics of a whole text; NULL counts as empty."""
    text = text or ""
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    n = max(1, len(words))
    sizes = np.fromiter(map(len, words), dtype=np.float64, count=len(words)) if words else np.zeros(1)
    bytes_of = np.bincount(np.frombuffer(text.encode(), dtype=np.uint8), minlength=256)
    size = max(1, int(bytes_of.sum()))
    share = bytes_of[bytes_of > 0] / size
    classes = np.bincount(_CLASS_OF, weights=bytes_of, minlength=len(CLASSES) + 1)[: len(CLASSES)] / size
    top = max(Counter(words).values()) if words else 0
    return [
        np.log1p(len(words)),
        sizes.mean(),
        sizes.std(),
        np.log1p(sizes.max()),
        len(set(words)) / n,
        len(set(zip(words, words[1:]))) / n,
        top / n,
        np.log1p(size / max(1, len(lines))),
        len(set(lines)) / max(1, len(lines)),
        float(-(share * np.log(share)).sum()),
        bytes_of[128:].sum() / size,
        *np.sqrt(classes),
    ]


def document_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, stats) of every row, from one pass over the texts."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [statistics(x.as_py()) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(made, pa.list_(pa.float64()))], names=["doc_id", "stats"]
            )

    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(each, f"doc_id {kind}, stats array<double>")


@dataclasses.dataclass
class Projection:
    """Scaling of the statistics and the random features drawn for them."""

    mean: np.ndarray
    sd: np.ndarray
    waves: np.ndarray
    phases: np.ndarray

    def of(self, stats: np.ndarray) -> np.ndarray:
        """Random Fourier features and a constant."""
        scaled = np.clip((stats - self.mean) / self.sd, -6, 6)
        waves = np.sqrt(2 / len(self.phases)) * np.cos(scaled @ self.waves + self.phases)
        return np.hstack([waves, np.ones((len(stats), 1))])


@dataclasses.dataclass
class Model:
    projection: Projection | None
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def scores(self, stats: np.ndarray) -> np.ndarray:
        if self.projection is None or not len(stats):
            return np.full(len(stats), self.values[0])
        return np.interp(self.projection.of(stats) @ self.weights, self.knots, self.values)


def projection_of(mean: list[float], sd: list[float], features: int = FEATURES, seed: int = SEED) -> Projection:
    """Features for a kernel as wide as scaled rows usually lie apart: the root of the number of statistics."""
    draw = np.random.default_rng(seed)
    waves = draw.normal(size=(len(mean), features)) / np.sqrt(len(mean))
    sd = np.array(sd, dtype=float)
    return Projection(np.array(mean, dtype=float), np.where(sd > 1e-9, sd, 1.0), waves, draw.uniform(0, 2 * np.pi, features))


def normal_equations(rows: DataFrame, projection: Projection, folds: int = FOLDS) -> np.ndarray:
    """Per fold the matrix and, as its last column, the right side, summed inside partitions and then over them."""
    size = len(projection.phases) + 1

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((folds, size, size + 1))
        for batch in batches:
            if batch.empty:
                continue
            z, y, fold = projection.of(np.stack(batch["stats"])), batch["label"].to_numpy(), batch["fold"].to_numpy()
            for k in range(folds):
                zk = z[fold == k]
                sums[k] += zk.T @ np.hstack([zk, y[fold == k, None]])
        for k in range(folds):
            if sums[k].any():
                yield pd.DataFrame({"fold": k, "line": np.arange(size), "part": list(sums[k])})

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for fold, line, part in zip(batch["fold"], batch["line"], batch["part"]):
                sums[fold, line] = sums[fold, line] + part if (fold, line) in sums else part
        if sums:
            yield pd.DataFrame({"fold": [k for k, _ in sums], "line": [i for _, i in sums], "part": list(sums.values())})

    schema = "fold int, line int, part array<double>"
    # Lines are added as they come, so a task holds one of each, however many tasks send one.
    lines = rows.mapInPandas(partial, schema).repartition("fold", "line").mapInPandas(add, schema).collect()
    total = np.zeros((folds, size, size + 1))
    for row in lines:  # at most folds x features rows
        total[row.fold, row.line] += row.part
    return total


def solve(sums: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    penalty = ridge * np.eye(len(sums))
    penalty[-1, -1] = 1e-6
    return np.linalg.solve(sums[:, :-1] + penalty, sums[:, -1])


def isotonic(x: np.ndarray, weight: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots and values of the rising fit of ``total / weight`` on ``x`` (rising); adjacent violators are pooled."""
    pools: list[list[float]] = []
    for at, n, s in zip(x, weight, total):
        pools.append([at * n, n, s])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return np.array([p[0] / p[1] for p in pools]), np.array([p[2] / p[1] for p in pools])


def fit(labelled: DataFrame, features: int = FEATURES, folds: int = FOLDS) -> Model:
    """A model from rows (stats, label, fold). Without rows every score is 0.5, with one class that class."""
    names = range(len(NAMES))
    told = labelled.agg(
        F.count("*").alias("n"),
        F.avg("label").alias("share"),
        F.array(*[F.avg(F.col("stats")[i]) for i in names]).alias("mean"),
        F.array(*[F.stddev_pop(F.col("stats")[i]) for i in names]).alias("sd"),
    ).first()
    if not told.n or told.share in (0.0, 1.0):
        return Model(None, np.zeros(0), np.zeros(0), np.array([0.5 if not told.n else told.share]))
    projection = projection_of(told.mean, told.sd, features)
    sums = normal_equations(labelled, projection, folds)
    total = sums.sum(axis=0)
    apart = np.stack([solve(total - sums[k]) for k in range(folds)])

    @F.pandas_udf("int")
    def bin_of(stats: pd.Series, fold: pd.Series) -> pd.Series:
        raw = np.einsum("ij,ij->i", projection.of(np.stack(stats)), apart[fold.to_numpy()])
        return pd.Series(np.round(np.clip(raw, -0.5, 1.5) * BINS).astype(int))

    binned = labelled.select(bin_of("stats", "fold").alias("bin"), "label").groupBy("bin")
    bins = sorted(binned.agg(F.count("*").alias("n"), F.sum("label").alias("s")).collect())  # at most 2 x BINS + 1 rows
    knots, values = isotonic(*(np.array([r[i] for r in bins], dtype=float) for i in range(3)))
    return Model(projection, solve(total), knots / BINS, values)


def training_rows(stats: DataFrame, labels: DataFrame, chosen: Column, label: str = "quality") -> DataFrame:
    """(stats, label, fold) of the labelled rows of ``stats``; of repeated labels the smallest counts, NULL labels do not."""
    told = labels.filter(F.col(label).isNotNull() & chosen).groupBy(F.col("doc_id").alias("of_id"))
    told = told.agg(F.min(label).cast("double").alias("label"))
    joined = stats.join(told, F.col("doc_id") == F.col("of_id"))
    return joined.select("stats", "label", F.pmod(F.xxhash64("of_id"), F.lit(FOLDS)).cast("int").alias("fold"))


def train(stats: DataFrame, labels: DataFrame, chosen: Column, label: str = "quality") -> Model:
    """A model from all labels that ``chosen`` (an expression on the labels' columns) lets through."""
    return fit(written(training_rows(stats, labels, chosen, label), "training"))


def score_statistics(model: Model):
    """A column function from statistics to scores."""

    @F.pandas_udf("double")
    def score(stats: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.stack(stats) if len(stats) else np.zeros((0, len(NAMES)))))

    return score


def score_texts(model: Model):
    """A column function from texts to scores."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        made = np.array([statistics(x) for x in texts]).reshape(len(texts), len(NAMES))
        return pd.Series(model.scores(made))

    return score
