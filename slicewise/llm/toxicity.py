"""Toxicity scores from subword bags: hashed n-gram vectors averaged into a linear softmax, trained jointly in numpy.

Words share the vectors of their byte n-grams, so an unseen spelling is close to those it shares n-grams with. The average
is taken over windows of words, and the most toxic window decides for the text: a few words in a long text count as much as
in a short one.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

GRAMS = (3, 4, 5)
BUCKETS, SIZE = 1 << 17, 8
WIDTH = 8
PER_CLASS, MAX_BYTES = 3000, 200_000
TOTAL_BYTES = 24 << 20  # text of a class; training holds about ten times as much for both together
ROUNDS, WHOLE_ROUNDS, BATCH, RATE, SEED = 8, 2, 64, 0.4, 3
PIECE = 1 << 18

_DRAW = np.random.default_rng(SEED)
_CODES = _DRAW.integers(1, 1 << 63, size=256, dtype=np.uint64)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def plain(text: str | None) -> bytes:
    """Lower-cased words with one space before, between and after them; a text without words is one space."""
    return b" %s " % b" ".join((text or "").lower().encode(errors="replace").split())


def _bucket(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _SPREAD
    return (h >> np.uint64(64 - (BUCKETS.bit_length() - 1))).astype(np.int32)


def subwords(data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram length (start places, buckets) of the n-grams without a space inside; last the whole words."""
    space = data == 32
    spaces = np.cumsum(space, dtype=np.int32)
    codes = _CODES[data]
    h = codes.copy()
    for n in range(2, max(GRAMS) + 1):
        h = h[:-1] * _SPREAD + codes[n - 1 :]
        if n in GRAMS and len(h):
            inside = spaces[n - 2 : n - 2 + len(h)] - spaces[: len(h)]
            at = np.flatnonzero(inside == 0)
            yield at, _bucket(h[at] + np.uint64(n))
    gaps = np.flatnonzero(space)
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(codes * (_place(len(data))), dtype=np.uint64)])
    begin, end = gaps[:-1] + 1, gaps[1:]
    full = end > begin
    begin, end = begin[full], end[full]
    whole = (sums[end] - sums[begin]) * _place_back(begin)
    yield begin - 1, _bucket(whole)


_POWERS: dict[str, np.ndarray] = {}


def _grown(name: str, base: int, n: int) -> np.ndarray:
    if len(_POWERS.get(name, ())) < n:
        factors = np.full(max(n, 2 * PIECE), base, dtype=np.uint64)
        factors[0] = 1
        _POWERS[name] = np.multiply.accumulate(factors)
    return _POWERS[name]


def _place(n: int) -> np.ndarray:
    return _grown("up", int(_SPREAD), n)[:n]


def _place_back(at: np.ndarray) -> np.ndarray:
    return _grown("down", pow(int(_SPREAD), -1, 1 << 64), int(at.max(initial=0)) + 1)[at]


def word_sums(data: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, sum of ``value`` over the subwords, number of subwords) of every word."""
    space = data == 32
    number = np.cumsum(space) - 1  # the word that begins after a space has that space's number
    gaps = np.flatnonzero(space)
    total, count = np.zeros(len(gaps)), np.zeros(len(gaps))
    for at, bucket in subwords(data):
        total += np.bincount(number[at], weights=value[bucket], minlength=len(gaps))
        count += np.bincount(number[at], minlength=len(gaps))
    # An n-gram that begins at a space belongs to the word after it; a space before another space has no subwords.
    word = count > 0
    return gaps[word] + 1, total[word], count[word]


@dataclasses.dataclass
class Model:
    value: np.ndarray  # of each bucket: how far its vector moves the log odds
    bias: float

    def logits(self, texts: list[bytes]) -> np.ndarray:
        """The log odds of the most toxic window of each text; texts without words have the bias alone."""
        out = np.full(len(texts), self.bias)
        k = 0
        while k < len(texts):
            stop, size = k, 0
            while stop < len(texts) and (stop == k or size + len(texts[stop]) <= PIECE):
                size += len(texts[stop])
                stop += 1
            ends = np.cumsum([len(t) for t in texts[k:stop]])
            at, total, count = word_sums(np.frombuffer(b"".join(texts[k:stop]), dtype=np.uint8), self.value)
            cut = np.searchsorted(at, np.concatenate([[0], ends]))
            for i, (a, b) in enumerate(zip(cut[:-1], cut[1:])):
                if b > a:
                    out[k + i] = best_window(total[a:b], count[a:b])[0] + self.bias
            k = stop
        return out

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(texts), -30, 30)))


def best_window(total: np.ndarray, count: np.ndarray, width: int = WIDTH) -> tuple[float, int, int]:
    """(average, first word, last word + 1) of the window of words with the largest average."""
    n = len(total)
    first = np.arange(0, max(1, n - width + 1))
    last = np.minimum(first + width, n)
    sums, sizes = np.concatenate([[0.0], np.cumsum(total)]), np.concatenate([[0.0], np.cumsum(count)])
    means = (sums[last] - sums[first]) / (sizes[last] - sizes[first])
    k = int(np.argmax(means))
    return float(means[k]), int(first[k]), int(last[k])


class _Bags:
    """The subwords of training texts, word by word."""

    def __init__(self, texts: list[bytes]):
        self.ids, self.word_end, self.words = [], [], []
        for text in texts:
            data = np.frombuffer(text, dtype=np.uint8)
            number = np.cumsum(data == 32) - 1
            at, bucket = (np.concatenate(x) for x in zip(*subwords(data)))
            of = number[at]
            order = np.argsort(of, kind="stable")
            counts = np.bincount(of)
            self.ids.append(bucket[order])
            self.words.append(counts[counts > 0])


def train_model(texts: list[bytes], labels: np.ndarray, weights: np.ndarray) -> Model:
    """Vectors and softmax fitted together by AdaGrad on weighted texts.

    The first rounds average whole texts; later ones the window that is most toxic by the vectors so far.
    """
    draw = np.random.default_rng(SEED)
    bags = _Bags(texts)
    vectors = draw.uniform(-1 / SIZE, 1 / SIZE, (BUCKETS, SIZE))
    softmax, bias = np.zeros((2, SIZE)), np.log([weights[labels == c].sum() + 1e-9 for c in (0, 1)])
    softmax[1], softmax[0] = 0.1, -0.1
    seen_v, seen_s = np.full((BUCKETS, SIZE), 1e-6), np.full((2, SIZE), 1e-6)
    for turn in range(ROUNDS):
        value = vectors @ (softmax[1] - softmax[0])
        chosen = []
        for ids, words in zip(bags.ids, bags.words):
            if turn < WHOLE_ROUNDS:
                chosen.append(ids)
                continue
            ends = np.cumsum(words)
            total = np.add.reduceat(value[ids], np.concatenate([[0], ends[:-1]]))
            _, a, b = best_window(total, words)
            chosen.append(ids[ends[a] - words[a] : ends[b - 1]])
        rate = RATE * (1 - turn / (ROUNDS + 1))
        for batch in np.array_split(draw.permutation(len(texts)), max(1, len(texts) // BATCH)):
            sizes = np.array([len(chosen[i]) for i in batch])
            ids = np.concatenate([chosen[i] for i in batch])
            touched, where = np.unique(ids, return_inverse=True)
            of = np.repeat(np.arange(len(batch)), sizes)
            bags_of = np.stack([np.bincount(of, weights=vectors[ids, k], minlength=len(batch)) for k in range(SIZE)], axis=1)
            bags_of /= sizes[:, None]
            logits = bags_of @ softmax.T + bias
            odds = np.exp(logits - logits.max(axis=1, keepdims=True))
            error = odds / odds.sum(axis=1, keepdims=True)
            error[np.arange(len(batch)), labels[batch]] -= 1
            error *= weights[batch, None]
            grad_s = error.T @ bags_of
            each = (error @ softmax) / sizes[:, None]
            grad_v = np.stack([np.bincount(where, weights=each[of, k], minlength=len(touched)) for k in range(SIZE)], axis=1)
            seen_s += grad_s**2
            seen_v[touched] += grad_v**2
            softmax -= rate * grad_s / np.sqrt(seen_s)
            vectors[touched] -= rate * grad_v / np.sqrt(seen_v[touched])
            bias -= 0.05 * rate * error.sum(axis=0)
    return Model((vectors @ (softmax[1] - softmax[0])).astype(np.float64), float(bias[1] - bias[0]))


def training_texts(
    docs: DataFrame, labels: DataFrame, chosen: Column, label: str = "toxic", per_class: int = PER_CLASS, max_bytes: int = MAX_BYTES,
    total_bytes: int = TOTAL_BYTES,
) -> DataFrame:
    """(text, label, weight) of at most ``per_class`` labelled texts a class, those with the smallest hash of their id.

    Of these the first ones are taken that have ``total_bytes`` bytes together, so what comes to the driver is bounded.
    NULL texts and those of more than ``max_bytes`` bytes are not trained on. ``weight`` gives the classes their share of all
    labels. Of repeated labels the largest counts, NULL labels do not; a document that is repeated is trained on once a row.
    """
    told = labels.filter(F.col(label).isNotNull() & chosen).groupBy(F.col("doc_id").alias("of_id"))
    told = told.agg(F.max(label).cast("int").alias("label"))
    counts = {r.label: r.n for r in told.groupBy("label").agg(F.count("*").alias("n")).collect()}  # two rows
    all_rows = sum(counts.values()) or 1
    parts = []
    for value in (0, 1):
        n = counts.get(value, 0)
        share = n / all_rows / max(1, min(n, per_class))
        part = told.filter(F.col("label") == value).orderBy(F.xxhash64("of_id"), "of_id").limit(per_class)
        parts.append(part.withColumn("weight", F.lit(share)))
    sample = F.broadcast(parts[0].unionAll(parts[1]))  # at most twice per_class rows
    joined = docs.join(sample, F.col("doc_id") == F.col("of_id")).filter(F.octet_length("text") <= max_bytes)
    in_order = Window.partitionBy("label").orderBy(F.xxhash64("of_id"), "of_id").rowsBetween(Window.unboundedPreceding, 0)
    so_far = joined.withColumn("so_far", F.sum(F.octet_length("text")).over(in_order))
    return so_far.filter(F.col("so_far") <= total_bytes).select("text", "label", "weight")


def train(docs: DataFrame, labels: DataFrame, chosen: Column, label: str = "toxic", per_class: int = PER_CLASS) -> Model:
    """A model from labelled rows of ``docs``; without both classes every text has the same score."""
    rows = training_texts(docs.select("doc_id", "text"), labels, chosen, label, per_class).collect()  # bounded as said there
    rows.sort(key=lambda r: (r.text or "", r.label))
    said = np.array([r.label for r in rows], dtype=int)
    if len(set(said)) < 2:
        return Model(np.zeros(BUCKETS), 0.0 if not len(said) else 30.0 * (2 * said[0] - 1))
    texts, weight = [plain(r.text) for r in rows], np.array([r.weight for r in rows])
    full = np.array([len(t) > 2 for t in texts])
    return train_model([t for t, f in zip(texts, full) if f], said[full], weight[full] / weight[full].mean())


def score_documents(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row; NULL and empty texts get the score of no words."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores([plain(x.as_py()) for x in batch.column("text")])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(each, f"doc_id {kind}, score double")
