"""Removal of repeated byte strings: phrases by rolling-hash triggers, and a join of the strings inside them by trigger.

Rolling-hash triggers cut every text into phrases, as in prefix-free parsing. A trigger is the smallest of the hashed
``TRIGGER``-byte strings inside a ``SPAN``-byte string, so equal ``SPAN``-byte strings have the same trigger at the same place,
and every start of a string belongs to one trigger. The starts that share a trigger are one phrase; it holds all bytes that
their strings cover. Phrases whose trigger stands in no other document are done with. Where a trigger has one phrase only, the
phrase decides for all its strings by its smallest document. Where it has several, their ``SPAN``-byte strings are
grouped by trigger, place and bytes. There is no suffix array of the dictionary or of the parse.

A task decides the occurrences whose phrase it has also met in a smaller document; these rows meet no others. The rest meet by
a window over the trigger. Triggers that hold a large share of all occurrences are found first and split by their phrases.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import written

SPAN, TRIGGER = 50, 20
STARTS = SPAN - TRIGGER + 1  # trigger places inside a string, and most starts a phrase can have
HALF = (SPAN - TRIGGER) // 2
PIECE = 1 << 18
ROWS = 50_000  # rows of a batch handed on
GATHER = 1_000_000  # occurrences among which a task decides
BLOCK = 24  # decided rows lie apart by document and 16 KB of place
SHARE = 1024  # a trigger with one in so many occurrences is frequent
LAST_ID = (1 << 63) - 1

_SEED = np.random.default_rng(7)
_BYTES = _SEED.integers(1, 1 << 63, size=256, dtype=np.uint64)
_BASE = int(_SEED.integers(1 << 40, 1 << 62)) | 1
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            factors = np.full(max(n, 2 * PIECE), base, dtype=np.uint64)
            factors[0] = 1
            _POWERS[name] = np.multiply.accumulate(factors)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    return x


class Rolling:
    """Hashes of any substring of some bytes from one pass of sums."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTES[data] * up[:-1], out=self.sums[1:])

    def of(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return _mix((self.sums[stops] - self.sums[starts]) * self.down[starts])

    def all(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return _mix((self.sums[size:] - self.sums[:n]) * self.down[:n])


def _pieces(batch: pa.RecordBatch) -> Iterator[list[tuple[int, int, bytes]]]:
    """Texts of a batch as lists of (row, offset, bytes), about ``PIECE`` bytes a list; a long text is cut with overlap."""
    out, size = [], 0
    for row, value in enumerate(batch.column("body")):
        body = value.as_py() or b""
        for offset in range(0, max(1, len(body) - SPAN + 1), PIECE):
            part = body[offset : offset + PIECE + SPAN - 1]
            if len(part) >= SPAN:
                out.append((row, offset, part))
                size += len(part)
            if size >= PIECE:
                yield out
                out, size = [], 0
    if out:
        yield out


def phrases(data: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first start, last start, trigger place, trigger hash, phrase hash) of the phrases of joined pieces.

    ``piece`` numbers the piece of each byte; strings that cross pieces are left out.
    """
    hashed = Rolling(data)
    grams = hashed.all(TRIGGER)
    order = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    least, width = order, 1
    while 2 * width <= STARTS:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[: len(least) - (STARTS - width)], least[STARTS - width :])
    starts = np.flatnonzero(piece[: len(data) - SPAN + 1] == piece[SPAN - 1 :])
    trigger = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (trigger[1:] != trigger[:-1]) | (piece[starts[1:]] != piece[starts[:-1]])
    first = starts[new]
    last = starts[np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)]
    places = trigger[new]
    return first, last, places, grams[places], hashed.of(first, last + SPAN)


def bodies(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc, tag, body): the id, NULL as the largest, what tells its texts apart, and the bytes.

    ``tag`` is a hash of the text (64 bits) where an id, NULL among them, has several texts, else zero: it travels with
    every phrase, and zeros cost next to nothing.
    """
    doc = F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID))
    key = F.xxhash64(F.col(text).isNull(), F.col(text))
    texts = docs.select(doc.alias("doc"), key.alias("key"), F.col(text).cast("binary").alias("body"))
    shared = texts.groupBy(F.col("doc").alias("shared")).agg(F.min("key").alias("a"), F.max("key").alias("b")).filter("a <> b")
    shared = written(shared.select("shared"), "shared-ids")
    joined = texts.join(shared, F.col("doc") == F.col("shared"), "left")
    return joined.select("doc", F.when(F.col("shared").isNull(), F.lit(0).cast("long")).otherwise(F.col("key")).alias("tag"), "body")


def _joined(batch: pa.RecordBatch) -> Iterator[tuple[list[tuple[int, int, bytes]], np.ndarray, np.ndarray, np.ndarray]]:
    """The lists of ``_pieces`` with the size of each piece, the joined bytes and the piece of each byte."""
    for pieces in _pieces(batch):
        sizes = np.array([len(p[2]) for p in pieces])
        yield pieces, sizes, np.frombuffer(b"".join(p[2] for p in pieces), dtype=np.uint8), np.repeat(np.arange(len(pieces)), sizes)


def frequent_triggers(texts: DataFrame, share: int) -> list[int]:
    """All triggers with one in ``share`` of all occurrences or more, and perhaps some with half of that: 2 x ``share`` at most.

    A trigger that has a share of all occurrences has at least half of them in batches where it has half that share, so it is
    enough to hand on the triggers that are frequent in a batch.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, piece in _joined(batch):
                keys, counts = np.unique(phrases(data, piece)[3], return_counts=True)
                often = counts * 2 * share >= counts.sum()
                key = pa.array([None, *keys[often].view(np.int64).tolist()], pa.int64())
                n = pa.array([int(counts.sum()), *counts[often].tolist()], pa.int64())
                yield pa.RecordBatch.from_arrays([key, n], names=["key", "n"])

    counted = written(texts.select("body").mapInArrow(each, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "triggers")
    total = counted.filter("key IS NULL").select("n").collect()
    least = total[0].n / (2 * share) if total else 0
    return [r.key for r in counted.filter(F.col("key").isNotNull() & (F.col("n") >= least)).collect()]


def decided(found: np.ndarray, frequent: np.ndarray) -> pa.RecordBatch:
    """Occurrences (key, phrase, doc, tag, unit) of one task as rows of the parse."""
    key, phrase, doc, tag, unit = found
    order = np.lexsort((doc, phrase))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (phrase[order[1:]] != phrase[order[:-1]]) | (key[order[1:]] != key[order[:-1]])
    whole = np.empty(len(order), dtype=bool)
    whole[order] = doc[order] > doc[order[np.flatnonzero(new)[np.cumsum(new) - 1]]]
    part = np.where(np.isin(key, frequent), phrase, 0)
    columns = [np.where(whole, doc, key), np.where(whole, unit >> BLOCK, part), whole, np.where(whole, 0, phrase), doc, tag, unit]
    return pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["key", "part", "whole", "phrase", "doc", "tag", "unit"])


def parse(texts: DataFrame, frequent: list[int]) -> DataFrame:
    """The parse: one row per phrase occurrence. ``unit`` packs trigger place and the distances of its first and last start.

    ``whole`` is told where a task meets the phrase in a smaller document too, among ``GATHER`` occurrences: such a row is
    decided and needs no other, so document and place stand in for ``key`` and ``part``. Of a phrase that very many documents
    share, the other rows are few, those of one document for each ``GATHER`` occurrences. ``part`` is the phrase where the trigger is one of
    ``frequent``, else zero: rows that share key and part meet, so a frequent trigger is split by its phrases.
    """
    known = np.array(frequent, dtype=np.int64)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            docs = batch.column("doc").to_numpy(zero_copy_only=False)
            tags = batch.column("tag").to_numpy(zero_copy_only=False)
            for pieces, sizes, data, piece in _joined(batch):
                first, last, place, key, phrase = phrases(data, piece)
                of = piece[first]
                rows = np.array([p[0] for p in pieces])[of]
                shift = (np.array([p[1] for p in pieces]) - np.cumsum(sizes) + sizes)[of]
                unit = ((place + shift) << 10) | ((place - first) << 5) | (place - last)
                waiting.append(np.stack([key.view(np.int64), phrase.view(np.int64), docs[rows], tags[rows], unit]))
                size += len(unit)
                if size >= GATHER:
                    yield from _cut(decided(np.concatenate(waiting, axis=1), known))
                    waiting, size = [], 0
        if waiting:
            yield from _cut(decided(np.concatenate(waiting, axis=1), known))

    return texts.mapInArrow(each, "key long, part long, whole boolean, phrase long, doc long, tag long, unit long")


def _cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, ROWS):
        yield batch.slice(start, ROWS)


def shared_phrases(texts: DataFrame, share: int) -> DataFrame:
    """What the parse decides, and what it leaves open, of the phrases whose trigger also stands in another document.

    ``whole``: the phrase also occurs in a smaller document, and all its strings with it. Otherwise the row is open: this is
    the phrase's smallest document, and the trigger has other phrases too. First occurrences of a trigger's only phrase
    lose nothing and are left out; those of frequent triggers stay open, their phrases do not meet here.
    """
    met = ["key", "part", "whole"]
    by_key, by_phrase = Window.partitionBy(*met), Window.partitionBy(*met, "phrase")
    apart = F.col("whole") | (F.col("part") != 0)
    spread = parse(texts, frequent_triggers(texts, share)).withColumns({"low": F.min("doc").over(by_key), "high": F.max("doc").over(by_key)})
    spread = spread.filter(apart | (F.col("low") < F.col("high"))).drop("low", "high")
    several = spread.withColumns({"a": F.min("phrase").over(by_key), "b": F.max("phrase").over(by_key)})
    found = several.withColumn("least", F.min("doc").over(by_phrase))
    whole = F.col("whole") | (F.col("least") < F.col("doc"))
    kept = found.filter(whole | apart | (F.col("a") < F.col("b")))
    return kept.select(*[F.when(~whole, F.col(c)).alias(c) for c in ("key", "phrase")], "doc", "tag", "unit", whole.alias("whole"))


def open_phrases(batch: pa.RecordBatch, row: int) -> pa.RecordBatch:
    """The phrases asked of one document, once for each side on which their strings reach ``HALF`` bytes beyond the trigger."""
    doc, body = batch.column("doc")[row].as_py(), batch.column("body")[row].as_py()
    units = batch.column("units").slice(row, 1).flatten()
    key, phrase, unit = (units.field(n).to_numpy(zero_copy_only=False) for n in range(3))
    place, lead, trail = _unpacked(unit)
    side = np.concatenate([np.zeros(len(unit), dtype=np.int64), np.ones(len(unit), dtype=np.int64)])
    of = np.tile(np.arange(len(unit)), 2)
    reach = np.where(side == 0, lead[of] >= HALF, trail[of] < HALF)
    side, of = side[reach], of[reach]
    first, stop = (place - lead)[of], (place - trail)[of] + SPAN
    near = np.where(side == 0, place[of] - HALF, place[of] + TRIGGER)
    said = pa.array([body[a:b] for a, b in zip(first.tolist(), stop.tolist())], pa.binary())
    beside = pa.array([body[a : a + HALF] for a in near.tolist()], pa.binary())
    # Strings that begin HALF bytes or more before the trigger are the left side's, the others the right side's.
    low = np.where(side == 0, 0, np.maximum(0, lead[of] - HALF + 1))
    high = np.where(side == 0, np.minimum(lead[of] - HALF, (lead - trail)[of]), (lead - trail)[of])
    arrays = [pa.array(x) for x in (key[of], side)] + [beside, said]
    arrays += [pa.array(x) for x in (phrase[of], np.full(len(of), doc), lead[of], low, high)]
    return pa.RecordBatch.from_arrays(arrays, names=["key", "side", "beside", "said", "phrase", "doc", "lead", "low", "high"])


def suffix_marks(texts: DataFrame, shared: DataFrame) -> DataFrame:
    """(key, phrase, doc, mask): which starts of a phrase, in its smallest document, repeat a string of a smaller one.

    Phrases that share no more than the trigger with another document drop out first: a string holds ``HALF`` bytes at least
    on one side of its trigger. The suffixes of the others are sorted, and equal ones take their smallest document.
    """
    asked = shared.filter("NOT whole").groupBy("key", "phrase", "doc").agg(F.min(F.struct("tag", "unit")).alias("at"))
    asked = asked.select("doc", "at.tag", F.struct("key", "phrase", "at.unit").alias("u"))
    asked = asked.groupBy("doc", "tag").agg(F.collect_list("u").alias("units"))
    met = _with_units(texts, asked, "inner")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            for row in range(batch.num_rows):
                waiting.append(open_phrases(batch, row))
                size += waiting[-1].num_rows
                if size >= ROWS:
                    yield pa.concat_batches(waiting)
                    waiting, size = [], 0
        if waiting:
            yield pa.concat_batches(waiting)

    schema = "key long, side long, beside binary, said binary, phrase long, doc long, lead long, low long, high long"
    around = Window.partitionBy("key", "side", "beside")
    sided = met.mapInArrow(each, schema).withColumns({"a": F.min("doc").over(around), "b": F.max("doc").over(around)})
    sided = written(sided.filter("a < b").select("key", "phrase", "doc", "said", "lead", "low", "high"), "dictionary", tidy=True)
    bits = sided.select("key", "phrase", "doc", "said", "lead", F.explode(F.sequence("low", "high")).alias("bit"))
    suffixes = bits.select("key", "phrase", "doc", "bit", (F.col("lead") - F.col("bit")).alias("lead"), F.expr(f"substring(said, CAST(bit AS INT) + 1, {SPAN})").alias("suffix"))
    order = Window.partitionBy("key", "lead", "suffix")
    marked = suffixes.withColumn("least", F.min("doc").over(order)).filter("least < doc")
    return marked.groupBy("key", "phrase", "doc").agg(F.expr("bit_or(shiftleft(1L, CAST(bit AS INT)))").alias("mask"))


def _unpacked(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigger place, distance of the first start, distance of the last start."""
    return unit >> 10, (unit >> 5) & 31, unit & 31


def _with_units(texts: DataFrame, units: DataFrame, how: str) -> DataFrame:
    other = units.select(F.col("doc").alias("of_doc"), F.col("tag").alias("of_tag"), "units").hint("shuffle_hash")
    joined = texts.join(other, (F.col("doc") == F.col("of_doc")) & (F.col("tag") == F.col("of_tag")), how)
    return joined.select("doc", "tag", "body", "units")


def removed_bytes(body: bytes, unit: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Which bytes are covered by the marked strings."""
    place, lead, _ = _unpacked(unit)
    row, bit = np.nonzero((mask[:, None] >> np.arange(STARTS)) & 1)
    start = (place - lead)[row] + bit
    steps = np.zeros(len(body) + 1, dtype=np.int32)
    np.add.at(steps, start, 1)
    np.add.at(steps, start + SPAN, -1)
    return np.cumsum(steps[:-1]) > 0


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", share: int = SHARE) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans and ``kept``, the bytes that remain.

    A byte is removed if a ``SPAN``-byte string of its text covers it that also starts in a document with a smaller id. NULL
    texts are empty; texts shorter than ``SPAN`` bytes lose nothing. A NULL id counts as larger than all others, rows of
    one id do not remove from each other. Equal rows get equal results. ``share`` says which triggers are frequent (see
    ``frequent_triggers``); it changes the work, not the result.
    """
    texts = bodies(docs, doc_id, text)
    shared = written(shared_phrases(texts, share), "phrases", tidy=True)
    marks = written(suffix_marks(texts, shared), "suffix-marks", tidy=True)
    starts = F.expr("shiftleft(1L, CAST((shiftright(unit, 5) & 31) - (unit & 31) + 1 AS INT)) - 1")
    whole = shared.filter("whole").select("doc", "tag", "unit", starts.alias("mask"))
    first = shared.filter("NOT whole").select("key", "phrase", "doc", "tag", "unit")
    part = first.join(marks, ["key", "phrase", "doc"]).select("doc", "tag", "unit", "mask")
    hits = whole.unionAll(part).select("doc", "tag", F.struct("unit", "mask").alias("u"))
    hits = hits.groupBy("doc", "tag").agg(F.collect_list("u").alias("units"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in range(batch.num_rows):
                body, units = batch.column("body")[row].as_py() or b"", batch.column("units").slice(row, 1).flatten()
                if not len(units):
                    out.append((len(body), 0, 0, body))
                    continue
                unit, mask = (units.field(n).to_numpy(zero_copy_only=False) for n in range(2))
                gone = removed_bytes(body, unit, mask)
                spans = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
                kept = np.frombuffer(body, dtype=np.uint8)[~gone].tobytes()
                out.append((len(body), int(gone.sum()), spans, kept))
            columns = list(zip(*out)) or [[]] * 4
            arrays = [batch.column("doc"), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc", "n_bytes", "n_removed", "n_spans", "kept"])

    done = _with_units(texts, hits, "left").mapInArrow(each, "doc long, n_bytes long, n_removed long, n_spans long, kept binary")
    return done.select(F.expr(f"nullif(doc, {LAST_ID})").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept")
