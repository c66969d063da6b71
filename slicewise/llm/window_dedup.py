"""Removal of repeated word windows by Rabin-Karp hashes.

Every window of ``WINDOW`` consecutive words gets a rolling hash: the sum of its words' hashes times powers of a base,
modulo 2**64, from sums over the text's words. All windows of all texts are hashed and counted by Spark: a batch of texts
hands its windows on in slots, by the first bits of the hash, with the document of each; a slot meets the same slot of
all other batches, finds the smallest document of each hash, and answers which windows also start in a smaller one.
Repeated windows of a text are then merged into maximal runs of words to remove.

The hashes of a batch travel packed, as one binary of a batch and slot, not as a row each: most windows of a corpus are
unlike all others, and this is what they cost. A hash that stands in a batch many times travels once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import row_key, runs_of, same_row, written

WINDOW = 20
BATCH_BYTES = 1 << 23  # text of a batch; its windows are held at once, at about 60 bytes a word
SLOT_BYTES, MIN_SLOTS = 1 << 24, 1024  # text of the whole corpus for each slot; its windows are held at once
PIECE = 1 << 20  # text that is split into words at once
CHECK_BITS = 16  # bits of a second hash beside the 64 of the first
LAST_ID = (1 << 63) - 1

SPACE = re.compile(rb"[\x20\x09-\x0D]")
_ODD = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # bases of the two hashes


def word_hashes(body: bytes) -> np.ndarray:
    """The 64-bit hash of each word ``[^\\x20\\x09-\\x0D]+`` of a text; a long text is split piece by piece."""
    parts, at = [np.empty(0, dtype=np.uint64)], 0
    while at < len(body):
        end = SPACE.search(body, at + PIECE)
        stop = end.start() if end else len(body)
        words = body[at:stop].split()
        parts.append(np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words)))
        at = stop
    return np.concatenate(parts)


def window_hashes(words: np.ndarray, base: int, window: int = WINDOW) -> np.ndarray:
    """The Rabin-Karp hash of every window of the word hashes.

    With sums s of word i times base**-i, the window from i on is (s[i + window] - s[i]) * base**i.
    """
    n = len(words)
    up, down = (np.full(n, b, dtype=np.uint64) for b in (base, pow(base, -1, 1 << 64)))
    for powers in (up, down):
        powers[:1] = 1
        np.multiply.accumulate(powers, out=powers)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(words * down, out=sums[1:])
    found = (sums[window:] - sums[:-window]) * up[: max(0, n + 1 - window)]
    return (found ^ (found >> np.uint64(32))) * np.uint64(_ODD[1])


def _repeated(h: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows whose hash occurs more than once, by hash and then by the keys, and where a new (hash, first key) begins."""
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    shared = np.zeros(len(h), dtype=bool)
    shared[1:] = same
    shared[:-1] |= same
    several = order[shared]
    rows = several[np.lexsort((several, *(k[several] for k in keys[::-1]), h[several]))]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (h[rows[1:]] != h[rows[:-1]]) | (keys[0][rows[1:]] != keys[0][rows[:-1]])
    return rows, new


def _first(values: np.ndarray, new: np.ndarray) -> np.ndarray:
    """For each row the value at the start of its group."""
    return values[np.flatnonzero(new)][np.cumsum(new) - 1]


def _pack(h: np.ndarray, check: np.ndarray, doc: np.ndarray, at: np.ndarray) -> bytes:
    """Windows in text order: seven bytes of the hash (the slot holds the first), the check, and the steps of document and place,
    byte by byte, so that bytes that are zero lie together for the compression of the shuffle."""
    steps = np.stack([np.diff(doc, prepend=0), np.diff(at, prepend=0)]).view(np.uint8).reshape(2, -1, 8)
    tail = steps.transpose(0, 2, 1).reshape(16, -1)
    return h.view(np.uint8).reshape(-1, 8)[:, :7].tobytes() + check.tobytes() + tail.tobytes()


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n = len(data) // 25
    raw = np.frombuffer(data, dtype=np.uint8)
    h = np.zeros((n, 8), dtype=np.uint8)
    h[:, :7] = raw[: 7 * n].reshape(n, 7)
    check = raw[7 * n : 9 * n].copy().view(np.uint16)
    steps = np.ascontiguousarray(raw[9 * n :].reshape(2, 8, n).transpose(0, 2, 1)).view(np.int64).reshape(2, n)
    return h.view(np.uint64).reshape(n), check, np.cumsum(steps[0]), np.cumsum(steps[1])


def hash_batch(rows: list[tuple[int, int, bytes]], slots: int, window: int = WINDOW, salt: int = 0) -> Iterator[tuple[int, int, bytes]]:
    """(batch, slot, data) of some rows (doc, text key, text).

    One record for each slot with windows, and one of slot -1 that says what the batch is: the rows, what is settled inside
    it, and which windows share the answer of another one. Settled are a window whose hash stands earlier in the same row and
    one that stands in a smaller document of the batch. Of the others only the first of a hash is asked. The batch's name is
    a hash of its rows and ``salt``.
    """
    words = [word_hashes(body) for _, _, body in rows]
    lengths = np.array([len(w) for w in words])
    sizes = np.maximum(0, lengths - window + 1)
    docs, keys = (np.array(x, dtype=np.int64) for x in zip(*[r[:2] for r in rows]))
    flat, row = np.concatenate(words), np.repeat(np.arange(len(rows)), lengths)
    whole = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths) < sizes[row]
    row = row[whole]
    doc = docs[row]
    h, g = (window_hashes(flat, base, window)[whole[: max(0, len(flat) - window + 1)]] for base in _ODD)
    check = (g >> np.uint64(64 - CHECK_BITS)).astype(np.uint16)
    order, new = _repeated(h, check, doc, row)
    by_doc, by_row = doc[order], row[order]
    again = np.zeros(len(order), dtype=bool)
    again[1:] = (by_row[1:] == by_row[:-1]) & ~new[1:]
    gone = again | (by_doc > _first(by_doc, new))
    follows = ~gone & ~new
    settled, leader = np.sort(order[gone]), _first(order, new)[follows]
    alone = np.ones(len(h), dtype=bool)
    alone[order[~new]] = False
    asked = np.flatnonzero(alone)
    name = xxhash.xxh64_intdigest(np.concatenate([docs, keys, sizes]).tobytes(), salt) >> 1
    head = [np.array([len(rows), len(asked), len(settled), len(leader)]), docs, keys, sizes]
    yield name, -1, np.concatenate([*head, settled, order[follows], leader]).astype(np.int64).tobytes()
    slot = (h[asked] >> np.uint64(65 - slots.bit_length())).astype(np.int64)
    by_slot = np.argsort(slot, kind="stable")
    cuts = np.searchsorted(slot[by_slot], np.arange(slots + 1))
    for k in np.flatnonzero(np.diff(cuts)):
        at = asked[by_slot[cuts[k] : cuts[k + 1]]]
        yield name, int(k), _pack(h[at], check[at], doc[at], at)


def slot_answers(said: list[tuple[int, bytes]]) -> Iterator[tuple[int, int, np.ndarray]]:
    """Per batch of a slot: how many windows it asked, and the places of those that also start in a smaller document."""
    parts = [_unpack(data) for _, data in said]
    h, check, doc, at = (np.concatenate(x) for x in zip(*parts))
    order, new = _repeated(h, check, doc)
    gone = np.zeros(len(h), dtype=bool)
    gone[order] = doc[order] > _first(doc[order], new)
    stop = 0
    for (batch, _), part in zip(said, parts):
        start, stop = stop, stop + len(part[0])
        yield batch, stop - start, at[start:stop][gone[start:stop]]


def batch_runs(data: bytes, answers: list[tuple[int, bytes]], window: int = WINDOW) -> Iterator[tuple[int, int, list[int], list[int]]]:
    """(doc, text key, starts, stops) of the rows of a batch that lose words: maximal runs of words to remove."""
    values = np.frombuffer(data, dtype=np.int64)
    n, asked, n_settled, n_follows = values[:4].tolist()
    docs, keys, sizes, settled, follows, leader = np.split(values[4:], np.cumsum([n, n, n, n_settled, n_follows]))
    if sum(k for k, _ in answers) != asked:
        raise RuntimeError("the texts came in another order when a task was repeated: write them to a table first")
    gone = np.zeros(int(sizes.sum()), dtype=bool)
    gone[settled] = True
    for _, places in answers:
        gone[np.frombuffer(places, dtype=np.uint32)] = True
    gone[follows] = gone[leader]
    ends = np.cumsum(sizes)
    for k in np.unique(np.searchsorted(ends, np.flatnonzero(gone), side="right")).tolist():
        hit = np.flatnonzero(gone[ends[k] - sizes[k] : ends[k]])
        apart = np.flatnonzero(np.diff(hit) > window) + 1
        starts, stops = hit[np.append(0, apart)], hit[np.append(apart - 1, len(hit) - 1)] + window
        yield int(docs[k]), int(keys[k]), starts.tolist(), stops.tolist()


def slots_of(docs: DataFrame, text: str = "text") -> int:
    """How many slots, a power of two that grows with the bytes of all texts."""
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(MIN_SLOTS, 1 << (total // SLOT_BYTES).bit_length())


def repeated_runs(texts: DataFrame, slots: int, window: int = WINDOW, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """(doc, text_key, starts, stops) of every text (doc, text_key, body) that loses words; equal rows give one row."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, done = TaskContext.get().partitionId(), 0

        def packed(rows):
            nonlocal done
            done += 1
            batch, slot, data = zip(*hash_batch(rows, slots, window, task << 32 | done))
            return pa.RecordBatch.from_arrays([pa.array(batch), pa.array(slot), pa.array(data, pa.binary())], names=["batch", "slot", "data"])

        waiting, size = [], 0
        for part in batches:
            for row in zip(*(part.column(k) for k in range(3))):
                doc, key, body = (x.as_py() for x in row)
                waiting.append((doc, key, body or b""))
                size += len(waiting[-1][2])
                if size >= batch_bytes:
                    yield packed(waiting)
                    waiting, size = [], 0
        if waiting:
            yield packed(waiting)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slot, records in runs_of(batches, "slot", ["batch", "data"]):
            if slot < 0:
                out = ([(b, None, d)] for b, d in records)
            else:
                found = slot_answers(list(records))
                out = [[(b, n, places.astype(np.uint32).tobytes()) for b, n, places in found]]
            for some in out:
                batch, asked, data = zip(*some)
                arrays = [pa.array(batch), pa.array(asked, pa.int64()), pa.array(data, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["batch", "asked", "data"])

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, records in runs_of(batches, "batch", ["asked", "data"]):
            _, data = next(records)  # what the batch is comes first
            rows = list(batch_runs(data, list(records), window))
            if rows:
                columns = zip(("doc", "text_key", "starts", "stops"), zip(*rows))
                yield pa.RecordBatch.from_pydict(dict(columns))

    hashed = texts.mapInArrow(ask, "batch long, slot long, data binary")
    # Descriptions of batches are spread over the tasks, the windows of a slot come together.
    lot = F.when(F.col("slot") < 0, F.col("batch")).otherwise(F.col("slot"))
    met = hashed.repartition(F.col("slot"), lot).sortWithinPartitions("slot", "batch")
    said = written(met.mapInArrow(answer, "batch long, asked long, data binary"), "windows", tidy=True)
    told = said.repartition("batch").sortWithinPartitions("batch", F.col("asked").asc_nulls_first())
    found = told.mapInArrow(settle, "doc long, text_key long, starts array<long>, stops array<long>")
    return found.groupBy("doc", "text_key").agg(F.first("starts").alias("starts"), F.first("stops").alias("stops"))


def remove_windows(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, ``spans`` (maximal runs of removed words, from and to) and ``kept``.

    A word is removed if a window of ``window`` words covers it whose word sequence also starts in a document with a smaller
    id, or earlier in the same row. ``kept`` is what remains, joined by one space. NULL texts have no words; texts of fewer
    words than a window lose none. A NULL id counts as larger than all others; different texts of one id do not remove from
    each other; equal rows get equal results. Windows are equal if 80 bits of two hashes are: of n different windows about
    n**2 / 2**81 pairs are taken for equal by chance.
    """
    doc = F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID)).alias("doc_id")
    chosen = docs.select(doc, F.col(text).alias("text"))
    texts = chosen.select(*row_key(), F.col("text").cast("binary").alias("body"))
    slots = slots_of(chosen)
    found = written(repeated_runs(texts.withColumnRenamed("doc_id", "doc"), slots, window, batch_bytes), "runs", tidy=True)
    found = found.withColumnRenamed("doc", "doc_id")
    met = texts.join(found, same_row(texts, found), "left").select(texts["doc_id"], "body", "starts", "stops")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for body, starts, stops in zip(*(batch.column(k) for k in (1, 2, 3))):
                words = (body.as_py() or b"").split()
                spans = list(zip(starts.as_py() or [], stops.as_py() or []))
                kept, at = [], 0
                for start, stop in spans:
                    kept += words[at:start]
                    at = stop
                kept += words[at:]
                told = [{"start": a, "stop": b} for a, b in spans]
                out.append((len(words), len(words) - len(kept), told, b" ".join(kept).decode()))
            n, gone, spans, kept = zip(*out) if out else [()] * 4
            span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            arrays = [batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, span), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "n_removed", "spans", "kept"])

    schema = "doc_id long, n_words long, n_removed long, spans array<struct<start: long, stop: long>>, kept string"
    done = met.mapInArrow(each, schema)
    return done.select(F.expr(f"nullif(doc_id, {LAST_ID})").alias("doc_id"), "n_words", "n_removed", "spans", "kept")
