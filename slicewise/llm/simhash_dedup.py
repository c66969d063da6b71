"""SimHash near-duplicates: candidates by pigeonring chains, verified by the full Hamming distance.

A fingerprint is cut into five segments on a ring. Two fingerprints that differ in at most four bits have a segment from
which on every chain of l segments differs in at most l * 4 / 5 bits: 0, 1, 2, 3 and 4. The first two steps make the index:
the first segment is equal, so is one half of the second, and either its other half or a half of the third. These are
five keys of about 26 bits for each start, 25 in all, that no link can escape. Inside a bucket the longer chains are
checked step by step, and what is left by the full distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import dealt_out, row_key, runs, written
from .components import components

SHINGLE, BITS, MAX_BITS = 4, 64, 4
SEED = 42
BLOCK = 4096
# First bit of each segment of the ring, and the end.
SEGMENTS = [0, 13, 26, 39, 52, 64]


def fingerprint(text: str | None) -> int:
    """SimHash of the word shingles of a whole text, repeats included; zero without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    ends = np.cumsum(sizes) - 1
    starts = ends - sizes + 1
    if len(words) > SHINGLE:
        starts, ends = starts[: 1 - SHINGLE], ends[SHINGLE - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist())]
    counts = np.zeros(BITS, dtype=np.int64)
    for k in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[k : k + (1 << 16)], dtype="<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_key, fp): the fingerprint of each row as a signed long."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (x.as_py() for x in batch.column("text"))
            fps = np.fromiter(map(fingerprint, texts), dtype=np.uint64, count=batch.num_rows).view(np.int64)
            columns = [batch.column("doc_id"), batch.column("text_key"), pa.array(fps)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "fp"])

    number, key = row_key(doc_id, text)
    chosen = docs.select(number.cast("long").alias("doc_id"), key, F.col(text).alias("text"))
    return chosen.mapInArrow(each, "doc_id long, text_key long, fp long")


def _mask(first: int, stop: int) -> int:
    return (1 << stop) - (1 << first)


def _segment(i: int) -> tuple[int, int]:
    return SEGMENTS[i % 5], SEGMENTS[i % 5 + 1]


def _halves(i: int) -> list[int]:
    first, stop = _segment(i)
    middle = (first + stop) // 2
    return [_mask(first, middle), _mask(middle, stop)]


def index_masks() -> list[int]:
    """The 25 index masks, five for each start on the ring."""
    masks = []
    for i in range(5):
        whole, (a, b), (c, d) = _mask(*_segment(i)), _halves(i + 1), _halves(i + 2)
        masks += [whole | a | b, whole | a | c, whole | a | d, whole | b | c, whole | b | d]
    return masks


def chain_masks(start: int) -> list[np.uint64]:
    """Masks of the chains of two, three, four and all five segments from ``start`` on."""
    out, mask = [], _mask(*_segment(start))
    for step in range(1, 5):
        mask |= _mask(*_segment(start + step))
        out.append(np.uint64(mask))
    return out


def linked(ours: np.ndarray, others: np.ndarray, chains: list[np.uint64]) -> np.ndarray:
    """Which of ``others`` links to any of ``ours`` (both unsigned, equal in the first segment of the chain)."""
    hit = np.zeros(len(others), dtype=bool)
    for fp in ours:
        left = np.flatnonzero(~hit)
        for budget, chain in enumerate(chains, 1):  # chains of 2, 3, 4 and 5 segments: 1, 2, 3 and 4 bits
            left = left[np.bitwise_count((others[left] ^ fp) & chain) <= budget]
        hit[left] = True
    return hit


def bucket_links(fps: np.ndarray, start: int) -> list[tuple[int, int]]:
    """Links that connect the members of one bucket as all links inside it do, one a member at most.

    A search over the bucket: members found once are not compared again, so a group of near copies costs far less than
    all its pairs and gives as many links as members.
    """
    chains, links = chain_masks(start), []
    left = fps
    while len(left) > 1:
        root, left = left[0], left[1:]
        front = np.array([root], dtype=np.uint64)
        while len(front) and len(left):
            hit = linked(front, left, chains)
            front, left = left[hit], left[~hit]
            links += [(int(root), int(x)) for x in front]
    return links


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that connect all within ``MAX_BITS`` bits, and only those.

    Buckets of more than ``BLOCK`` fingerprints are dealt out as pairs of parts, so a task holds two parts at most.
    """
    keys = [
        F.struct(F.lit(no).alias("no"), F.col("fp").bitwiseAND(F.lit(np.uint64(mask).astype(np.int64).item())).alias("key"))
        for no, mask in enumerate(index_masks())
    ]
    keyed = fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.no", "k.key")
    shared = keyed.groupBy("no", "key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = written(shared.select(F.col("no").alias("of_no"), F.col("key").alias("of_key"), "n"), "buckets")
    dealt = keyed.join(shared, (F.col("no") == F.col("of_no")) & (F.col("key") == F.col("of_key")))
    parts = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("fp"), parts).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    dealt = dealt.select("no", "key", F.least("part", "other").alias("one"), F.greatest("part", "other").alias("two"), "fp")
    group = ["no", "key", "one", "two"]

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for bucket in runs(batches, group):
            members = np.unique(bucket["fp"].to_numpy().view(np.uint64))
            links = bucket_links(members, int(bucket["no"].iloc[0]) // 5)
            if links:
                pairs = np.array(links, dtype=np.uint64).view(np.int64)
                yield pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    return dealt_out(dealt, group).mapInPandas(each, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_key, fp, component, component_id) of every row of ``docs``.

    ``component`` is the smallest fingerprint that links lead to and names the group; ``component_id`` is the smallest id in
    it, the row's own included. Texts without words (NULL, empty) have fingerprint zero and link like any other. A row with a
    NULL id takes part in links and gets the component's smallest id, NULL only if there is none. Repeated rows and equal texts
    share a fingerprint, and links are made between distinct fingerprints, so groups of copies cost no pairs.
    """
    marked = written(fingerprints(docs, doc_id, text), "fingerprints")
    first = written(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    roots = components(written(fingerprint_links(first.select("fp")), "fingerprint-links"))
    rooted = first.join(roots, first["fp"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("component")
    )
    least = rooted.groupBy(F.col("component").alias("of_component")).agg(F.min("first_id").alias("component_id"))
    named = rooted.join(least, F.col("component") == F.col("of_component"))
    named = written(named.select(F.col("fp").alias("of_fp"), "component", "component_id"), "components")
    joined = marked.join(named, F.col("fp") == F.col("of_fp"))
    return joined.select("doc_id", "text_key", "fp", "component", "component_id")
