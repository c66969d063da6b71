"""Benchmark decontamination by a positional inverted index of the documents.

Test items are cut into windows of words. For each window the terms are ranked by how often the documents use them, and
postings (term, document, positions) are stored for the rarest. A posting less the term's place in the item is the place
where the item would begin in the document; lists that agree on it are intersected, and what is left is checked against
the words of the document. Nothing but the terms asked for is broadcast, block by block of test items, each of a bounded size.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import likely_rows, same_row, written

WINDOW = 10
RAREST = 2
BLOCK_WORDS = 1_000_000

# Digits, letters and every byte of a character beyond ASCII make words; A-Z are lower-cased.
_FOLD = bytes(
    c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256)
)


def words(text: str | None) -> list[bytes]:
    """Runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z; NULL has none."""
    return (text or "").encode().translate(_FOLD).split()


def _with_key(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    key = F.xxhash64(F.col(text).isNull(), F.col(text))
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), key.alias("text_key"), F.col(text).alias("text"))


def item_words(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, place, term) of every word of the items. Items of one id are taken as one item per text."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for item, said in zip(batch["item_id"], batch["text"]):
                terms = [w.decode() for w in words(said)]
                if terms:
                    yield pd.DataFrame({"item_id": item, "place": np.arange(len(terms), dtype=np.int32), "term": terms})

    # Ids travel as text: they are sorted and joined as strings in the end.
    chosen = items.select(F.col(item_id).cast("string").alias("item_id"), F.col(text).alias("text")).distinct()
    chosen = chosen.filter("item_id IS NOT NULL")
    made = chosen.withColumn("item_key", F.concat_ws(":", "item_id", F.sha2("text", 256)))
    made = made.select(F.col("item_key").alias("item_id"), "text").mapInPandas(each, "item_id string, place int, term string")
    return made.withColumnRenamed("item_id", "item_key")


def term_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """How often each term occurs in all documents; counted inside each task before the shuffle."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter[bytes] = Counter()
            for x in batch.column(0):
                counts.update(words(x.as_py()))
            terms = pa.array(list(counts.keys()), pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([terms, pa.array(list(counts.values()), pa.int64())], names=["term", "n"])

    return docs.select(text).mapInArrow(each, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def anchors(tests: DataFrame, counts: DataFrame, rarest: int = RAREST, window: int = WINDOW) -> DataFrame:
    """(item_key, place, term) of the rarest places of every window whose terms all occur.

    ``tests`` is the output of ``item_words``. Ties go to the earlier place.
    """
    sizes = tests.groupBy(F.col("item_key").alias("of_item")).agg(F.count("*").alias("size"))
    sized = tests.join(sizes, F.col("item_key") == F.col("of_item")).join(
        counts.withColumnRenamed("term", "of_term"), F.col("term") == F.col("of_term"), "left"
    )
    last = F.greatest(F.col("size") - window, F.lit(0))
    first = F.greatest(F.col("place") - (window - 1), F.lit(0))
    in_windows = sized.withColumn("window", F.explode(F.sequence(first, F.least(F.col("place").cast("long"), last))))
    by_window = Window.partitionBy("item_key", "window")
    ranked = in_windows.withColumns(
        {
            "rank": F.row_number().over(by_window.orderBy("n", "place")),
            "absent": F.max(F.col("n").isNull()).over(by_window),
        }
    )
    return ranked.filter((F.col("rank") <= rarest) & ~F.col("absent")).select("item_key", "place", "term").distinct()


def store_index(docs: DataFrame, terms: list[str]) -> DataFrame:
    """The index, written: per document its key, ``n_words`` and the postings (term, positions) of ``terms``."""
    spark = docs.sparkSession
    asked = spark.sparkContext.broadcast({t.encode(): t for t in terms})
    posting = pa.struct([("term", pa.string()), ("positions", pa.list_(pa.int32()))])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = asked.value
        for batch in batches:
            sizes, postings = [], []
            for x in batch.column("text"):
                said = words(x.as_py())
                found: dict[str, list[int]] = {}
                for i, w in enumerate(said):
                    if w in known:
                        found.setdefault(known[w], []).append(i)
                sizes.append(len(said))
                postings.append([{"term": t, "positions": p} for t, p in found.items()])
            arrays = [batch.column("doc_id"), batch.column("text_key"), pa.array(sizes, pa.int64()), pa.array(postings, pa.list_(posting))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "text_key", "n_words", "postings"])

    schema = "doc_id long, text_key long, n_words long, postings array<struct<term: string, positions: array<int>>>"
    return written(docs.mapInArrow(each, schema), "postings")


def candidates(index: DataFrame, chosen: DataFrame, rarest: int = RAREST, slop: int = 0) -> DataFrame:
    """(doc_id, text_key, item_key, low, high): where items may begin, from intersected offset-adjusted postings.

    A place stays if ``rarest`` different anchors of the item, or all it has, point to it, up to ``slop`` words apart.
    """
    lists = index.filter(F.size("postings") > 0).select("doc_id", "text_key", F.explode("postings").alias("p"))
    lists = lists.select("doc_id", "text_key", F.col("p.term").alias("has_term"), "p.positions")
    need = chosen.groupBy(F.col("item_key").alias("of_item")).agg(F.least(F.count("*"), F.lit(rarest)).alias("need"))
    asked = chosen.join(need, F.col("item_key") == F.col("of_item")).select("item_key", "place", "term", "need")
    met = lists.join(asked, F.col("has_term") == F.col("term"))
    met = met.select("doc_id", "text_key", "item_key", "place", "need", F.explode("positions").alias("position"))
    met = met.withColumn("begin", F.col("position") - F.col("place"))
    band = F.floor(F.col("begin") / (slop + 1))
    bands = F.array(band, band + 1) if slop else F.array(band)
    grouped = met.withColumn("band", F.explode(bands)).groupBy("doc_id", "text_key", "item_key", "band")
    kept = grouped.agg(
        F.min("place").alias("first"), F.max("place").alias("last"), F.max("need").alias("need"),
        F.min("begin").alias("low"), F.max("begin").alias("high"),
    ).filter((F.col("need") < 2) | (F.col("first") < F.col("last")))
    return kept.select("doc_id", "text_key", "item_key", "low", "high").distinct()


def _runs_of(said: list[bytes], item: list[bytes], begin: int, size: int) -> Iterator[tuple[int, int]]:
    """Stretches of at least ``size`` words on which the item, begun at ``begin``, and the document agree."""
    first, stop = max(0, -begin), min(len(item), len(said) - begin)
    start = None
    for place in range(first, stop + 1):
        same = place < stop and said[begin + place] == item[place]
        if same and start is None:
            start = place
        elif not same and start is not None:
            if place - start >= size:
                yield begin + start, begin + place
            start = None


def _near(said: list[bytes], item: list[bytes], low: int, high: int, size: int, slop: int) -> bool:
    """Whether all words of a window of the item lie within ``size + slop`` words of the document near the place."""
    for window in range(len(item) - size + 1):
        want = Counter(item[window : window + size])
        for at in range(max(0, window + low - slop), min(len(said) - size, window + high + slop) + 1):
            if not want - Counter(said[at : at + size + slop]):
                return True
    return False


def matches(docs: DataFrame, found: DataFrame, tests: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """Per document with a match: its key, ``spans`` (start, stop, item_key) of exact phrases and ``near`` item keys.

    ``found`` is what ``candidates`` gives. The words of the documents and of the items decide. Texts without a candidate are
    not shuffled, but for a few.
    """
    said_items = tests.groupBy("item_key").agg(F.array_sort(F.collect_list(F.struct("place", "term"))).alias("w"))
    said_items = said_items.select(F.col("item_key").alias("of_item"), F.col("w.term").alias("terms"))
    named = found.join(said_items, F.col("item_key") == F.col("of_item"))
    by_item = named.groupBy("doc_id", "text_key", "item_key", "terms").agg(F.collect_set(F.struct("low", "high")).alias("places"))
    by_doc = by_item.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("item_key", "terms", "places")).alias("asked"))

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, key, text, asked in zip(batch["doc"], batch["text_key"], batch["text"], batch["asked"]):
                said, spans, near = words(text), set(), set()
                for one in asked:
                    item = [t.encode() for t in one["terms"]]
                    size = min(window, len(item))
                    begins = {b for p in one["places"] for b in range(p["low"], p["high"] + 1)}
                    exact = {span for b in begins for span in _runs_of(said, item, b, size)}
                    spans |= {(a, b, one["item_key"]) for a, b in exact}
                    if slop and not exact and any(_near(said, item, p["low"], p["high"], size, slop) for p in one["places"]):
                        near.add(one["item_key"])
                if spans or near:
                    told = [{"start": a, "stop": b, "item_key": i} for a, b, i in sorted(spans)]
                    out.append((doc, key, told, sorted(near)))
            yield pd.DataFrame(out, columns=["doc", "text_key", "spans", "near"])

    hit = by_doc.hint("shuffle_hash")
    likely = likely_rows(docs, found, "text_key")
    joined = likely.join(hit, same_row(likely, hit)).select(
        likely["doc_id"].cast("string").alias("doc"), likely["text_key"], "text", "asked"
    )
    span = "array<struct<start: int, stop: int, item_key: string>>"
    checked = joined.mapInPandas(each, f"doc string, text_key long, spans {span}, near array<string>")
    return checked.select(F.col("doc").cast("long").alias("doc_id"), "text_key", "spans", "near")


def blocks_of(tests: DataFrame, block_words: int = BLOCK_WORDS) -> list[DataFrame]:
    """``tests`` in blocks of whole items, about ``block_words`` words each, so that what a block broadcasts is bounded."""
    n = tests.count()
    count = max(1, -(-n // block_words))
    if count == 1:
        return [tests] if n else []
    part = F.pmod(F.xxhash64("item_key"), F.lit(count))
    return [tests.filter(part == k) for k in range(count)]


def find_matches(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    slop: int = 0,
    rarest: int = RAREST,
    block_words: int = BLOCK_WORDS,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, n_words, ``spans`` of exact window matches and ``near`` matches.

    A window is ``window`` consecutive words of an item; an item of fewer words is one window. Touching windows make one
    span. With ``slop`` an item without an exact match is ``near`` where a window's words lie within ``window + slop`` words
    in any order and its rarest terms keep their distance up to ``slop``. NULL and empty texts have no words and no matches,
    NULL items do not count, items of one id count once each text. Repeated rows get the same result once a row.
    """
    keyed = _with_key(docs, doc_id, text)
    tests = written(item_words(items, item_id, item_text), "test-words")
    counts = None
    found = []
    sizes = None
    for block in blocks_of(tests, block_words):
        if counts is None:
            asked = tests.select(F.col("term").alias("asked_term")).distinct()
            counts = written(term_counts(keyed).join(asked, F.col("term") == F.col("asked_term"), "left_semi"), "term-counts")
        chosen = written(anchors(block, counts, rarest, window), "anchors")
        terms = [r.term for r in chosen.select("term").distinct().collect()]  # at most the words of a block
        index = store_index(keyed, terms)
        sizes = index if sizes is None else sizes
        places = written(candidates(index, chosen, rarest, slop), "places")
        found.append(written(matches(keyed, places, block, window, slop), "matches"))
    if sizes is None:
        sizes = store_index(keyed, [])
    sizes = sizes.select("doc_id", "text_key", "n_words")
    if not found:
        span = "array<struct<start: int, stop: int, item_key: string>>"
        return sizes.select("*", F.array().cast(span).alias("spans"), F.array().cast("array<string>").alias("near"))
    every = found[0]
    for more in found[1:]:
        every = every.unionAll(more)
    every = every.groupBy("doc_id", "text_key").agg(
        F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"), F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")
    )
    joined = sizes.join(every, same_row(sizes, every), "left")
    return joined.select(
        sizes["doc_id"],
        sizes["text_key"],
        "n_words",
        F.coalesce("spans", F.array().cast("array<struct<start: int, stop: int, item_key: string>>")).alias("spans"),
        F.coalesce("near", F.array().cast("array<string>")).alias("near"),
    )


def covered_words(spans) -> "F.Column":
    """Words inside any of the spans, each counted once."""
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"))))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def step(state, span):
        fresh = F.greatest(span["stop"] - F.greatest(state["end"], span["start"]), F.lit(0))
        return F.struct(F.greatest(state["end"], span["stop"]).alias("end"), (state["n"] + fresh).alias("n"))

    return F.aggregate(ordered, zero, step, lambda s: s["n"])


def digest(matched: DataFrame) -> DataFrame:
    """The columns of the query from what ``find_matches`` gives."""
    ids = lambda keys: F.array_sort(F.array_distinct(F.transform(keys, lambda k: F.regexp_replace(k, ":[0-9a-f]*$", ""))))
    exact = ids(F.transform("spans", lambda s: s["item_key"]))
    counted = matched.select("doc_id", "n_words", covered_words(F.col("spans")).alias("n_hit"), exact.alias("exact"))
    return counted.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("exact").cast("long").alias("n_items"),
        F.sha2(F.array_join("exact", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
