"""Ranked lexical search by an Aho-Corasick scan of the documents.

The terms of all test items, each between two guards, make one automaton, which is broadcast. A guard stands for whatever
separates terms, so the automaton finds whole terms only. It runs over every whole text twice, and no index of the
documents is kept: the first scan counts in how many documents each term stands, the second one turns the matches of a
text into tf, maps the terms to the items that ask for them, and keeps the best documents of each item in every task.
Items come in blocks of a bounded number of words; every block is two more scans.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window, functions as F

from .common import written

TOP = 20
BLOCK_WORDS = 500_000  # words of the items of one block; what is broadcast grows with it
CELLS = 1 << 21  # document x item sums, and matches times items, held at once
SALTS = 256
LAST_ID = (1 << 63) - 1

# Digits, letters and every byte of a character beyond ASCII make terms; A-Z are lower-cased, the rest separates.
FOLD = bytes(
    c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256)
)


class Block(NamedTuple):
    """Items as an automaton of their terms and, per term, the items that ask for it and how often."""

    automaton: ahocorasick.Automaton
    n_terms: int
    n_items: int
    first: np.ndarray  # postings of term t: first[t] to first[t + 1]
    item: np.ndarray
    times: np.ndarray


def item_terms(text: str | None) -> list[str]:
    """Maximal runs of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]``, A-Z lower-cased; NULL has none."""
    return [t.decode() for t in (text or "").encode().translate(FOLD).split()]


def block_of(items: list[list[str]]) -> Block:
    """The automaton and the postings of some items, given as lists of their terms."""
    places: dict[str, list[tuple[int, int]]] = {}
    for no, terms in enumerate(items):
        for term, n in Counter(terms).items():
            places.setdefault(term, []).append((no, n))
    automaton = ahocorasick.Automaton()
    for k, term in enumerate(places):
        automaton.add_word(f" {term} ", k)
    automaton.make_automaton()
    flat = np.array([x for p in places.values() for x in p], dtype=np.int64).reshape(-1, 2)
    first = np.cumsum([0, *map(len, places.values())])
    return Block(automaton, len(places), len(items), first, flat[:, 0], flat[:, 1])


def scan(block: Block, body: bytes | None) -> tuple[int, np.ndarray]:
    """The number of terms of a text, and one entry for each place where the automaton finds a term of the block."""
    said = (body or b"").translate(FOLD)
    found = map(itemgetter(1), block.automaton.iter(f" {said.decode()} "))
    return len(said.split()), np.fromiter(found, dtype=np.int64)


def texts_of(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID)).alias("doc"), F.col(text).cast("binary").alias("body")
    )


def statistics(texts: DataFrame, block: Block) -> tuple[int, int, np.ndarray]:
    """Documents with a term, their terms, and for each term of the block how many documents hold it.

    Each task returns its sums, one row a term; one row a term comes to the driver.
    """
    # A plain tuple: executors need not have the class.
    shared = texts.sparkSession.sparkContext.broadcast(tuple(block))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = Block(*shared.value)
        sums = np.zeros(asked.n_terms + 2, dtype=np.int64)
        for batch in batches:
            for body in batch.column("body"):
                n, found = scan(asked, body.as_py())
                sums[np.unique(found)] += 1
                sums[-2:] += n > 0, n
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some])], names=["term", "n"])

    counted = texts.mapInArrow(each, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    sums = np.zeros(block.n_terms + 2, dtype=np.int64)
    for row in counted.toLocalIterator():
        sums[row.term] = row.n
    return int(sums[-2]), int(sums[-1]), sums[:-2]


def weights(n_docs: int, holding: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in holding.tolist()], dtype=np.int64)


class Best:
    """The best ``top`` (item, doc, score) of each item so far; a score below an item's last one is not kept at all."""

    def __init__(self, n_items: int, top: int):
        self.top, self.least = top, np.ones(n_items, dtype=np.int64)
        self.parts: list[np.ndarray] = []
        self.size, self.room = 0, max(50_000, 4 * top * n_items)

    def add(self, item: np.ndarray, doc: np.ndarray, score: np.ndarray) -> None:
        good = score >= self.least[item]
        self.parts.append(np.stack([item[good], doc[good], score[good]]))
        self.size += int(good.sum())
        if self.size > self.room:
            self.rows()

    def rows(self) -> np.ndarray:
        rows = np.concatenate([*self.parts, np.empty((3, 0), dtype=np.int64)], axis=1)
        rows = rows[:, np.lexsort((rows[1], -rows[2], rows[0]))]
        new = np.flatnonzero(np.append(True, rows[0, 1:] != rows[0, :-1])[: rows.shape[1]])
        rank = np.arange(rows.shape[1]) - np.repeat(new, np.diff(np.append(new, rows.shape[1])))
        last = rank == self.top - 1
        self.least[rows[0, last]] = rows[2, last]
        rows = rows[:, rank < self.top]
        self.parts, self.size = [rows], rows.shape[1]
        return rows


def scores(block: Block, weight: np.ndarray, found: list[np.ndarray], m: np.ndarray) -> np.ndarray:
    """(document, item) sums of the scores of some documents, given the terms found in each."""
    of = np.repeat(np.arange(len(found)), [len(f) for f in found])
    pairs, tf = np.unique(of * block.n_terms + np.concatenate(found), return_counts=True)
    doc, term = np.divmod(pairs, max(1, block.n_terms))
    value = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
    asked = block.first[term + 1] - block.first[term]
    total = np.zeros(len(found) * block.n_items, dtype=np.int64)
    cuts = np.searchsorted(np.cumsum(asked), np.arange(CELLS, int(asked.sum()) + CELLS, CELLS), side="left") + 1
    for a, b in zip([0, *cuts[:-1]], cuts):
        n = asked[a:b]
        post = np.repeat(block.first[term[a:b]] - np.cumsum(n) + n, n) + np.arange(n.sum())
        cell = np.repeat(doc[a:b], n) * block.n_items + block.item[post]
        gain = np.repeat(value[a:b], n) * block.times[post]
        # Sums in doubles are exact below 2**53, so both halves are.
        for shift, half in ((0, gain & ((1 << 26) - 1)), (26, gain >> 26)):
            total += np.bincount(cell, half, minlength=len(total)).astype(np.int64) << shift
    return total.reshape(len(found), block.n_items)


def best_documents(texts: DataFrame, block: Block, top: int = TOP) -> DataFrame:
    """(item_no, rank, doc, score): the best documents of each item of a block.

    A task hands on at most ``top`` documents an item. These are ranked in two steps, the first of which deals the rows of
    an item out to ``SALTS`` groups.
    """
    n_docs, n_words, holding = statistics(texts, block)
    shared = texts.sparkSession.sparkContext.broadcast((tuple(block), weights(n_docs, holding)))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weight = Block(*shared.value[0]), shared.value[1]
        best = Best(asked.n_items, top)
        docs, found, sizes, waiting = [], [], [], 0

        def judge() -> None:
            # In whole numbers of any size: 25 * n * N may pass 64 bits.
            m = np.array([75 + 25 * n * n_docs // n_words for n in sizes], dtype=np.int64)
            total = scores(asked, weight, found, m)
            doc, item = np.nonzero(total >= best.least)
            best.add(item, np.array(docs, dtype=np.int64)[doc], total[doc, item])
            for kept in (docs, found, sizes):
                kept.clear()

        for batch in batches:
            for doc, body in zip(batch.column("doc").to_pylist(), batch.column("body")):
                n, terms = scan(asked, body.as_py())
                if not len(terms):
                    continue
                docs.append(doc)
                found.append(terms)
                sizes.append(n)
                waiting += len(terms)
                if waiting >= CELLS or len(docs) * asked.n_items >= CELLS:
                    judge()
                    waiting = 0
        if docs:
            judge()
        item, doc, score = best.rows()
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(doc), pa.array(score)], names=["item_no", "doc", "score"])

    kept = texts.mapInArrow(each, "item_no long, doc long, score long")
    kept = kept.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(SALTS)))
    for group in (["item_no", "salt"], ["item_no"]):
        order = Window.partitionBy(*group).orderBy(F.desc("score"), "doc")
        kept = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return kept.select("item_no", "rank", "doc", "score")


def item_blocks(items: DataFrame, block_words: int) -> Iterator[list[tuple[Row, list[str]]]]:
    """Items with terms, in lists of ``block_words`` words at most; an item longer than that is a list of its own."""
    block, size = [], 0
    for row in items.toLocalIterator():
        terms = item_terms(row.text)
        if block and size + len(terms) > block_words:
            yield block
            block, size = [], 0
        if terms:
            block.append((row, terms))
            size += len(terms)
    if block:
        yield block


def search(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", top: int = TOP,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): for each row of ``items`` its ``top`` documents with a score above 0.

    Equal scores are ordered by id, NULL ids last. Rows count one by one: repeated documents are ranked each, items that
    share an id have a ranking each. NULL and empty texts have no terms: such documents are never found and count in no
    statistic, such items return nothing. No documents, or no items, give no rows. Only ids and texts of ``items`` come to
    the driver, ``block_words`` words at a time.
    """
    spark, texts = docs.sparkSession, texts_of(docs, doc_id, text)
    asked = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    kind = asked.schema["item_id"].dataType.simpleString()
    found = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for rows in item_blocks(asked, block_words):
        best = written(best_documents(texts, block_of([terms for _, terms in rows]), top), "best")
        names = spark.createDataFrame([(no, row.item_id) for no, (row, _) in enumerate(rows)], f"no long, item_id {kind}")
        named = best.join(names, F.col("item_no") == F.col("no"))
        found = found.unionAll(named.select("item_id", "rank", F.expr(f"nullif(doc, {LAST_ID})").alias("doc_id"), "score"))
    return found
