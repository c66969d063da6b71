import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from cases import documents, empty, folder

from slicewise.llm import lexical_search
from slicewise.llm.queries import QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=20):
    """(item_id, rank, doc_id, score) by the formula, in whole numbers."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c, c.total()) for i, c in counted if c]
    n_docs, n_words = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        ranked = []
        for doc, c, n in counted:
            m = 100 - 25 + (25 * n * n_docs) // n_words
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t in terms(text)
                if t in c
            )
            if score > 0:
                ranked.append((-score, doc is None, doc or 0, doc))
        out += [(item, k, doc, -score) for k, (score, _, _, doc) in enumerate(sorted(ranked, key=lambda r: r[:3])[:top], 1)]
    return sorted(out, key=str)


def got(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


ITEMS = [(9001, None), (9002, ""), (9003, "!?"), (9004, "one ONE one two"), (9005, "ÄÖü b"), (9005, "word7 of3"), (None, "three line")]


def test_query_against_brute_force(spark, tmp_path):
    docs = documents()
    base = documents(base=True)["text"].to_pylist()[:20]
    rows = [*ITEMS, *((k, t) for k, t in enumerate(base))]
    items = pa.table([list(c) for c in zip(*rows)], names=["item_id", "text"])
    items = items.append_column("rank", pa.array(["x"] * len(items))).append_column("score", pa.array(["x"] * len(items)))
    where = folder(tmp_path, docs, benchmark=items)
    want = brute(list(zip(docs["doc_id"].to_pylist(), docs["text"].to_pylist())), rows)
    assert got(QUERIES["op12_lexical_search"](spark, where)) == want


@pytest.mark.parametrize("cells,words", [(1, 1), (50, 30), (1 << 21, 1_000_000)])
def test_small_batches_and_blocks(spark, monkeypatch, cells, words):
    """Ties beyond the last rank, repeated rows and ids, NULL ids; text by text or at once, item by item or at once."""
    monkeypatch.setattr(lexical_search, "CELLS", cells)
    draw = np.random.default_rng(cells)
    said = [" ".join(draw.choice(list("abcdef"), size=draw.integers(0, 12))) for _ in range(60)]
    docs = [(int(k // 2), t) for k, t in enumerate(said)] + [(None, "a b a"), (None, "a b a"), (7, None), (8, ""), (3, "a b a")]
    items = [(k, " ".join(draw.choice(list("abcdefgh"), size=draw.integers(0, 9)))) for k in range(12)]
    df, asked = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = lexical_search.search(df.repartition(4), asked, top=5, block_words=words)
    assert got(found) == brute(docs, items, 5)


def test_the_best_stay_when_rows_are_thrown_out():
    draw = np.random.default_rng(1)
    best = lexical_search.Best(3, 4)
    best.room = 10
    rows = np.stack([draw.integers(3, size=300), draw.permutation(300), draw.integers(1, 9, size=300)])
    for k in range(0, 300, 7):
        best.add(*rows[:, k : k + 7])
    want = sorted((i, -s, d) for i, d, s in rows.T.tolist())
    kept = [r for i in range(3) for r in [x for x in want if x[0] == i][:4]]
    assert [(i, -s, d) for i, d, s in best.rows().T.tolist()] == kept


def test_sums_beyond_exact_doubles():
    block = lexical_search.block_of([["a"] * 9, ["b", "a"]])
    weight = np.array([(1 << 40) + 1, 3], dtype=np.int64)
    total = lexical_search.scores(block, weight, [np.array([0, 0, 1]), np.array([1])], np.array([75, 75]))
    a, b = ((1 << 40) + 1) * (2_000_000_000 // 2900), 3 * (1_000_000_000 // 1900)
    assert total.tolist() == [[9 * a, a + b], [0, b]]


def test_empty_tables(spark, tmp_path):
    assert not QUERIES["op12_lexical_search"](spark, folder(tmp_path, documents(base=False), benchmark=empty("benchmark"))).collect()
    assert not QUERIES["op12_lexical_search"](spark, folder(tmp_path, empty("documents"))).collect()
