import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from cases import HARD, documents, empty, folder
from hypothesis import given, settings, strategies as st

from slicewise.llm import simhash_dedup
from slicewise.llm.components import components
from slicewise.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(nodes, linked):
    """Smallest node of each component; ``linked(i, j)``."""
    root = list(range(len(nodes)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(nodes)):
        for j in linked(i):
            root[find(int(j))] = find(i)
    groups = defaultdict(list)
    for i in range(len(nodes)):
        groups[find(i)].append(nodes[i])
    return {n: min(g) for g in groups.values() for n in g}


def links_of(fps):
    return lambda i: np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= simhash_dedup.MAX_BITS)


def test_query_against_brute_force(spark, tmp_path):
    table = documents()
    got = QUERIES["op3_simhash_dedup"](spark, folder(tmp_path, table)).collect()
    ids, fps = table["doc_id"].to_pylist(), np.array([brute_fingerprint(t) for t in table["text"].to_pylist()], dtype=np.uint64)
    roots = brute_roots(ids, links_of(fps))
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{int(f):016x}", roots[i]) for i, f in zip(ids, fps)}
    assert len(got) == len(ids)


def test_empty_table(spark, tmp_path):
    assert QUERIES["op3_simhash_dedup"](spark, folder(tmp_path, empty("documents"))).collect() == []


def test_repeated_rows_and_null_ids(spark):
    rows = [(5, "a b c"), (5, "a b c"), (None, "a b c"), (7, None), (3, ""), (None, "quite another text")]
    got = simhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in got) == sorted(
        [("5", "5"), ("5", "5"), ("None", "5"), ("7", "3"), ("3", "3"), ("None", "None")]
    )


def near(base, draw, count):
    """Fingerprints with up to four bits of ``base`` changed."""
    out = {base}
    while len(out) < count:
        flip = 0
        for bit in draw.choice(64, size=draw.integers(1, 5), replace=False):
            flip |= 1 << int(bit)
        out.add(base ^ flip)
    return sorted(out)


def test_no_link_escapes_the_index(spark, monkeypatch):
    """A dense group in buckets of more than a block, chains of groups, and fingerprints far from all."""
    monkeypatch.setattr(simhash_dedup, "BLOCK", 50)
    draw = np.random.default_rng(1)
    fps = set()
    for _ in range(4):
        base = int(draw.integers(0, 1 << 63))
        fps |= set(near(base, draw, 300))
        for step in range(1, 6):
            fps.add(base ^ ((1 << 4 * step) - 1))  # a chain of four bits a step
    fps |= {int(x) for x in draw.integers(0, 1 << 63, size=500)}
    fps = np.array(sorted(fps), dtype=np.uint64)
    frame = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    got = {r.node: r.root for r in components(simhash_dedup.fingerprint_links(frame)).collect()}
    want = brute_roots(fps.view(np.int64).tolist(), links_of(fps))
    assert {n: got.get(n, n) for n in want} == want


@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=4))
@settings(max_examples=300)
def test_every_link_shares_a_key_and_passes_its_chain(a, bits):
    b = a ^ sum(1 << x for x in bits)
    found = False
    for no, mask in enumerate(simhash_dedup.index_masks()):
        if a & mask == b & mask:
            hit = simhash_dedup.linked(np.array([a], dtype=np.uint64), np.array([b], dtype=np.uint64), simhash_dedup.chain_masks(no // 5))
            found = found or bool(hit[0])
    assert found


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(1, 2), (2, 1), (2, 3), (9, 8)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 60)]])
def test_components(spark, edges):
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = sorted({n for e in edges for n in e})
    at = {n: i for i, n in enumerate(nodes)}
    want = brute_roots(nodes, lambda i: [at[y] for x, y in edges if at[x] == i] + [at[x] for x, y in edges if at[y] == i])
    assert got == {n: r for n, r in want.items() if n != r}


def test_hard_texts_have_the_right_fingerprint():
    for _, text, _, _ in HARD:
        assert simhash_dedup.fingerprint(text) == brute_fingerprint(text)
