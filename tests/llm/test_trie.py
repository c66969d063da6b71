import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from cases import documents, empty, folder

from slicewise.llm import prefix_trie
from slicewise.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Rows of the query, from every prefix of every rebuilt conversation."""

    def order(row):
        role, text = row[2] or "", row[3] or ""
        return (row[1] is not None, row[1] or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest())

    own = {}
    for row in sorted((r for r in rows if r[0] is not None), key=order):
        own.setdefault(row[0], []).append((row[2] or "", row[3] or ""))
    convs = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        convs[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {k: 0 for k in members}
    leaves, saved = dict(children), dict(children)
    for k in members:
        if k:
            children[k[:-1]] += 1
    for k, of in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(of) - 1) * len(k[-1][1]) if k else 0
    out = []
    for k, of in members.items():
        ends = ",".join(str(c) for c in sorted(of) if convs[c] == k)
        parent = min(members[k[:-1]]) if k else None
        out.append((min(of), len(k), parent, len(of), children[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=str)


def conversations(draw, n):
    """Conversations over few texts, so that prefixes, whole copies and one in another are common; some ids have no rows."""
    rows = []
    for c in range(n):
        if draw.random() < 0.1:
            continue
        for turn in range(draw.integers(1, 9)):
            rows.append((int(c * 7 % 350), turn, ["user", "assistant", None][draw.integers(3)], ["a", "bé", "", None][draw.integers(4)]))
    return rows


HARD = [
    (5, None, "user", "no turn"), (5, None, "user", "no turn"), (5, 3, None, None), (5, 3, "user", "tie"), (5, 3, "user", "eit"),
    (-7, 0, "user", "negative"), (-107, 0, "user", "x"), (2**62 + 1, 0, "a", "large"), (2**62 + 3, 0, "a", "large"),
    (None, 0, "user", "nobody's"), (None, None, None, None), (1201, 0, "user", "😀" * 5000), (1200, 0, "user", "😀" * 5000),
]


@pytest.mark.parametrize("block,ids", [(1, 2), (7, 3), (200_000, 4096)])
def test_against_all_prefixes(spark, monkeypatch, block, ids):
    """Forests of a sequence or two, of several, of whole partitions: merged across blocks and partitions they are the same."""
    monkeypatch.setattr(prefix_trie, "BLOCK_TURNS", block)
    monkeypatch.setattr(prefix_trie, "IDS", ids)
    rows = conversations(np.random.default_rng(block), 300) + HARD
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(prefix_trie.prefix_trie(df)) == brute(rows)


def test_one_hot_conversation(spark, monkeypatch):
    """Most conversations are copies of one, over several partitions, and it begins the others."""
    monkeypatch.setattr(prefix_trie, "IDS", 3)
    rows = [(c * 100, t, "user", f"t{t}") for c in range(60) for t in range(6)]
    rows += [(c * 100, t, "user", f"t{t}" if t < 4 else f"{c}") for c in range(60, 70) for t in range(7)]
    assert got(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_one_long_conversation(spark):
    rows = [(100, t, "user", str(t % 10)) for t in range(3000)] + [(200, t, "user", str(t % 10)) for t in range(2999)]
    assert got(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_query(spark, tmp_path):
    rows = HARD + conversations(np.random.default_rng(0), 40)
    table = pa.table([list(c) for c in zip(*rows)], names=["conv_id", "turn", "role", "text"])
    for clash in ("key", "turns", "part", "n"):
        table = table.append_column(clash, pa.array(["x"] * len(table)))
    assert got(QUERIES["op11_prefix_trie"](spark, folder(tmp_path, documents(base=False), conversations=table))) == brute(rows)


def test_empty_table(spark, tmp_path):
    where = folder(tmp_path, documents(base=False), conversations=empty("conversations"))
    assert QUERIES["op11_prefix_trie"](spark, where).collect() == []


def test_common_prefixes():
    draw = np.random.default_rng(3)
    units = [bytes([k]) * 16 for k in range(2)]
    for _ in range(200):
        a, b = ([units[k] for k in draw.integers(2, size=draw.integers(6))] for _ in range(2))
        want = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert prefix_trie.common(b"".join(a), b"".join(b)) == want
    assert prefix_trie.common(None, b"") == prefix_trie.common(b"", None) == -1
