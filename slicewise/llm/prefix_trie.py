"""The prefix trie of conversations, by union-find over sorted neighbours.

A conversation is the sequence of its turns' digests. The sequences are sorted over all partitions; each edge between
neighbours is as deep as their longest common prefix (LCP). A partition takes its edges in descending depth: every edge
joins two components of a union-find, and the join is the branching node at that depth. What lies between two branching
nodes is a chain of nodes with the same members. A node that a neighbouring block may share (a prefix of the block's first
or last sequence no deeper than the LCP across that boundary) stays open: of a block's forest only these two paths are
left, with their sums, and equal open nodes of all blocks are merged. All other nodes are complete where they are found.

Texts never move: only digests, lengths and ids are shuffled. A conversation's digests (about 40 bytes a turn) are one
record; copies of one sequence are spread over tasks, packed, and only then read in order for the digest of their ids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import runs_of, written

UNIT = 16  # bytes of a turn's digest
HEADS = 5  # a rebuilt conversation borrows fewer turns than six
IDS = 4096  # ids of a run
BLOCK_TURNS = 200_000  # turns of the sequences of one forest, if it has more than one sequence
EMPTY = hashlib.sha256().hexdigest()


def rebuilt(rows: DataFrame) -> DataFrame:
    """(conv_id, key, chars): every conversation of ``rows`` (conv_id, turn, role, text) with its borrowed first turns.

    Conversation c begins with the first h original turns of conversation c - c % 100, h = crc32(decimal c) % 6, and goes on
    with its own turns after its first h. ``key`` holds the digests of role and text, turn by turn, ``chars`` the code points
    of the texts. Turns are ordered by ``turn``, NULL first, ties by the digest; NULL roles and texts are empty, repeated rows
    are turns of their own. Rows without a conv_id belong to no conversation.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    digest = F.substring(F.sha2(F.concat(F.char_length(role), F.lit(":"), role, text).cast("binary"), 256), 1, 2 * UNIT)
    turn = F.struct(F.col("turn").cast("long").alias("turn"), digest.alias("digest"), F.char_length(text).cast("long").alias("chars"))
    told = rows.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn")).filter("conv_id IS NOT NULL")
    own = told.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    own = written(own, "turns")
    heads = own.filter("conv_id % 100 = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, HEADS).alias("head"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(6)).cast("int")
    met = own.join(heads, F.expr("conv_id - conv_id % 100") == F.col("base"), "left")
    borrowed = F.when(F.col("head").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("head", F.lit(1), h))
    rest = F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1)))
    sequence = met.select("conv_id", F.concat(borrowed, rest).alias("turns"))
    key = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), ""))
    return sequence.select("conv_id", key.alias("key"), F.transform("turns", lambda t: t["chars"]).alias("chars"))


def sorted_runs(sequences: DataFrame) -> DataFrame:
    """(part, no, key, chars, conv_id, n, ids): the sequences in order, equal ones packed to rows of ``IDS`` ids at most.

    Ranges are cut by key and conv_id, so copies of one sequence need not share a partition.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, no = TaskContext.get().partitionId(), 0

        def row(key, chars, ids) -> pa.RecordBatch:
            nonlocal no
            no += 1
            names = ["part", "no", "key", "chars", "conv_id", "n", "ids"]
            out = [part, no, key, chars, ids[0], len(ids), ",".join(map(str, ids))]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(out, kinds)], names=names)

        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.string()]
        waiting: list[pa.RecordBatch] = []
        for key, records in runs_of(batches, "key", ["conv_id", "chars"]):
            ids, chars = [], []
            for conv_id, chars in records:
                ids.append(conv_id)
                if len(ids) == IDS:
                    waiting.append(row(key, chars, ids))
                    ids = []
            if ids:
                waiting.append(row(key, chars, ids))
            if len(waiting) >= 1000:
                yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
                waiting = []
        if waiting:
            yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]

    dealt = sequences.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    return dealt.mapInArrow(each, "part long, no long, key binary, chars array<long>, conv_id long, n long, ids string")


def common(a: bytes | None, b: bytes | None) -> int:
    """Turns of the longest common prefix of two keys; -1 if one is missing."""
    if a is None or b is None:
        return -1
    low, high = 0, min(len(a), len(b)) // UNIT
    if a[: high * UNIT] == b[: high * UNIT]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low * UNIT : middle * UNIT] == b[low * UNIT : middle * UNIT]:
            low = middle
        else:
            high = middle
    return low


@dataclass
class Node:
    """A node, or the top of a component that is not a node yet: sums over its members in this forest."""

    depth: int
    low: int  # first and last run
    high: int
    conv_id: int
    n_convs: int
    n_leaves: int
    n_children: int = 0
    saved: int = 0
    ended: list[int] = field(default_factory=list)  # runs that end here
    below: list[Node] = field(default_factory=list)  # children, until the node is made
    parent: Node | None = None


def forest(keys: list[bytes], chars: list[list[int]], conv_ids: list[int], counts: list[int], left: int, right: int) -> list[Node]:
    """All nodes of some sorted sequences, children first, the root last.

    ``left`` and ``right`` are the LCPs with the sequences before and after, -1 where there is none. A node shared with the
    sequence before is counted as a child, and its text as once not saved, over there.
    """
    last = len(keys) - 1
    edges = [common(a, b) for a, b in zip(keys, keys[1:])]
    tops, made = [], []
    for i, (key, follows) in enumerate(zip(keys, [*edges, right])):
        depth = len(key) // UNIT
        # Sequences that go on from here, and copies, come right after.
        tops.append(Node(depth, i, i, conv_ids[i], counts[i], int(follows < depth), ended=[i]))

    def make(top: Node) -> Node:
        """The top becomes a node; its parent, one turn up the chain, is the new top."""
        new = top.low > 0 or top.depth > left
        if top.depth:
            top.saved += (top.n_convs - new) * chars[top.low][top.depth - 1]
        for child in top.below:
            child.parent = top
        top.below = []
        made.append(top)
        return Node(top.depth - 1, top.low, top.high, top.conv_id, top.n_convs, top.n_leaves, int(new), top.saved, below=[top])

    def lift(at: int, depth: int) -> Node:
        while tops[at].depth > depth:
            tops[at] = make(tops[at])
        return tops[at]

    roots = list(range(len(keys)))

    def find(i: int) -> int:
        while roots[i] != i:
            roots[i] = roots[roots[i]]
            i = roots[i]
        return i

    for i in sorted(range(last), key=lambda i: -edges[i]):
        a, b = find(i), find(i + 1)
        one, two = lift(a, edges[i]), lift(b, edges[i])
        one.high, one.conv_id = two.high, min(one.conv_id, two.conv_id)
        one.n_convs += two.n_convs
        one.n_leaves += two.n_leaves
        one.n_children += two.n_children
        one.saved += two.saved
        one.ended += two.ended
        one.below += two.below
        roots[b] = a
    lift(find(0), -1)
    return made


def path(key: bytes, depth: int) -> list[bytes]:
    """Names of the prefixes of 0 to ``depth`` turns."""
    names = [hashlib.sha256(b"").digest()[:UNIT]]
    for t in range(depth):
        names.append(hashlib.sha256(names[-1] + key[t * UNIT : (t + 1) * UNIT]).digest()[:UNIT])
    return names


COLUMNS = {
    "node": pa.binary(), "parent": pa.binary(), "conv_id": pa.int64(), "depth": pa.int64(), "parent_conv_id": pa.int64(),
    "n_convs": pa.int64(), "n_children": pa.int64(), "n_leaves": pa.int64(), "saved_tokens": pa.int64(),
    "ends_sha256": pa.string(), "part": pa.int64(), "no": pa.int64(), "ids": pa.string(),
}
SUMS = ("n_convs", "n_children", "n_leaves", "saved_tokens")


def contracted(runs: list[tuple], part: int, left: int, right: int) -> Iterator[tuple]:
    """Rows of ``COLUMNS`` from the forest of one block of runs (no, key, chars, conv_id, n, ids).

    Complete nodes have no name in ``node``; if their parent is open, its name stands in ``parent``. Open nodes have names and
    the sums of this block, and a row for each run of ids that ends there.
    """
    no, keys, chars, conv_ids, counts, ids = (list(x) for x in zip(*runs))
    before, after = path(keys[0], left), path(keys[-1], right)

    def name(node: Node | None) -> bytes | None:
        if node is not None and node.low == 0 and node.depth <= left:
            return before[node.depth]
        if node is not None and node.high == len(runs) - 1 and node.depth <= right:
            return after[node.depth]
        return None

    for node in forest(keys, chars, conv_ids, counts, left, right):
        mine, over = name(node), name(node.parent)
        digest = None
        if mine is None:
            digest = hashlib.sha256(",".join(ids[i] for i in node.ended).encode()).hexdigest()
        else:
            for i in node.ended:
                yield (mine, *[None] * 9, part, no[i], ids[i])
        known = node.parent.conv_id if node.parent is not None and over is None else None
        yield (mine, over, node.conv_id, node.depth, known, node.n_convs, node.n_children, node.n_leaves, node.saved, digest, *[None] * 3)


def block_forests(runs: DataFrame) -> DataFrame:
    """Rows of ``COLUMNS`` of all blocks of ``sorted_runs``. A partition's neighbours are known by its boundary keys."""
    ends = runs.groupBy("part").agg(F.min_by("key", "no").alias("first"), F.max_by("key", "no").alias("last"))
    order = Window.orderBy("part")  # one row a partition
    around = ends.select(F.col("part").alias("of_part"), F.lag("last").over(order).alias("before"), F.lead("first").over(order).alias("after"))
    met = runs.join(around, F.col("part") == F.col("of_part")).drop("of_part")

    def blocks(records: Iterator[tuple], before: bytes | None, after: bytes | None) -> Iterator[tuple[list, int, int]]:
        waiting, turns = [], 0
        for record in records:
            size = len(record[1]) // UNIT + 1
            if waiting and turns + size > BLOCK_TURNS:
                yield waiting, common(before, waiting[0][1]), common(waiting[-1][1], record[1])
                before, waiting, turns = waiting[-1][1], [], 0
            waiting.append(record)
            turns += size
        yield waiting, common(before, waiting[0][1]), common(waiting[-1][1], after)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, records in runs_of(batches, "part", ["before", "after", "no", "key", "chars", "conv_id", "n", "ids"]):
            head = next(records)
            for block in blocks(chain([head[2:]], (r[2:] for r in records)), *head[:2]):
                columns = zip(*contracted(block[0], part, *block[1:]))
                arrays = [pa.array(c, t) for c, t in zip(columns, COLUMNS.values())]
                yield from pa.Table.from_arrays(arrays, names=list(COLUMNS)).to_batches(10_000)

    schema = ", ".join(f"{n} {({'int64': 'long'}).get(str(t), t)}" for n, t in COLUMNS.items())
    return met.repartition("part").sortWithinPartitions("part", "no").mapInArrow(each, schema)


def ends_of(chunks: DataFrame) -> DataFrame:
    """(named, ends_sha256): SHA-256 over the ids of each open node, read in order, chunk by chunk."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for node, records in runs_of(batches, "node", ["ids"]):
            digest = hashlib.sha256(next(records)[0].encode())
            for (ids,) in records:
                digest.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()])], names=["named", "ends_sha256"])

    sorted_chunks = chunks.repartition("node").sortWithinPartitions("node", "part", "no")
    return sorted_chunks.select("node", "ids").mapInArrow(each, "named binary, ends_sha256 string")


def prefix_trie(rows: DataFrame) -> DataFrame:
    """All nodes of the trie of the rebuilt conversations of ``rows`` (conv_id, turn, role, text), see ``rebuilt``.

    A node is a distinct sequence of first turns; the root is the empty one. Per node: conv_id (its smallest member), depth,
    parent_conv_id (NULL for the root), n_convs, n_children, n_leaves, saved_tokens and ends_sha256, of the ids of the members
    that end there, ascending. ``conv_id`` and ``depth`` together tell nodes apart. No conversations give no nodes.
    """
    runs = written(sorted_runs(written(rebuilt(rows), "sequences")), "runs")
    found = written(block_forests(runs), "forests")
    columns = ["conv_id", "depth", "parent_conv_id", *SUMS, "ends_sha256"]
    complete = found.filter("node IS NULL")
    partial = found.filter("node IS NOT NULL AND ids IS NULL").groupBy("node").agg(
        F.first("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"),
        *[F.sum(c).alias(c) for c in SUMS],
    )
    ends = ends_of(found.filter("ids IS NOT NULL"))
    merged = written(partial.join(ends, F.col("node") == F.col("named"), "left").drop("named"), "open-nodes")
    names = merged.select(F.col("node").alias("of_parent"), F.col("conv_id").alias("of_conv"))
    merged = merged.select("parent", "conv_id", "depth", F.lit(None).cast("long").alias("parent_conv_id"), *SUMS, F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))
    under = complete.filter("parent IS NOT NULL").select("parent", *columns).unionAll(merged)
    named = under.join(names, F.col("parent") == F.col("of_parent"), "left").withColumn("parent_conv_id", F.col("of_conv"))
    return complete.filter("parent IS NULL").select(*columns).unionAll(named.select(*columns))
