"""Profiles asked for by control rows, all requests of a table answered together.

The bounds of all requests of a column, sorted, cut its values into segments: a bound is one, so is what lies between two
neighbours. An expression over the column's own bounds says in which segment a cell lies; that is one row a cell, however many
requests there are, and no join. Cells are added up by column and segment, and a request, which is a run of segments, is
put together from these sums. Only requests with few values are then counted by value, from their own segments alone.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, functions as F

from ..functions.lanes import DECIMAL, lane_map, lane_type, lanes_in, unpivot_lanes
from ..functions.ranges import range_end, range_label, range_start
from ..functions.slices import quoted, ref
from ..layout import PROFILE_SCHEMA, fit
from ..sources.control import local_table, parse_requests
from .profiles import GATE, by_text, ends_of, gate_groups, marked, one_zero, union_all, used_slots

KEY = "request_no"
# The segment of NULL; bounded requests do not hold it.
EMPTY = -1
# Up to this many bounds a segment is a sum of comparisons, which is generated as code; beyond it is found in two steps, by
# about the square root of their number.
FEW = 16
Wanted = dict[int, Row]


def read_requests(df: DataFrame, requests: DataFrame, ignore_unknown: bool) -> Wanted:
    """The requests with readable bounds, numbered. A column that the table lacks is an error unless ignored."""
    rows = (
        parse_requests(requests)
        .filter(F.col("request_mode") != "rejected")
        .select("column_name", "additional_info", "request_mode", "low", "high", "width")
        .collect()
    )
    unknown = sorted({r["column_name"] for r in rows} - set(df.columns))
    if unknown and not ignore_unknown:
        raise ValueError(f"requests name columns that the table lacks: {', '.join(unknown)}")
    rows = [r for r in rows if r["column_name"] not in unknown]
    return dict(enumerate(sorted(set(rows), key=lambda r: (r["column_name"], r["additional_info"] or ""))))


def _typed(bound: str, lane: str) -> object | None:
    """A bound, a whole number, as what its lane compares with; on text it stays text. None: beyond the lane's type."""
    if lane == "text":
        return bound
    number = int(bound)
    if lane.startswith(DECIMAL):
        return number if number < 10**38 else None
    if lane == "whole":
        return number if number < 1 << 63 else None
    return float(Decimal(bound)) if number < 1 << 1024 else math.inf


def _sql_type(lane: str) -> str:
    if lane.startswith(DECIMAL):
        return "decimal(38,0)"
    return "double" if lane == "single" else lane_type(lane)


class Cuts:
    """The sorted bounds of a column's requests, as typed values and as the texts they were given as."""

    def __init__(self, name: str, lane: str, wanted: Wanted):
        self.name, self.lane, self.requests = name, lane, {no: r for no, r in wanted.items() if r["column_name"] == name}
        given = {_typed(r[end], lane): r[end] for r in self.requests.values() if r["low"] is not None for end in ("low", "high")}
        self.bounds = sorted(b for b in given if b is not None)
        self.texts = [given[b] for b in self.bounds]

    def run(self, no: int) -> tuple[int, int]:
        """The first and the last segment of a request; a first one beyond the last for bounds that no value can meet."""
        r = self.requests[no]
        if r["low"] is None:
            return EMPTY, 2 * len(self.bounds)
        low, high = (_typed(r[end], self.lane) for end in ("low", "high"))
        if low is None or high is None:
            return 0, EMPTY
        return 2 * bisect_left(self.bounds, low) + 1, 2 * bisect_left(self.bounds, high) + 1

    def _array(self, stride: int = 1) -> str:
        """Every so many of the bounds as one constant; they are digits, so no comma is part of one."""
        return f"CAST(split('{','.join(self.texts[::stride])}', ',') AS array<{_sql_type(self.lane)}>)"

    def steps(self, at: str) -> list[dict[str, str]]:
        """Expressions to add to the table one after the other; the last is the segment, ``at`` is a prefix for their names.

        A segment is the number of bounds below the value plus the number of those not above it.
        """
        value, kind, n = quoted(self.name), _sql_type(self.lane), len(self.bounds)
        if n == 0:
            return [{f"{at}segment": "0"}]
        if n <= FEW:
            ends = [f"CAST('{t}' AS {kind})" for t in self.texts]
            steps = " + ".join(f"CAST({value} > {e} AS INT) + CAST({value} >= {e} AS INT)" for e in ends)
            return [{f"{at}segment": f"coalesce({steps}, {EMPTY})"}]
        stride = math.isqrt(n - 1) + 1
        coarse = f"size(filter({self._array(stride)}, b -> b <= {value}))"
        block = f"slice({self._array()}, ({at}block - 1) * {stride} + 1, {stride})"
        reached = f"IF({at}block = 0, 0, ({at}block - 1) * {stride} + size(filter({block}, b -> b <= {value})))"
        equal = f"IF({at}reached > 0, CAST(element_at({self._array()}, greatest({at}reached, 1)) = {value} AS INT), 0)"
        segment = f"IF({value} IS NULL, {EMPTY}, 2 * {at}reached - {equal})"
        return [{f"{at}block": coarse}, {f"{at}reached": reached}, {f"{at}segment": segment}]


def _cells(df: DataFrame, cuts: list[Cuts], only: set[int] | None = None) -> DataFrame:
    """``column_no`` (the place in ``cuts``), the lanes and ``segment`` of each cell: one row a cell.

    With ``only``, cells of segments that none of these requests holds are left out.
    """
    columns, segments, frame = [c.name for c in cuts], [], df.select(*[ref(c.name) for c in cuts])
    inside = []
    for i, cut in enumerate(cuts):
        for step in cut.steps(f"__{i}_"):
            frame = frame.withColumns({name: F.expr(sql) for name, sql in step.items()})
        segments.append(f"`__{i}_segment`")
        if only is not None:
            held = [0] * (2 * len(cut.bounds) + 3)
            for no in only & cut.requests.keys():
                low, high = cut.run(no)
                if low <= high:
                    held[low - EMPTY] += 1
                    held[high - EMPTY + 1] -= 1
            depth, flags = 0, []
            for step in held[:-1]:
                depth += step
                flags.append("1" if depth else "0")
            inside.append(f"get(split('{','.join(flags)}', ','), `__{i}_segment` + 1) = '1'")
    beside = {"segment": segments} | ({"inside": inside} if only is not None else {})
    rows = unpivot_lanes(frame, columns, beside=beside)
    rows = rows if only is None else rows.filter("inside").drop("inside")
    lanes = lanes_in(df, columns)
    return rows.select("column_no", "segment", *[one_zero(lane, lane).alias(lane) for lane in lanes])


class Sums:
    """Sums over any run of segments of a column: rows by prefix sums, marks and extremes from runs of doubling length."""

    def __init__(self, rows: list[dict]):
        self.rows = sorted(rows, key=lambda r: r["segment"])
        self.places = [r["segment"] for r in self.rows]
        self.counts = [0]
        for r in self.rows:
            self.counts.append(self.counts[-1] + r["n"])
        self.levels = [self.rows]
        while len(self.levels[-1]) > 1 << (len(self.levels) - 1):
            above, reach = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append([self._both(a, b) for a, b in zip(above, above[reach:])])

    @staticmethod
    def _both(a: dict, b: dict) -> dict:
        """Marks and extremes of two rows. NaN is above all numbers, as in an ordered comparison of Spark."""
        out = {}
        for name, x in a.items():
            y = b[name]
            if name.startswith("slots"):
                out[name] = x | y
            elif x is None or y is None:
                out[name] = x if y is None else y
            else:
                out[name] = (min if name.startswith("min_") else max)(x, y, key=lambda v: (v != v, v))
        return out

    def of(self, low: int, high: int) -> dict | None:
        """The sums of the segments ``low`` to ``high``; None if no cell lies in them."""
        a, b = bisect_left(self.places, low), bisect_right(self.places, high)
        if a >= b:
            return None
        level = (b - a).bit_length() - 1
        both = self._both(self.levels[level][a], self.levels[level][b - (1 << level)])
        return both | {"n": self.counts[b] - self.counts[a]}


def _column_rows(found: DataFrame, lanes: list[str]) -> DataFrame:
    """Whole-column rows from ``n`` and the extremes of lanes."""
    ends = {}
    for end in ("min", "max"):
        ends[f"{end}_value"] = F.coalesce(*[F.col(f"{end}_{lane}").cast("string") for lane in lanes])
        numbers = [F.col(f"{end}_{lane}").cast("double") for lane in lanes if lane != "text"]
        ends[f"{end}_number"] = F.coalesce(*numbers, F.lit(None).cast("double"))
    return found.withColumns({"stat_kind": F.lit("column"), "group_count": F.col("n")} | ends)


def _runs(df: DataFrame, cuts: list[Cuts], numbers: set[int]) -> DataFrame:
    """``column_no``, first and last segment, key and width of some requests."""
    fields = [("of_column", pa.int32()), ("first", pa.int32()), ("last", pa.int32()), (KEY, pa.int32()), ("of_width", pa.int32())]
    rows = [
        {"of_column": i, "first": cut.run(no)[0], "last": cut.run(no)[1], KEY: no, "of_width": r["width"]}
        for i, cut in enumerate(cuts)
        for no, r in cut.requests.items()
        if no in numbers
    ]
    return local_table(df.sparkSession, pa.Table.from_pylist(rows, schema=pa.schema(fields)))


def _within(sums: DataFrame, runs: DataFrame, *more: Column) -> DataFrame:
    """Sums by segment beside every request that holds the segment."""
    held = (F.col("column_no") == F.col("of_column")) & F.col("segment").between(F.col("first"), F.col("last"))
    for condition in more:
        held = held & condition
    return sums.join(runs, held)


def _profiles(df: DataFrame, wanted: Wanted, gate: int) -> list[DataFrame]:
    """Gated rows per request, decided as in ``gated_profile``: sums by segment come to the driver, then values of the few."""
    named = {r["column_name"] for r in wanted.values()}
    columns, kind = [c for c in df.columns if c in named], lane_map(df, list(named))
    cuts, frames, open_ = {c: Cuts(c, kind[c], wanted) for c in columns}, [], set()
    for part in by_text(df, columns):
        own, lanes = [cuts[c] for c in part], lanes_in(df, part)
        ends = [end for lane in lanes for end in ends_of(lane)]
        cells = _cells(df, own).groupBy("column_no", "segment")
        fetched = cells.agg(F.count("*").alias("n"), *used_slots(lanes, gate, "slots"), *ends).toArrow()
        of_column: dict[int, list[dict]] = {}
        for row in fetched.to_pylist():
            of_column.setdefault(row["column_no"], []).append(row)
        done = []
        for i, cut in enumerate(own):
            sums = Sums(of_column.get(i, []))
            for no in cut.requests:
                found = sums.of(*cut.run(no))
                if found and marked(found, gate, "slots") >= gate:
                    done.append(found | {KEY: no})
                elif found:
                    open_.add(no)
        if done:
            fields = [(KEY, pa.int32())] + [(f.name, f.type) for f in fetched.schema if f.name == "n" or f.name[:4] in ("min_", "max_")]
            rows = pa.Table.from_pylist(done, schema=pa.schema(fields))
            frames.append(_column_rows(df.sparkSession.createDataFrame(rows), lanes))
    if open_:
        own = [cut for cut in cuts.values() if open_ & cut.requests.keys()]
        lanes = lanes_in(df, [cut.name for cut in own])
        groups = _cells(df, own, open_).groupBy("column_no", "segment", *lanes).agg(F.count("*").alias("n"))
        held = _within(groups, _runs(df, own, open_)).select(KEY, *lanes, "n")
        frames.append(gate_groups(held, [KEY], lanes, gate))
    return frames


def _histograms(df: DataFrame, wanted: Wanted) -> DataFrame:
    """Buckets of all requests with a width; text that is a number is read as one.

    A cell is one row for each width asked of its column. Buckets are counted by segment and then added up by request.
    """
    named = {r["column_name"] for r in wanted.values()}
    columns, kind = [c for c in df.columns if c in named], lane_map(df, list(named))
    cuts, lanes = [Cuts(c, kind[c], wanted) for c in columns], lanes_in(df, columns)
    widths = [sorted({r["width"] for r in cut.requests.values()}) for cut in cuts]
    texts = ", ".join(f"split('{','.join(map(str, w))}', ',')" for w in widths)
    width = F.explode(F.expr(f"CAST(get(array({texts}), column_no) AS array<int>)")).alias("width")
    rows = _cells(df, cuts, set(wanted)).select("*", width)
    width = F.col("width")
    value = {lane: F.col(lane).try_cast("double") if lane == "text" else F.col(lane) for lane in lanes}
    start = F.coalesce(*[range_start(value[lane], width) for lane in lanes]).alias("range_start")
    number = F.coalesce(*[value[lane].cast("double") for lane in lanes]).alias("number")
    sums = (
        rows.select("column_no", "segment", "width", start, number)
        .groupBy("column_no", "segment", "width", "range_start")
        .agg(F.count("*").alias("n"), F.min("number").alias("low_number"), F.max("number").alias("high_number"))
    )
    held = _within(sums, _runs(df, cuts, set(wanted)), F.col("width") == F.col("of_width"))
    buckets = held.groupBy(KEY, "width", "range_start").agg(
        F.sum("n").alias("n"), F.min("low_number").alias("min_number"), F.max("high_number").alias("max_number")
    )
    low, high = F.col("range_start"), range_end(F.col("range_start"), width)
    return buckets.withColumns(
        {
            "stat_kind": F.lit("range"),
            "column_value": range_label(low, high),
            "group_count": F.when(low.isNull(), 0).otherwise(F.col("n")),
            "range_end": high,
        }
    )


def _names(df: DataFrame, wanted: Wanted) -> DataFrame:
    fields = [(KEY, pa.int32()), ("column_name", pa.string()), ("additional_info", pa.string())]
    rows = [{KEY: no, "column_name": r["column_name"], "additional_info": r["additional_info"]} for no, r in wanted.items()]
    return local_table(df.sparkSession, pa.Table.from_pylist(rows, schema=pa.schema(fields)))


def request_profile(
    df: DataFrame, requests: DataFrame, gate: int = GATE, ignore_unknown: bool = False
) -> DataFrame:
    """Gated profile and histogram rows of every request, for one slice.

    Requests are read first: they name the columns, so that no other column is scanned. A request with unreadable bounds
    has no rows. ``table_count`` is the row count of the slice before any bound. Beside the requests, one row a segment comes
    to the driver: at most twice as many as there are bounds, and one or two more for each column.
    """
    wanted = read_requests(df, requests, ignore_unknown)
    layout = f"{KEY} int, {PROFILE_SCHEMA}"
    frames = _profiles(df, wanted, gate) if wanted else []
    ranged = {no: r for no, r in wanted.items() if r["width"] is not None}
    if ranged:
        frames.append(_histograms(df, ranged))
    if not frames:
        frames.append(df.sparkSession.createDataFrame([], layout))
    rows = union_all([fit(f, layout) for f in frames]).drop("column_name", "table_count")
    return rows.join(_names(df, wanted), KEY).drop(KEY).withColumn("table_count", df.agg(F.count("*")).scalar())
