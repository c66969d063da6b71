"""Chat formatting with turn spans found by rendering, not by knowledge of the template.

A template is any function from a list of (role, text) turns to one text. Successive prefixes of a conversation are
rendered; what one turn adds to the output is its span, and two probe texts put in its place tell its marks from its
text. A template that changes what it wrote before is reported.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

Turn = tuple[str, str]
Render = Callable[[list[Turn]], str]

# The characters that begin a control string or end a role, and what stands for them inside texts.
ESCAPES = {"\\": "\\\\", "[": "\\l", "]": "\\r", "<": "\\a"}
PLAIN = {v: k for k, v in ESCAPES.items()}
ESCAPED, PAIR = re.compile(r"[\\\[\]<]"), re.compile(r"\\[\\lra]")


def escape(text: str) -> str:
    return ESCAPED.sub(lambda m: ESCAPES[m[0]], text)


def unescape(text: str) -> str:
    return PAIR.sub(lambda m: PLAIN[m[0]], text)


def instruct(turns: list[Turn]) -> str:
    """The template of the query: instructions in brackets, answers closed by ``</s>``, other roles named in brackets."""
    out = []
    for role, text in turns:
        if role == "user":
            out.append(f"[INST] {escape(text)} [/INST]")
        elif role == "assistant":
            out.append(f"{escape(text)}</s>")
        else:
            out.append(f"[ROLE {escape(role)}] {escape(text)} [/ROLE]")
    return "".join(out)


MARKS = re.compile(r"\[INST\] (?P<user>[^\[<]*) \[/INST\]|\[ROLE (?P<role>[^\[\]]*)\] (?P<other>[^\[<]*) \[/ROLE\]|(?P<assistant>[^\[<]*)</s>")


def parse_instruct(output: str) -> list[Turn]:
    """The turns read back from an output of ``instruct``; raises on anything else."""
    turns, at = [], 0
    while at < len(output):
        found = MARKS.match(output, at)
        if not found:
            raise ValueError(f"not a formatted conversation at character {at}")
        if found["role"] is not None:
            turns.append((unescape(found["role"]), unescape(found["other"])))
        else:
            role = "user" if found["user"] is not None else "assistant"
            turns.append((role, unescape(found[role])))
        at = found.end()
    return turns


def _common(a: str, b: str) -> int:
    """Length of the common start."""
    size = min(len(a), len(b))
    if a[:size] == b[:size]:
        return size
    low, high = 0, size
    while high - low > 1:
        middle = (low + high) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle
    return low


def render_spans(turns: list[Turn], render: Render) -> tuple[str, list[tuple[int, int]], bool]:
    """The output, the span of each turn's text in it, and whether the template rewrites history.

    Prefix ``k`` must begin with the output of prefix ``k - 1``; otherwise the template rewrites history and no spans are
    given. Inside what a turn adds, two renderings with the probe texts ``a`` and ``b`` agree up to the turn's text and
    after it. A turn whose probes do not show (a template that drops it) gets an empty span at its end.
    """
    before, spans = render([]), []
    for k, (role, _) in enumerate(turns):
        now = render(turns[: k + 1])
        if not now.startswith(before):
            return render(turns), [], True
        one, two = (render([*turns[:k], (role, probe)]) for probe in ("a", "b"))
        head = _common(one, two)
        tail = len(one) - head - 1
        shown = one != two and len(one) == len(two) and head >= len(before) and len(now) >= head + tail
        spans.append((head, len(now) - tail) if shown else (len(now), len(now)))
        before = now
    return before, spans, False


def conversations_of(rows: DataFrame) -> DataFrame:
    """(conv_id, turns) from rows (conv_id, turn, role, text).

    Turns are ordered by ``turn``, ties by role and text, NULL turns first. NULL roles and texts are empty. One conversation
    is one record, as its formatted text is.
    """
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    ordered = F.sort_array(F.collect_list(turn))
    return rows.groupBy("conv_id").agg(ordered.alias("turns"))


def format_conversations(
    rows: DataFrame, render: Render = instruct, trained: tuple[str, ...] = ("assistant",)
) -> DataFrame:
    """Per conversation: ``formatted``, ``spans`` (role, start and end of each text, in code points), ``rewrites``, ``loss_spans``.

    ``loss_spans`` are the spans of the ``trained`` roles. Conversations whose template rewrites history have no spans.
    """

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for conv_id, turns in zip(batch["conv_id"], batch["turns"]):
                pairs = [(t["role"], t["text"]) for t in turns]
                text, spans, rewrites = render_spans(pairs, render)
                told = [{"role": r, "start": a, "stop": b} for (r, _), (a, b) in zip(pairs, spans)]
                out.append((conv_id, text, told, rewrites, [x for x in told if x["role"] in trained]))
            names = ["conv_id", "formatted", "spans", "rewrites", "loss_spans"]
            yield pd.DataFrame(out, columns=names)

    span = "array<struct<role: string, start: long, stop: long>>"
    schema = f"conv_id string, formatted string, spans {span}, rewrites boolean, loss_spans {span}"
    convs = conversations_of(rows.select(F.col("conv_id").cast("long"), "turn", "role", "text"))
    # Ids travel as text: beside a NULL, pandas would turn whole numbers into fractions.
    done = convs.withColumn("conv_id", F.col("conv_id").cast("string")).mapInPandas(each, schema)
    return done.withColumn("conv_id", F.col("conv_id").cast("long"))


def read_back(formatted: DataFrame) -> DataFrame:
    """The digests of the query, read from ``formatted`` and ``loss_spans`` alone."""

    def sha(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for conv_id, text, spans in zip(batch["conv_id"], batch["formatted"], batch["loss_spans"]):
                turns = parse_instruct(text)
                loss = "".join(unescape(text[s["start"] : s["stop"]]) for s in spans)
                whole = "".join(f"{role}\n{said}\n" for role, said in turns)
                out.append((conv_id, len(turns), sha(whole), len(loss), sha(loss), len(text)))
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pd.DataFrame(out, columns=names)

    schema = "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    told = formatted.select(F.col("conv_id").cast("string").alias("conv_id"), "formatted", "loss_spans")
    return told.mapInPandas(each, schema).withColumn("conv_id", F.col("conv_id").cast("long"))
