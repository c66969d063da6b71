import hashlib
from collections import defaultdict

import pyarrow.parquet as pq
from cases import SMALL, documents, empty, folder
from hypothesis import given, strategies as st

from slicewise.llm import chat_format
from slicewise.llm.queries import EXTRA_CONVERSATION, QUERIES

ROWS = "conv_id long, turn long, role string, text string, turns string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    convs = defaultdict(list)
    for r in rows:
        convs[r["conv_id"]].append((r["turn"], r["role"] or "", r["text"] or ""))
    out = {}
    for k, turns in convs.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out[k] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(loss), sha(loss))
    return out


def test_query(spark, tmp_path):
    where = folder(tmp_path, documents([], base=False))
    rows = pq.read_table(f"{SMALL}/conversations.parquet").to_pylist()
    rows += [{"conv_id": -7, "turn": i, "role": r, "text": EXTRA_CONVERSATION} for i, r in enumerate(("user", "assistant"))]
    got = QUERIES["op6_chat_format"](spark, where).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == brute(rows)


def test_empty_table_leaves_the_extra_conversation(spark, tmp_path):
    where = folder(tmp_path, documents([], base=False), conversations=empty("conversations"))
    assert [r.conv_id for r in QUERIES["op6_chat_format"](spark, where).collect()] == [-7]


def test_hard_rows(spark):
    rows = [
        (1, 0, "user", None, "x"), (1, 1, "assistant", "", "x"), (1, 1, "assistant", "</s>", "x"), (1, 1, "assistant", "</s>", "x"),
        (2, None, None, "no role", "x"), (2, 2, "tool ] [x", "a\\l\\", "x"), (None, 0, "assistant", "no id", "x"),
        (3, 0, "assistant", "long " * 50_000, "x"), (4, 0, "assistant", "\U0001f600[INST] \\[", "x"),
    ]
    done = chat_format.format_conversations(spark.createDataFrame(rows, ROWS))
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat_format.read_back(done).collect()}
    turns = [dict(zip(("conv_id", "turn", "role", "text"), (c, -1 if t is None else t, r, x))) for c, t, r, x, _ in rows]
    assert got == brute(turns)
    assert not any(r.rewrites for r in done.collect())


TEXT = st.text(alphabet=st.sampled_from("ab\\[]<>/s lrINST\n\u00e4"), max_size=12)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "x ] y", ""]), TEXT), max_size=6))
def test_round_trip(turns):
    output, spans, rewrites = chat_format.render_spans(turns, chat_format.instruct)
    assert not rewrites and chat_format.parse_instruct(output) == turns
    assert [chat_format.unescape(output[a:b]) for a, b in spans] == [t for _, t in turns]


def test_spans_of_a_foreign_template():
    def render(turns):
        return "<bos>" + "".join(f"{i}|{r.upper()}|{t.strip()}|end\n" for i, (r, t) in enumerate(turns))

    turns = [("user", "hi"), ("assistant", "end"), ("assistant", "")]
    output, spans, rewrites = chat_format.render_spans(turns, render)
    assert not rewrites and [output[a:b] for a, b in spans] == ["hi", "end", ""]


def test_rewritten_history_is_found(spark):
    def last_only(turns):
        return "".join(f"[{r}]{t if i == len(turns) - 1 else '...'}" for i, (r, t) in enumerate(turns))

    rows = spark.createDataFrame([(1, 0, "user", "a", ""), (1, 1, "assistant", "b", ""), (2, 0, "user", "a", "")], ROWS)
    got = {r.conv_id: (r.rewrites, len(r.spans)) for r in chat_format.format_conversations(rows, last_only).collect()}
    assert got == {1: (True, 0), 2: (False, 1)}


def test_a_template_that_drops_a_turn_has_an_empty_span():
    output, spans, rewrites = chat_format.render_spans([("system", "s"), ("user", "u")], lambda ts: "".join(t for r, t in ts if r == "user"))
    assert (output, spans, rewrites) == ("u", [(0, 0), (0, 1)], False)


def test_large_ids_beside_a_missing_one(spark):
    rows = [(c, t, "user", f"said {c}") for c in (2**62 + 1, 2**62 + 3, -7, None) for t in range(2)]
    formatted = chat_format.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1))
    for df in (formatted, chat_format.read_back(formatted)):
        assert {r.conv_id for r in df.collect()} == {2**62 + 1, 2**62 + 3, -7, None}
