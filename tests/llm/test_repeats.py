import hashlib

import numpy as np
import pytest
from cases import documents, empty, folder

from slicewise.llm import suffix_dedup
from slicewise.llm.queries import QUERIES


def brute(rows):
    """(id, n_bytes, n_removed, n_spans, digest) of each row; a NULL id is the largest."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    least, out = {}, []
    for doc, text in order:
        body = (text or "").encode()
        for i in range(len(body) - 49):
            least.setdefault(body[i : i + 50], doc)
    for doc, text in rows:
        body = (text or "").encode()
        gone = bytearray(len(body))
        for i in range(len(body) - 49):
            first = least[body[i : i + 50]]
            if first is not None and (doc is None or first < doc):
                gone[i : i + 50] = b"\1" * 50
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        kept = bytes(b for b, g in zip(body, gone) if not g)
        out.append((doc, len(body), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def digest(df):
    return sorted(
        ((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in df.collect()), key=str
    )


def test_query_against_brute_force(spark, tmp_path):
    table = documents()
    got = QUERIES["op7_suffix_dedup"](spark, folder(tmp_path, table)).collect()
    want = brute(list(zip(table["doc_id"].to_pylist(), table["text"].to_pylist())))
    assert sorted(map(tuple, got), key=str) == want


def test_empty_table(spark, tmp_path):
    assert QUERIES["op7_suffix_dedup"](spark, folder(tmp_path, empty("documents"))).collect() == []


@pytest.mark.parametrize("piece, share", [(128, 1024), (128, 8), (1 << 18, 1024), (1 << 18, 8), (1 << 18, 1)])
def test_small_alphabet(spark, monkeypatch, piece, share):
    """Texts full of overlapping repeats, cut into pieces or not; repeated rows, repeated ids, NULL ids and texts.

    With a ``share`` of 1,024 all triggers of so small a table are frequent, with 8 some, with 1 hardly any.
    """
    monkeypatch.setattr(suffix_dedup, "PIECE", piece)
    draw = np.random.default_rng(piece)
    parts = ["".join(draw.choice(list("abé"), size=n)) for n in (20, 33, 60, 90, 140)]
    rows = [(int(i // 2), "".join(draw.choice(parts, size=4)) + str(i % 5)) for i in range(40)]
    rows += [rows[3], rows[3], (None, rows[5][1]), (None, rows[5][1]), (900, None), (901, ""), (902, "ab" * 200), (903, "ba" * 150)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert digest(suffix_dedup.remove_repeats(df, share=share)) == brute(rows)


def test_frequent_triggers(spark):
    """Every trigger with the share asked for is found, none with less than half of it, from texts in many tasks."""
    said = "a very common line that stands in nearly all of the documents of a table"
    rows = [(k, (said if k % 4 else "") + "".join(chr(97 + (k * j * 7 + j * j) % 26) for j in range(100))) for k in range(400)]
    texts = suffix_dedup.bodies(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), "doc_id", "text")
    every = [key for _, text in rows for key in triggers(text)]
    counts = {key: every.count(key) for key in set(every)}
    got = suffix_dedup.frequent_triggers(texts, 64)
    assert {k for k, n in counts.items() if n * 64 >= len(every)} <= set(got)
    assert got and all(counts[k] * 128 >= len(every) for k in got) and len(got) < len(counts)

    parsed, said = suffix_dedup.parse(texts, got).collect(), dict(rows)
    assert len(parsed) == len(every) == len({(r.doc, r.unit) for r in parsed})
    first = {}
    for r in sorted(parsed, key=lambda r: r.doc):
        place, lead, trail = r.unit >> 10, (r.unit >> 5) & 31, r.unit & 31
        least = first.setdefault(said[r.doc][place - lead : place - trail + 50], r.doc)
        assert least < r.doc if r.whole else r.part == (r.phrase if r.key in got else 0)
    assert {r.key for r in parsed if not r.whole} == set(counts) and any(r.whole for r in parsed)


def triggers(text):
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    return suffix_dedup.phrases(data, np.zeros(len(data), dtype=int))[3].view(np.int64).tolist()


def test_equal_strings_have_the_same_trigger():
    draw = np.random.default_rng(5)
    common = draw.integers(97, 101, size=50, dtype=np.uint8)
    for _ in range(50):
        before, after = (draw.integers(97, 101, size=draw.integers(0, 80), dtype=np.uint8) for _ in range(2))
        data = np.concatenate([before, common, after])
        first, last, place, key, _ = suffix_dedup.phrases(data, np.zeros(len(data), dtype=int))
        at = len(before)
        k = int(np.flatnonzero((first <= at) & (at <= last))[0])
        alone = suffix_dedup.phrases(common, np.zeros(50, dtype=int))
        assert place[k] - at == alone[2][0] and key[k] == alone[3][0]


def test_many_rows_without_ids_and_texts_of_one_id(spark, tmp_path):
    """6,000 different texts with a NULL id, and 3,000 with one id, that share a passage of a smaller document."""
    said = "".join(chr(97 + (i * i) % 23) for i in range(120))
    rows = [(1, said)] + [(None, f"own text {k} {said} {k * 7919}") for k in range(6000)] + [(5, f"{k * 31} {said} five {k}") for k in range(3000)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    assert digest(suffix_dedup.remove_repeats(spark.read.parquet(f"{tmp_path}/docs"))) == brute(rows)


@pytest.mark.parametrize("gather", [50, 1_000_000])
def test_line_of_all_documents(spark, tmp_path, monkeypatch, gather):
    """Each occurrence gives one row, so twice as many for twice the documents; those that meet by key and part stay few."""
    monkeypatch.setattr(suffix_dedup, "GATHER", gather)
    line, made = "".join(chr(97 + (i * i) % 23) for i in range(120)), []
    for n in (300, 600):
        rows = [(k, f"{k * 7919} {line} {k * 104729}") for k in range(n)]
        spark.createDataFrame(rows, "doc_id long, text string").coalesce(4).write.parquet(f"{tmp_path}/{n}")
        docs = spark.read.parquet(f"{tmp_path}/{n}")
        texts = suffix_dedup.bodies(docs, "doc_id", "text")
        parsed = suffix_dedup.parse(texts, suffix_dedup.frequent_triggers(texts, 64))
        made.append(parsed.count())
        if gather > 50:  # one row a task of a frequent trigger's phrase, and other triggers are rare
            met = {(r.key, r.part): r["count"] for r in parsed.filter("NOT whole").groupBy("key", "part").count().collect()}
            tasks = texts.rdd.getNumPartitions()
            assert max(n for (_, part), n in met.items() if part) <= tasks < 10
            assert max(n for (_, part), n in met.items() if not part) <= max(tasks, made[-1] / 64)
        assert digest(suffix_dedup.remove_repeats(docs, share=64)) == brute(rows)
    assert made[0] > 300 and 1.9 < made[1] / made[0] < 2.1
