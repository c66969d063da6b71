import hashlib
import re

import numpy as np
import pytest
from cases import documents, empty, folder

from slicewise.llm import window_dedup
from slicewise.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=20):
    """(doc_id, n_words, n_removed, digest) of each row; a NULL id is the largest."""
    least, out = {}, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        words = WORD.findall(text or "")
        for i in range(len(words) - window + 1):
            least.setdefault(tuple(words[i : i + window]), doc)
    for doc, text in rows:
        words, seen = WORD.findall(text or ""), set()
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            said = tuple(words[i : i + window])
            first = least[said]
            if said in seen or (first is not None and (doc is None or first < doc)):
                gone[i : i + window] = [True] * window
            seen.add(said)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((doc, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def digest(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in df.collect()), key=str)


def test_query_against_brute_force(spark, tmp_path):
    table = documents()
    got = QUERIES["op13_window_dedup"](spark, folder(tmp_path, table)).collect()
    assert sorted(map(tuple, got), key=str) == brute(list(zip(table["doc_id"].to_pylist(), table["text"].to_pylist())))


def test_empty_table(spark, tmp_path):
    assert QUERIES["op13_window_dedup"](spark, folder(tmp_path, empty("documents"))).collect() == []


@pytest.mark.parametrize("batch,piece", [(1, 8), (400, 64), (1 << 24, 1 << 20)])
def test_few_words(spark, monkeypatch, batch, piece):
    """Texts full of overlapping repeats: one text a batch or all, split word by word or whole; repeated rows and ids, NULL ids."""
    monkeypatch.setattr(window_dedup, "PIECE", piece)
    draw = np.random.default_rng(batch)
    parts = [" ".join(draw.choice(["a", "b", "é"], size=n)) for n in (2, 3, 6, 9)]
    rows = [(int(i // 2), " \n".join(draw.choice(parts, size=5)) + f" {i % 5}") for i in range(40)]
    rows += [rows[3], rows[3], (None, rows[5][1]), (None, rows[5][1]), (None, rows[6][1] + " x"), (900, None), (901, ""), (-3, "a b " * 90)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for window in (1, 4):
        assert digest(window_dedup.remove_windows(df, window=window, batch_bytes=batch)) == brute(rows, window)


def test_spans_are_maximal_runs(spark):
    words = [str(i) for i in range(100)]
    rows = [(1, " ".join(words)), (2, " ".join(["x", *words[:25], "y", *words[30:55], *words[60:85], "z"]))]
    done = {r.doc_id: r for r in window_dedup.remove_windows(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert done[1].spans == [] and done[1].kept == rows[0][1]
    assert [tuple(s) for s in done[2].spans] == [(1, 26), (27, 77)]
    assert done[2].kept == "x y z"


def test_many_rows_without_ids(spark, tmp_path):
    """6,000 different rows with a NULL id that share a passage of a smaller document, read from a file."""
    said = " ".join(f"p{i}" for i in range(30))
    rows = [(1, said)] + [(None, f"own{k} {said} end{k}") for k in range(6000)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    done = window_dedup.remove_windows(spark.read.parquet(f"{tmp_path}/docs")).collect()
    assert sorted(r.kept for r in done) == sorted([said] + [f"own{k} end{k}" for k in range(6000)])


def test_rolling_hashes_are_those_of_the_windows():
    draw = np.random.default_rng(2)
    words = draw.integers(1 << 63, size=200, dtype=np.uint64)
    words[100:140] = words[10:50]
    hashes = window_dedup.window_hashes(words, window_dedup._ODD[0])
    assert len(hashes) == 181 and (hashes[100:121] == hashes[10:31]).all() and len(np.unique(hashes)) == 160
    assert not len(window_dedup.window_hashes(words[:19], window_dedup._ODD[0]))


def test_a_repeated_task_with_other_batches_is_an_error():
    told = list(window_dedup.hash_batch([(1, 1, b"a " * 25), (2, 2, b"a " * 30)], 1024))
    about = next(d for _, s, d in told if s < 0)
    with pytest.raises(RuntimeError, match="another order"):
        list(window_dedup.batch_runs(about, []))
