"""Each stage of the pipeline against a brute-force version on what its predecessor kept."""

import re

import numpy as np
import pyarrow.parquet as pq
from cases import CLASHES, documents, empty, folder
from test_simhash import brute_fingerprint, brute_roots, links_of

import corpus_pipeline
from slicewise.llm.common import written

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def windows(said, size):
    return {tuple(said[i : i + size]) for i in range(len(said) - size + 1)}


def brute_clean(rows):
    """Text of each row without lines on ``MIN_SITES`` sites and in ``MIN_TEXTS`` distinct texts."""
    sites, texts, out = {}, {}, {}
    for r in rows:
        for line in (r.text or "").split("\n"):
            plain = line.strip(" \t\n\x0b\x0c\r")
            texts.setdefault(plain, set()).add(r.text)
            if r.source is not None:
                sites.setdefault(plain, set()).add(r.source)
    for r in rows:
        lines = (r.text or "").split("\n")
        plain = [x.strip(" \t\n\x0b\x0c\r") for x in lines]
        enough = {p for p in plain if len(sites.get(p, ())) >= corpus_pipeline.MIN_SITES and len(texts[p]) >= corpus_pipeline.MIN_TEXTS}
        hit = [bool(p) and p in enough for p in plain]
        out[r.doc_id] = "\n".join(x for x, h in zip(lines, hit) if not h) if any(hit) else r.text
    return out


def test_stages(spark, tmp_path):
    where = folder(tmp_path, documents())
    docs = spark.read.parquet(f"{where}/documents.parquet")
    columns, before = docs.columns, rows_of(docs)
    stages = dict(corpus_pipeline.STAGES)

    good = written(stages["quality classifier"](spark, docs, where), "good")
    kept = rows_of(good)
    assert good.columns == columns and all(before[i] == r for i, r in kept.items())
    quality = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{where}/labels.parquet").to_pylist()}
    told = [(quality[i] == 1, i in kept) for i in before if i in quality]
    assert np.mean([a == b for a, b in told]) > 0.95

    clean = written(stages["line dedup"](spark, good, where), "clean")
    texts, want = rows_of(clean), brute_clean(list(kept.values()))
    assert clean.columns == columns and {i: r.text for i, r in texts.items()} == want
    assert all(r.n_chars == (kept[i].n_chars if r.text == kept[i].text else len(r.text)) for i, r in texts.items())

    alone = written(stages["simhash near-dedup"](spark, clean, where), "alone")
    ids = list(texts)
    roots = brute_roots(ids, links_of(np.array([brute_fingerprint(texts[i].text) for i in ids], dtype=np.uint64)))
    assert alone.columns == columns and set(rows_of(alone)) == {i for i in ids if roots[i] == i}

    free = written(stages["benchmark decontamination"](spark, alone, where), "free")
    items = [words(r["text"]) for r in pq.read_table(f"{where}/benchmark.parquet").to_pylist()]
    asked = {}
    for item in items:
        if item:
            asked.setdefault(min(10, len(item)), set()).update(windows(item, min(10, len(item))))
    leaked = {i for i, r in rows_of(alone).items() if any(asked[n] & windows(words(r.text), n) for n in asked)}
    assert free.columns == columns and set(rows_of(free)) == set(rows_of(alone)) - leaked

    mixed = rows_of(stages["mixing to target weights"](spark, free, where))
    # Columns that the documents have already stay theirs.
    assert mixed.keys() <= rows_of(free).keys() and all((r.topic, r.n_tokens, r.probability) == ("x",) * 3 for r in mixed.values())
    more = stages["mixing to target weights"](spark, free.drop("topic", "n_tokens", "probability"), where)
    assert more.columns[-3:] == ["topic", "n_tokens", "probability"] and set(rows_of(more)) == mixed.keys()
    assert all(0 < r.probability <= 1 for r in more.collect())
    assert {r.doc_id for r in corpus_pipeline.run(spark, where).collect()} == mixed.keys()
    assert set(CLASHES) <= set(columns)


def test_empty_documents(spark, tmp_path):
    assert corpus_pipeline.run(spark, folder(tmp_path, empty("documents"))).collect() == []
