"""Boilerplate that outweighs the body of a text goes too; copies of whole documents stay for near-dedup."""

import time

import corpus_pipeline
from slicewise.llm import line_dedup

FOOTER = "All rights reserved by the owners of this very long footer line that stands on every site"


def test_stage_removes_whatever_the_share(spark):
    rows = [(i, f"{FOOTER}\nown {i}", f"src{i}") for i in range(10)]
    whole = "A document that was copied to many sites\nas a whole"
    rows += [(100 + i, whole, f"src{i}") for i in range(12)]
    rows += [(200, FOOTER, "src1"), (201, f"{FOOTER} \n\n{FOOTER}\nx", None), (202, None, "src1")]
    rare = "A line on nine sites only, much longer than all the rest of its text"
    rows += [(300 + i, f"{rare}\n{i}", f"src{i % 9}") for i in range(12)]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, source string, n_chars int")
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.drop_boilerplate(spark, docs, "").collect()}
    want = {i: text for i, text, _ in rows} | {i: f"own {i}" for i in range(10)} | {200: "", 201: "\nx"}
    assert got == {i: (text, len(text or "")) for i, text in want.items()}


def test_long_texts_of_nothing_but_boilerplate(spark, tmp_path):
    """12 texts of 40,000 lines that stand on 12 sites each, read from files."""
    shared = [f"line {k}" for k in range(40_000)]
    rows = [(i, "\n".join([f"own {i}", *shared[i:], *shared[:i], "tail"]), f"src{i}") for i in range(12)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4).write.parquet(f"{tmp_path}/docs")
    begun = time.monotonic()
    cleaned = line_dedup.clean_documents(spark.read.parquet(f"{tmp_path}/docs"), 10, min_texts=10)
    got = {r.row.doc_id: (r.cleaned, r.n_lines, r.n_removed) for r in cleaned.collect()}
    assert time.monotonic() - begun < 60
    assert got == {i: (f"own {i}", 40_002, 40_001) for i in range(12)}
