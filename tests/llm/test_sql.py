"""Queries that SQL can express, against it, on tables with hard rows."""

import duckdb
import pytest
from cases import HARD, LONG, TABLES, documents, empty, folder

from slicewise.llm.queries import ORACLES, QUERIES
from tools.check_oracles import shape


# The check engine needs the square of a text's length; the long texts have a test of their own.
ROWS = [(i, t[:4000] if t and len(t) > 4000 else t, lang, source) for i, t, lang, source in HARD]


def compare(spark, where, name):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{where}/{table}.parquet')")
    df = QUERIES[name](spark, where)
    result = db.execute(ORACLES[name])
    want = shape([d[0] for d in result.description], result.fetchall())
    got = shape(df.columns, [tuple(r) for r in df.collect()])
    assert got == want
    return got


@pytest.mark.parametrize("name", ORACLES)
def test_hard_rows(spark, tmp_path, name):
    assert compare(spark, folder(tmp_path, documents(ROWS)), name)[1]


@pytest.mark.parametrize("name", ORACLES)
def test_empty_tables(spark, tmp_path, name):
    tables = {t: empty(t) for t in TABLES[1:]}
    assert not compare(spark, folder(tmp_path, documents([], base=False), **tables), name)[1]


def test_no_benchmark_items(spark, tmp_path):
    compare(spark, folder(tmp_path, documents(ROWS), benchmark=empty("benchmark")), "op4_decontamination")


def test_long_texts(spark, tmp_path):
    where = folder(tmp_path, documents(base=False))
    for name in ("op1_quality_rules", "op4_decontamination", "op5_line_dedup"):
        rows = {r.doc_id: r for r in QUERIES[name](spark, where).collect()}
        assert len(rows) == len(HARD)
        if name == "op1_quality_rules":
            assert (rows[900_006].n_words, rows[900_007].n_words) == (80_000, 80_001)
            assert rows[900_006].word_chars == len(LONG.replace(" ", ""))
