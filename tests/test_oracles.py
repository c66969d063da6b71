"""Every registered query against its SQL on the small tables."""

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as contract
from catalogue import ORACLES, QUERIES
from tools.check_oracles import TABLES, shape



@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SMALL}/{name}.parquet')")
    return connection


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert contract.queries().keys() >= QUERIES.keys() and contract.oracle_sql().keys() >= ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, db, name):
    df = QUERIES[name](spark, SMALL)
    result = db.execute(ORACLES[name])
    want = shape([d[0] for d in result.description], result.fetchall())
    assert shape(df.columns, [tuple(r) for r in df.collect()]) == want


def test_entry(spark):
    assert contract.entry(spark).count() > 0
