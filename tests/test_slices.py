import datetime as dt

import pytest
from conftest import plan, rows

import slicewise as sw

DAYS = ["2023-12-29", "2024-01-01", "2024-01-03"]


@pytest.fixture(params=["string", "date", "timestamp", "timestamp_ntz"])
def dated(request, spark):
    values = ", ".join(f"('{d}', {i})" for i, d in enumerate(DAYS))
    df = spark.sql(f"SELECT dt, n FROM VALUES {values} AS t(dt, n)")
    return df.withColumn("dt", df.dt.cast(request.param))


def test_slice_of_each_date_type(dated):
    assert rows(sw.slice_scan(dated, "dt", "2024-01-01", ["n"])) == [(1,)]
    assert rows(sw.slice_count(dated, "dt", "2024-01-02")) == [(0,)]
    assert rows(sw.latest_slice_date(dated, "dt")) == [(dt.date(2024, 1, 3),)]
    assert rows(sw.latest_slice_count(dated, "dt")) == [(1,)]
    assert rows(sw.slice_probe(dated, "dt", "2024-01-01")) == [(dt.date(2024, 1, 1),)]
    assert sw.slice_probe(dated, "dt", "2024-01-02").isEmpty()
    found = rows(sw.slice_exists(dated, "dt", ["2024-01-01", "2024-01-02"]))
    assert found == [(dt.date(2024, 1, 1), True), (dt.date(2024, 1, 2), False)]


def test_prior_slice_crosses_the_year(dated):
    assert rows(sw.prior_slice_date(dated, "dt", "2024-01-01")) == [(dt.date(2023, 12, 29),)]


def test_prior_slice_takes_the_nearest(dated):
    assert rows(sw.prior_slice_date(dated, "dt", "2024-01-05")) == [(dt.date(2024, 1, 3),)]
    assert rows(sw.prior_slice_date(dated, "dt", "2023-12-27", step=1)) == [(dt.date(2023, 12, 29),)]


def test_prior_slice_stops_after_seven_more_steps(dated):
    assert rows(sw.prior_slice_date(dated, "dt", "2024-01-11")) == [(dt.date(2024, 1, 3),)]
    assert rows(sw.prior_slice_date(dated, "dt", "2024-01-12")) == [(None,)]
    assert rows(sw.prior_slice_date(dated, "dt", "2024-01-17", step=-7)) == [(dt.date(2024, 1, 3),)]


def test_latest_slice_counts_the_whole_day(spark):
    df = spark.sql("SELECT * FROM VALUES (TIMESTAMP'2024-01-02 23:00:00'), (TIMESTAMP'2024-01-02 01:00:00'), "
                   "(TIMESTAMP'2024-01-01 05:00:00') AS t(ts)")
    assert rows(sw.latest_slice_count(df, "ts")) == [(2,)]


def test_empty_table(spark):
    df = spark.sql("SELECT DATE'2024-01-01' AS dt").filter("dt IS NULL")
    assert rows(sw.latest_slice_date(df, "dt")) == [(None,)]
    assert rows(sw.latest_slice_count(df, "dt")) == [(0,)]
    assert rows(sw.table_count(df)) == [(0,)]


def test_query_dataset_binds_the_date(spark):
    df = spark.sql("SELECT DATE'2024-01-01' AS dt, 'it''s' AS x")
    text = "SELECT x FROM dated_rows WHERE dt = :batch_date"
    assert rows(sw.query_dataset(spark, text, "2024-01-01", {"dated_rows": df})) == [("it's",)]
    with pytest.raises(ValueError):
        sw.query_dataset(spark, text, "2024-01-01' OR '1'='1")


def test_partition_pruning_and_pushdown(spark, tmp_path):
    path = str(tmp_path / "parts")
    spark.sql("SELECT id, date_add(DATE'2024-01-01', cast(id % 5 AS int)) AS dt FROM range(50)").write.partitionBy("dt").parquet(path)
    df = spark.read.parquet(path)
    text = plan(sw.slice_count(df, "dt", "2024-01-02"))
    assert "PartitionFilters: [isnotnull(dt" in text
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    text = plan(sw.slice_scan(events, "ts", "2024-01-15", ["value"]))
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00)" in text and "LessThan(ts,2024-01-16T00:00)" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in text


def test_query_dataset_leaves_the_callers_views_alone(spark):
    spark.range(5).createOrReplaceTempView("observed")
    found = sw.query_dataset(spark, "SELECT count(*) AS n FROM observed, other", "2024-01-01", {"observed": spark.range(2), "other": spark.range(1)})
    assert found.first()["n"] == 2 and spark.table("observed").count() == 5
    assert not spark.catalog.tableExists("other")
