import datetime as dt

import pytest
from conftest import plan, rows

import slicewise as sw
from slicewise.layout import STATS_SCHEMA

RUN = sw.Run(1, 2, 3, 4, "2024-01-05", 1)


def stats(spark, day, sequence, *pairs, table="t", table_count=100):
    data = [(v, n, table_count) for v, n in pairs]
    df = spark.createDataFrame(data, "column_value string, group_count bigint, table_count bigint")
    df = df.selectExpr("*", "'c' AS column_name", "'value' AS stat_kind")
    return sw.to_stats(df, sw.Run(1, 2, 3, 4, day, sequence), table)


AVERAGES = ["column_value", "past_table_count", "past_count"]


@pytest.mark.parametrize("fmt", ["parquet", "csv", "orc", "json"])
def test_a_repeated_run_is_not_doubled(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    odd = [("plain", 1), ('quote " and, comma', 2), ("line\nbreak", 3), ("", 4), (None, 5)]
    sw.write_rows(stats(spark, "2024-01-05", 1, ("old", 9)), path, fmt)
    sw.write_rows(stats(spark, "2024-01-05", 1, *odd), path, fmt)
    sw.write_rows(stats(spark, "2024-01-05", 2, ("other run", 7)), path, fmt)
    kept = sw.read_rows(spark, path, STATS_SCHEMA, fmt)
    assert rows(kept, "column_value", "error_records_count") == sorted(
        [*odd, ("other run", 7)], key=lambda t: tuple((x is None, str(x)) for x in t)
    )
    assert {r["batch_date"] for r in kept.collect()} == {dt.date(2024, 1, 5)}


def test_catalog_table(spark):
    for sequence, pairs in ((1, [("old", 9)]), (1, [("a", 1), ("b", 2)]), (2, [("c", 3)])):
        sw.write_table(stats(spark, "2024-01-05", sequence, *pairs), "kept_stats")
    assert rows(spark.table("kept_stats"), "column_value", "error_records_count") == [("a", 1), ("b", 2), ("c", 3)]
    sw.write_table(stats(spark, "2024-01-05", 1, ("a", 1)), "kept_stats", replace_runs=False)
    assert spark.table("kept_stats").count() == 4
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_runs_of_other_projects_stay(spark, tmp_path):
    path = str(tmp_path / "h")
    sw.write_rows(stats(spark, "2024-01-05", 1, ("a", 1)), path)
    other = stats(spark, "2024-01-05", 1, ("b", 2)).selectExpr("*").withColumn("project_id", spark.range(1).selectExpr("cast(9 AS int) v").scalar())
    sw.write_rows(other, path)
    assert rows(sw.read_rows(spark, path, STATS_SCHEMA), "project_id", "column_value") == [(1, "a"), (9, "b")]


def test_reading_prunes_dates(spark, tmp_path):
    path = str(tmp_path / "h")
    for day in ("2024-01-04", "2024-01-05"):
        sw.write_rows(stats(spark, day, 1, ("a", 1)), path)
    past = sw.past_stats(sw.read_rows(spark, path, STATS_SCHEMA), "2024-01-05", 0)
    assert "PartitionFilters: [isnotnull(batch_date" in plan(past)
    assert past.count() == 1


def test_window_takes_both_ends_and_today(spark):
    history = stats(spark, "2024-01-01", 1, ("a", 1000))
    for day, n in (("2024-01-02", 10), ("2024-01-04", 20), ("2024-01-05", 33)):
        history = history.unionByName(stats(spark, day, 1, ("a", n)))
    history = history.unionByName(stats(spark, "2024-01-06", 1, ("a", 5000)))
    assert rows(sw.history_average(history, "2024-01-05", 3), *AVERAGES) == [("a", 100, 21)]


def test_window_crosses_the_year(spark):
    history = stats(spark, "2023-12-30", 1, ("a", 4)).unionByName(stats(spark, "2024-01-03", 1, ("a", 8)))
    assert rows(sw.history_average(history, "2024-01-03", 5), "past_count") == [(6,)]


def test_repeated_runs_weigh_more_unless_newest(spark):
    history = stats(spark, "2024-01-04", 1, ("a", 10))
    for sequence, n in ((1, 90), (2, 20)):
        history = history.unionByName(stats(spark, "2024-01-05", sequence, ("a", n)))
    assert rows(sw.history_average(history, "2024-01-05", 3), "past_count") == [(40,)]
    assert rows(sw.history_average(history, "2024-01-05", 3, runs="newest"), "past_count") == [(15,)]
    with pytest.raises(ValueError):
        sw.history_average(history, "2024-01-05", 3, runs="some")


def test_tables_are_kept_apart(spark):
    history = stats(spark, "2024-01-05", 1, ("a", 10)).unionByName(stats(spark, "2024-01-05", 1, ("a", 30), table="u"))
    assert rows(sw.history_average(history, "2024-01-05", 3), "table_name", "past_count") == [("t", 10), ("u", 30)]


def test_stats_of_all_slices(spark):
    df = spark.sql("SELECT * FROM VALUES ('2024-01-01', 'x'), ('2024-01-01', NULL), ('2024-01-02', 'x') AS t(dt, c)")
    found = sw.stats_of_all_slices(df, "dt", ["c"], RUN, "t")
    found = found.select(found.batch_date.cast("string"), "column_value", "error_records_count", "table_count")
    assert rows(found) == [("2024-01-01", "x", 1, 2), ("2024-01-01", None, 0, 2), ("2024-01-02", "x", 1, 1)]


def test_newest_drops_values_of_the_older_run(spark):
    history = stats(spark, "2024-01-05", 1, ("a", 10), ("gone", 7)).unionByName(stats(spark, "2024-01-05", 2, ("a", 20)))
    assert rows(sw.history_average(history, "2024-01-05", 3, runs="newest"), "column_value", "past_count") == [("a", 20)]
