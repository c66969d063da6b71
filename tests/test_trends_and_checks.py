import datetime as dt

import pytest
from conftest import rows

import slicewise as sw


def days(spark, *pairs):
    data = [(d, v) for d, values in pairs for v in values]
    return spark.createDataFrame(data, "dt string, v string")


def test_table_trend(spark):
    df = days(spark, ("2023-12-30", "ab"), ("2023-12-31", "abcd"), ("2024-01-02", "abc"), ("2024-01-09", "a"))
    found = sw.table_trend(df, "dt", "t", look_back=3, band="-10%<->10%")
    assert rows(found, "n_rows", "past_average", "change_percentage", "status") == [
        (1, None, None, None),
        (2, None, None, None),
        (3, 3.0, 0.0, "Pass"),
        (4, 2.0, 100.0, "Fail"),
    ]
    with pytest.raises(ValueError):
        sw.table_trend(df, "dt", "t", look_back=0, band="-10%<->10%")


def test_column_trend_exact_and_approximate(spark):
    data = [("2024-01-01", 1.0, "a"), ("2024-01-01", None, "b"), ("2024-01-02", 3.0, None), ("2024-01-02", 3.0, None)]
    df = spark.createDataFrame(data, "dt string, x double, t string")
    fields = ["column_name", "n_rows", "n_null", "n_distinct", "min_number", "max_number", "mean_number", "past_distinct", "max_value"]
    want = [
        ("t", 2, 0, 2, None, None, None, None, "b"),
        ("t", 2, 2, 0, None, None, None, 2.0, None),
        ("x", 2, 0, 1, 3.0, 3.0, 3.0, 1.0, None),
        ("x", 2, 1, 1, 1.0, 1.0, 1.0, None, None),
    ]
    for exact in (True, False):
        assert rows(sw.column_trend(df, "dt", ["x", "t"], 2, exact_distinct=exact), *fields) == want


def test_column_value_trend(spark):
    df = days(spark, ("2024-01-01", "aab"), ("2024-01-02", "a"), ("2024-01-03", "aaab"))
    found = sw.column_value_trend(df, "dt", ["v"], look_back=2).filter("batch_date = '2024-01-03'")
    assert rows(found, "column_value", "group_count", "past_average", "change_percentage") == [
        ("a", 3, 1.5, 100.0),
        ("b", 1, 1.0, 0.0),
    ]


def test_zero_slices(spark):
    df = days(spark, ("2023-12-30", "a"), ("2024-01-02", "a"))
    found = rows(sw.zero_slices(df, "dt", "2023-12-29", "2024-01-02"))
    assert found == [(dt.date(2023, 12, 29),), (dt.date(2023, 12, 31),), (dt.date(2024, 1, 1),)]


def test_threshold_suggest(spark):
    from test_history import stats

    history = stats(spark, "2024-01-01", 1, ("a", 10)).unionByName(stats(spark, "2024-01-02", 1, ("a", 14)))
    row = sw.threshold_suggest(history, spread=1.0).first()
    assert (row["n_stored"], row["mean_count"], round(row["stddev_count"], 6)) == (2, 12.0, 2.828427)
    assert round(row["suggested_low"], 6) == 9.171573


def test_suggested_thresholds_keep_to_a_scenario_and_to_the_newest_runs(spark):
    from test_history import RUN, stats

    history = stats(spark, "2024-01-01", 1, ("a", 1000)).unionByName(stats(spark, "2024-01-01", 2, ("a", 10)))
    history = history.unionByName(stats(spark, "2024-01-02", 1, ("a", 14)))
    other = history.selectExpr("* EXCEPT (project_id)", "CAST(9 AS INT) AS project_id").filter("batch_sequence = 1")
    both = history.unionByName(other)
    found = sw.threshold_suggest(both, spread=1.0)
    assert rows(found, "project_id", "n_stored", "mean_count") == [(1, 3, 1024 / 3), (9, 2, 507.0)]
    newest = sw.threshold_suggest(both, spread=1.0, scope=RUN, runs="newest")
    assert rows(newest, "project_id", "n_stored", "mean_count") == [(1, 2, 12.0)]
    with pytest.raises(ValueError):
        sw.threshold_suggest(both, runs="some")


def test_checks(spark):
    data = [(1, "a", 5.0), (1, "b", 15.0), (2, None, None), (None, "zz", -1.0), (None, "a", 10.0)]
    df = spark.createDataFrame(data, "k int, t string, x double")
    checks = [
        sw.not_null("k"),
        sw.unique("k"),
        sw.unique("t"),
        sw.in_set("t", "a", "b"),
        sw.in_range("x", 0, 10),
        sw.matches("t", "^.$"),
    ]
    found = rows(sw.dq_checks(df, checks), "check_no", "check_name", "failing_rows", "table_count", "status")
    assert found == [
        (0, "not_null", 2, 5, "Fail"),
        (1, "unique", 2, 5, "Fail"),
        (2, "unique", 2, 5, "Fail"),
        (3, "in_set", 1, 5, "Fail"),
        (4, "in_range", 2, 5, "Fail"),
        (5, "matches", 1, 5, "Fail"),
    ]
    with pytest.raises(ValueError):
        sw.dq_checks(df, [sw.Check("other", "k")])
    assert rows(sw.dq_checks(df.filter("k > 9"), [sw.not_null("k"), sw.unique("k")]), "failing_rows", "failing_percentage", "status") == [
        (0, None, "Pass"),
        (0, None, "Pass"),
    ]


def test_custom_query(spark):
    df = days(spark, ("2024-01-01", "ab"))
    text = "SELECT * FROM seen WHERE dt = CAST(:batch_date AS STRING) AND v = 'a'"
    assert tuple(sw.custom_query(spark, text, "2024-01-01", {"seen": df}).first()) == (1, "Fail")
    assert tuple(sw.custom_query(spark, text, "2024-01-02", {"seen": df}).first()) == (0, "Pass")
