import pytest
from conftest import rows
from pyspark.sql import functions as F

import slicewise as sw
from slicewise.functions.gaps import average_gap, point_gap, trend_gap
from slicewise.functions.rule_text import band_high, band_low, band_verdict, rule_limit, rule_operator, rule_verdict
from slicewise.operators.verdicts import NO_RULE, column_settings, past_for_settings, rule_status, validation_rows
from test_history import stats

RUN = sw.Run(1, 2, 3, 4, "2024-01-05", 1, "s")


@pytest.mark.parametrize(
    "rule, operator, limit",
    [
        ("<=10%", "<=", 10),
        (">=-90%", ">=", -90),
        ("<0%", "<", 0),
        (">50%", ">", 50),
        ("==0%", "==", 0),
        ("gap <=5", "<=", 5),
        ("<1% or >=5%", ">=", None),
        ("<=x%", "<=", None),
        ("10%", None, None),
    ],
)
def test_rule_text(spark, rule, operator, limit):
    row = spark.range(1).select(rule_operator(F.lit(rule)), rule_limit(F.lit(rule))).first()
    assert tuple(row) == (operator, limit)


@pytest.mark.parametrize(
    "rule, value, verdict",
    [
        ("<=10%", 10.0, "Pass"),
        ("<=10%", 10.1, "Fail"),
        (">=-90%", -90.0, "Pass"),
        ("<0%", 0.0, "Fail"),
        (">50%", 50.5, "Pass"),
        ("==0%", 0.0, "Pass"),
        ("==0%", None, "Fail"),
        ("<=x%", 1.0, "Fail"),
        ("10%", 1.0, None),
    ],
)
def test_rule_verdict(spark, rule, value, verdict):
    assert spark.range(1).select(rule_verdict(F.lit(value).cast("double"), F.lit(rule))).first()[0] == verdict


def test_band(spark):
    band = F.lit("-15%<->15%")
    assert tuple(spark.range(1).select(band_low(band), band_high(band)).first()) == (-15, 15)
    values = [(-15.0, "Pass"), (15.0, "Pass"), (15.01, "Fail"), (None, "Fail")]
    for value, verdict in values:
        assert spark.range(1).select(band_verdict(F.lit(value).cast("double"), band)).first()[0] == verdict


def test_gaps_and_zero_denominators(spark):
    row = spark.sql("SELECT 100L AS t, 40L AS n, 0L AS z").select(
        point_gap(F.col("t"), F.col("n")),
        trend_gap(F.col("t"), F.col("n")),
        average_gap(F.col("t"), F.col("n")),
        point_gap(F.col("t"), F.col("z")),
        trend_gap(F.col("z"), F.col("n")),
    )
    assert tuple(row.first()) == (150.0, -60.0, 150.0, None, None)


def settings(spark, *pairs):
    """(column, look-back, rule, band)"""
    requests = spark.createDataFrame([(c, "NA", n) for c, n, _, _ in pairs], "column_name string, additional_info string, number_of_partitions int")
    rules = spark.createDataFrame([(c, r, b) for c, _, r, b in pairs if r], "column_name string, rule string, trend_rule string")
    return column_settings(requests, rules)


def judged(spark, history, *pairs):
    chosen = settings(spark, *pairs)
    current = sw.current_stats(history, "2024-01-05", 1)
    return validation_rows(rule_status(current, past_for_settings(history, chosen, "2024-01-05"), chosen), RUN)


def two_days(spark):
    before = stats(spark, "2024-01-04", 1, ("a", 60), ("gone", 40))
    return before.unionByName(stats(spark, "2024-01-05", 1, ("a", 50), ("new", 50)))


def test_point_mode(spark):
    found = judged(spark, two_days(spark), ("c", 0, "<=100%", "-5%<->5%"))
    columns = ["column_value", "error_percentage", "status", "trend_status", "average_table_count"]
    assert rows(found, *columns) == [("a", 100.0, "Pass", None, None), ("new", 100.0, "Pass", None, None)]


def test_trend_mode_with_values_on_one_side(spark):
    found = judged(spark, two_days(spark), ("c", 3, "<=10%", "50%<->100%"))
    columns = ["column_value", "past_column_value", "error_percentage", "status", "average_error_records_count", "average_error_percentage", "trend_status"]
    assert rows(found, *columns) == [
        ("a", "a", -50.0, "Pass", 55, 81, "Pass"),
        # today is part of its own past
        ("new", "new", -50.0, "Pass", 50, 100, "Pass"),
        (None, "gone", None, "Fail", 40, 150, "Fail"),
    ]


def test_each_column_has_its_own_window(spark):
    history = two_days(spark)
    wide = history.withColumn("column_name", F.lit("d")).unionByName(history)
    found = judged(spark, wide, ("c", 3, "<=10%", "0%<->0%"), ("d", 1, "<=10%", "0%<->0%"))
    assert found.count() == 6
    far = stats(spark, "2024-01-02", 1, ("a", 10)).unionByName(two_days(spark))
    far = far.unionByName(far.withColumn("column_name", F.lit("d")))
    found = judged(spark, far, ("c", 3, "<=10%", "0%<->0%"), ("d", 1, "<=10%", "0%<->0%")).filter("column_value = 'a'")
    assert rows(found, "column_name", "average_error_records_count") == [("c", 40), ("d", 55)]


def test_null_groups_match_nothing(spark):
    history = stats(spark, "2024-01-04", 1, (None, 0)).unionByName(stats(spark, "2024-01-05", 1, (None, 0)))
    found = judged(spark, history, ("c", 3, "<=10%", "-5%<->5%"))
    assert rows(found, "table_count", "average_table_count", "status", "trend_status") == [
        (0, 100, "Fail", "Fail"),
        (100, 0, "Pass", "Fail"),
    ]


def test_whole_column_rows_match_each_other(spark):
    history = two_days(spark).withColumns({"stat_kind": F.lit("column"), "column_value": F.lit(None).cast("string")})
    history = history.groupBy(*[c for c in history.columns if c != "error_records_count"]).agg(F.sum("error_records_count").alias("error_records_count"))
    found = judged(spark, history, ("c", 3, "<=10%", "-5%<->5%"))
    assert rows(found, "status", "trend_status", "average_error_percentage") == [("Pass", "Pass", 0)]


def test_rule_without_operator_writes_nothing(spark):
    found = judged(spark, two_days(spark), ("c", 3, "10%", "-5%<->5%"))
    assert found.count() == 0
    assert sw.run_status(found, RUN).first()["status"] == "Pass"


def test_column_without_rule_aborts(spark):
    found = judged(spark, two_days(spark), ("c", 0, None, None))
    assert rows(found, "column_value", "status", "comments") == [("a", None, NO_RULE), ("new", None, NO_RULE)]
    assert sw.run_status(found, RUN).first()["status"] == "Abort"


def test_scenario_status(spark):
    good = judged(spark, two_days(spark), ("c", 0, "<=100%", None))
    bad = judged(spark, two_days(spark), ("c", 0, "<0%", None))
    trend_only = judged(spark, two_days(spark), ("c", 3, "<=10%", "-5%<->5%"))
    assert [sw.run_status(v, RUN).first()["status"] for v in (good, bad, trend_only)] == ["Pass", "Fail", "Fail"]
    assert sw.scenario_status(good).first()["status"] == "Pass"


@pytest.mark.parametrize(
    "statuses, verdict",
    [
        (["Pass", "Pass"], "pass"),
        (["Pass", "Fail"], "fail"),
        (["Abort"], "fail"),
        ([], "fail"),
        (["Pass", "Running"], None),
        (["Pass", None], None),
    ],
)
def test_run_verdict(spark, statuses, verdict):
    df = spark.createDataFrame([(s,) for s in statuses], "status string")
    assert sw.run_verdict(df).first()["verdict"] == verdict
