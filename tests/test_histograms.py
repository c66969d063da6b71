import pytest
from conftest import plan, rows

import slicewise as sw


def numbers(spark, *values, kind="int"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def test_remainder_takes_the_sign_of_the_value(spark):
    df = numbers(spark, -7, -5, -3, 0, 4, 5, None)
    found = rows(sw.range_histogram(df, "v", 5), "column_value", "group_count", "min_number", "max_number")
    assert found == [
        ("-5 <-> 0", 2, -7.0, -5.0),
        ("0 <-> 5", 3, -3.0, 4.0),
        ("5 <-> 10", 1, 5.0, 5.0),
        (None, 0, None, None),
    ]


def test_floor_mode_has_equal_widths(spark):
    df = numbers(spark, -7, -5, -3, 0, 4, 5)
    found = rows(sw.range_histogram(df, "v", 5, mode="floor"), "range_start", "group_count")
    assert found == [(-10, 1), (-5, 2), (0, 2), (5, 1)]


def test_sorted_by_start_not_by_label(spark):
    starts = [r["range_start"] for r in sw.range_histogram(numbers(spark, 11, 6, 3), "v", 5, sort=True).collect()]
    assert starts == [0, 5, 10]


def test_high_bound_opens_a_bucket_and_count_ignores_bounds(spark):
    df = numbers(spark, -1.0, 0.0, 9.5, 10.0, 10.5, None, kind="double")
    found = rows(sw.bounded_histogram(df, "v", 0, 10, 5), "column_value", "group_count", "table_count")
    assert found == [("0 <-> 5", 1, 6), ("10 <-> 15", 1, 6), ("5 <-> 10", 1, 6)]


def test_values_without_a_bucket(spark):
    df = numbers(spark, float("nan"), float("inf"), 1e300, 3.0, kind="double")
    found = rows(sw.range_histogram(df, "v", 5), "column_value", "group_count")
    assert found == [("0 <-> 5", 1), (None, 0)]


def test_integers_beyond_double_precision(spark):
    df = numbers(spark, 2**53 + 1, kind="bigint")
    assert rows(sw.range_histogram(df, "v", 2), "range_start") == [(2**53,)]


@pytest.mark.parametrize("width", [0, -5])
def test_width_must_be_positive(spark, width):
    with pytest.raises(ValueError):
        sw.range_histogram(numbers(spark, 1), "v", width)


def test_text_is_refused(spark):
    with pytest.raises(TypeError):
        sw.range_histogram(spark.sql("SELECT 'x' AS v"), "v", 5)


def test_bounds_reach_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    text = plan(sw.bounded_histogram(orders, "o_totalprice", 0, 300000, 50000))
    assert "GreaterThanOrEqual(o_totalprice,0.0)" in text
    assert "ReadSchema: struct<o_totalprice:double>" in text
