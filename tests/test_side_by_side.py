import collections
import random

import pytest
from conftest import plan, rows

import slicewise as sw

PRESENT, PRIOR = "2024-01-02", "2024-01-01"


def two_days(spark, here, before):
    """Two slices of one text column, and a third that must not count."""
    data = [(PRESENT, v) for v in here] + [(PRIOR, v) for v in before] + [("2023-12-31", "other")]
    return spark.createDataFrame(data, "dt string, v string")


def expected(here, before, null_safe=False):
    a, b = collections.Counter(here), collections.Counter(before)
    out = []
    for value in {v for v in a | b if v is not None}:
        out.append((value if value in a else None, a.get(value), value if value in b else None, b.get(value)))
    sides = [(None, 0 if None in a else None, None, 0 if None in b else None)]
    if not null_safe:
        sides = [(None, 0, None, None)] * (None in a) + [(None, None, None, 0)] * (None in b)
    out += [s for s in sides if s[1] is not None or s[3] is not None]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


FIELDS = ["column_value", "group_count", "past_column_value", "past_group_count"]


@pytest.mark.parametrize("null_safe", [False, True])
def test_values_match_a_full_outer_join(spark, null_safe):
    rng = random.Random(3)
    here = [rng.choice(["a", "b", "c", None]) for _ in range(50)]
    before = [rng.choice(["b", "c", "d", "e", None]) for _ in range(50)]
    df = two_days(spark, here, before)
    found = sw.value_profile_vs_prior(df, "dt", PRESENT, PRIOR, ["v"], null_safe=null_safe)
    assert rows(found, *FIELDS) == expected(here, before, null_safe)


def test_one_side_empty(spark):
    df = two_days(spark, ["a", "a"], [])
    assert rows(sw.value_profile_vs_prior(df, "dt", PRESENT, PRIOR, ["v"]), *FIELDS) == [("a", 2, None, None)]
    found = sw.column_profile_vs_prior(df, "dt", PRESENT, PRIOR, ["v"]).first()
    assert (found["group_count"], found["past_group_count"], found["past_dt"]) == (2, None, None)
    none = two_days(spark, [], [])
    assert sw.column_profile_vs_prior(none, "dt", PRESENT, PRIOR, ["v"]).count() == 0


def test_histogram_pairs(spark):
    data = [(PRESENT, 1), (PRESENT, 7), (PRESENT, None), (PRIOR, 8), (PRIOR, -3), (PRIOR, None)]
    df = spark.createDataFrame(data, "dt string, n int")
    found = rows(sw.histogram_vs_prior(df, "dt", PRESENT, PRIOR, "n", 5), *FIELDS)
    assert found == [
        ("0 <-> 5", 1, "0 <-> 5", 1),
        ("5 <-> 10", 1, "5 <-> 10", 1),
        (None, 0, None, None),
        (None, None, None, 0),
    ]


@pytest.mark.parametrize(
    "n_here, n_before, kind",
    [(4, 4, "column"), (3, 3, "value"), (4, 3, "value"), (3, 4, "value"), (300, 4, "column"), (300, 3, "value"), (4, 0, "value")],
)
def test_both_sides_must_reach_the_gate(spark, n_here, n_before, kind):
    here, before = [f"v{i % n_here}" for i in range(600)], [f"v{i}" for i in range(n_before)] * 2
    df = two_days(spark, here, before)
    found = sw.gated_profile_pair(df, "dt", PRESENT, PRIOR, ["v"])
    if kind == "column":
        assert rows(found, "stat_kind", *FIELDS) == [("column", None, 600, None, 2 * n_before)]
    else:
        assert {r["stat_kind"] for r in found.collect()} == {"value"}
        assert rows(found, *FIELDS) == expected(here, before)


def test_null_is_a_group_at_the_gate(spark):
    df = two_days(spark, ["a", "b", "c", None], ["a", "b", "c", None])
    assert rows(sw.gated_profile_pair(df, "dt", PRESENT, PRIOR, ["v"]), "stat_kind") == [("column",)]


def test_mixed_columns_in_one_call(spark):
    data = [(d, i, i % 3, f"t{i}") for d in (PRESENT, PRIOR) for i in range(30)]
    df = spark.createDataFrame(data, "dt string, many int, few int, texts string")
    found = rows(sw.gated_profile_pair(df, "dt", PRESENT, PRIOR, ["many", "few", "texts"]), "column_name", "stat_kind")
    assert found == [("few", "value")] * 3 + [("many", "column"), ("texts", "column")]


def test_one_scan_and_no_join(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    text = plan(sw.value_profile_vs_prior(events, "ts", "2024-01-15", "2024-01-14", ["event_type"]))
    physical = text[text.index("== Physical Plan ==") :]
    assert physical.count("FileScan") == 1 and "Join" not in physical


def test_compare_with_prior_skips_missing_days(spark):
    data = [("2024-01-10", i) for i in range(5)] + [("2024-01-06", i) for i in range(7)]
    df = spark.createDataFrame(data, "dt string, n int")
    found = sw.compare_with_prior(df, "dt", ["n"], widths={"n": 5})
    assert rows(found.select("stat_kind", "group_count", "past_group_count", found.past_dt.cast("string"))) == [
        ("column", 5, 7, "2024-01-06"),
        ("range", 5, 5, "2024-01-06"),
        ("range", None, 2, "2024-01-06"),
    ]
    with pytest.raises(ValueError):
        sw.compare_with_prior(df.filter("dt = '2024-01-10'"), "dt", ["n"])
