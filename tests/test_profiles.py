import collections
import datetime as dt
import decimal
import random

import pytest
from conftest import rows

import slicewise as sw
from slicewise.operators.profiles import marked, slot_words, used_slots


def expected_gated(values: dict[str, list], gate: int):
    """Brute force: column -> value rows or one column row, as (name, kind, value, count)."""
    out = []
    for name, column in values.items():
        groups = collections.Counter(column)
        if len(groups) < gate:
            out += [(name, "value", None if v is None else str(v), 0 if v is None else n) for v, n in groups.items()]
        elif column:
            out.append((name, "column", None, len(column)))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def gated(df, columns, gate):
    return rows(sw.gated_profile(df, columns, gate), "column_name", "stat_kind", "column_value", "group_count")


@pytest.mark.parametrize("gate", [1, 2, 4, 5, 20, 300])
def test_gate_matches_brute_force(spark, gate):
    rng = random.Random(gate)
    n = 400
    values = {
        "constant": ["x"] * n,
        "four": [rng.choice([1, 2, 3, 4]) for _ in range(n)],
        "four_and_null": [rng.choice([1, 2, 3, 4, None]) for _ in range(n)],
        "three_and_null": [rng.choice(["a", "b", "c", None]) for _ in range(n)],
        "five": [rng.choice("abcde") for _ in range(n)],
        "many": [rng.randrange(10**9) for _ in range(n)],
        "many_text": [f"t{rng.randrange(250)}" for _ in range(n)],
        "skewed": [7] * (n - 3) + [1, 2, 3],
        "empty": [None] * n,
    }
    types = dict(constant="string", four="int", four_and_null="bigint", three_and_null="string", five="string")
    types |= dict(many="bigint", many_text="string", skewed="int", empty="string")
    ddl = ", ".join(f"{c} {types[c]}" for c in values)
    df = spark.createDataFrame(list(zip(*values.values())), ddl).repartition(7)
    assert gated(df, list(values), gate) == expected_gated(values, gate)


def test_slots_never_prove_too_much(spark):
    """Marked slots are a lower bound of the number of groups, for any number of words."""
    for gate in (5, 40):
        for groups in (1, 3, 4, 5, 39, 40, 41, 500):
            df = spark.range(groups * 3).selectExpr(f"id % {groups} AS v")
            row = df.agg(*used_slots(["v"], gate, "s")).first().asDict()
            assert marked(row, gate, "s") <= groups
            if groups >= 10 * gate:
                assert marked(row, gate, "s") >= gate
    assert slot_words(5) == 1 and slot_words(40) == 3


def test_exactly_four_and_five_groups(spark):
    df = spark.sql("SELECT id % 4 AS four, id % 5 AS five FROM range(100)")
    found = gated(df, ["four", "five"], 5)
    assert [r[1] for r in found if r[0] == "four"] == ["value"] * 4
    assert [r for r in found if r[0] == "five"] == [("five", "column", None, 100)]


def test_null_group_counts_zero_but_the_column_row_counts_nulls(spark):
    df = spark.sql("SELECT * FROM VALUES (1), (NULL), (NULL) AS t(a)")
    assert rows(sw.value_profile(df, "a"), "column_value", "group_count", "table_count") == [("1", 1, 3), (None, 0, 3)]
    assert rows(sw.column_profile(df, ["a"]), "column_value", "group_count", "min_number") == [(None, 3, 1.0)]


def test_empty_slice_has_no_rows(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 'x') AS t(a, b)").filter("a > 1")
    for result in (
        sw.gated_profile(df, ["a", "b"]),
        sw.column_profile(df, ["a", "b"]),
        sw.multi_column_profile(df, ["a", "b"]),
    ):
        assert result.count() == 0


def test_typed_extremes(spark):
    """Numbers compare as numbers, not as text, and every type keeps its own text."""
    data = [
        (9, decimal.Decimal("9.50"), dt.date(2024, 1, 9), True, 9.5),
        (10, decimal.Decimal("10.25"), dt.date(2023, 12, 31), False, float("nan")),
    ]
    df = spark.createDataFrame(data, "i int, d decimal(10,2), t date, b boolean, f double")
    found = {r["column_name"]: r for r in sw.column_profile(df, df.columns).collect()}
    assert (found["i"]["min_value"], found["i"]["max_number"]) == ("9", 10.0)
    assert (found["d"]["min_value"], found["d"]["max_value"]) == ("9.50", "10.25")
    assert (found["t"]["min_value"], found["t"]["min_number"]) == ("2023-12-31", None)
    assert (found["b"]["min_value"], found["b"]["max_value"]) == ("false", "true")
    assert found["f"]["min_value"] == "9.5"
    values = rows(sw.multi_column_profile(df, df.columns), "column_name", "column_value", "group_count")
    assert ("d", "10.25", 1) in values and ("t", "2024-01-09", 1) in values and ("b", "true", 1) in values


def test_large_integers_stay_exact(spark):
    big = 2**53 + 1
    df = spark.createDataFrame([(big,), (big + 1,)], "a bigint")
    assert rows(sw.value_profile(df, "a"), "column_value") == [(str(big),), (str(big + 1),)]
    assert rows(sw.column_profile(df, ["a"]), "min_value", "max_value") == [(str(big), str(big + 1))]


def test_both_zeros_are_one_group(spark):
    df = spark.sql("SELECT * FROM VALUES (0.0D), (-0.0D), (1.0D) AS t(a)")
    assert rows(sw.gated_profile(df, ["a"]), "column_value", "group_count") == [("0.0", 2), ("1.0", 1)]


def test_nested_columns_are_refused(spark):
    df = spark.sql("SELECT array(1) AS a")
    with pytest.raises(TypeError):
        sw.value_profile(df, "a")


def test_names_with_dots_and_spaces(spark):
    df = spark.sql("SELECT 1 AS `a.b`, 'x' AS `c d`")
    assert rows(sw.gated_profile(df, ["a.b", "c d"]), "column_name", "column_value") == [("a.b", "1"), ("c d", "x")]
