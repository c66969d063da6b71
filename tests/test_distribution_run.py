import pytest
from conftest import rows
from pyspark.sql import functions as F

import slicewise as sw
from slicewise.layout import STATS_SCHEMA, STATUS_SCHEMA
from slicewise.operators.verdicts import JUDGED_SCHEMA
from slicewise.plans import distribution


def observed(spark):
    return spark.sql(
        "SELECT date_add(DATE'2024-01-01', CAST(id % 5 AS INT)) AS dt, "
        "CASE WHEN id % 4 = 0 THEN 'm' ELSE 'f' END AS gender, id AS salary FROM range(200)"
    )


def controls(spark, *requests, rules=(("gender", "<=400%", "-500%<->500%"), ("salary", "<=10%", "-5%<->5%"))):
    asked = spark.createDataFrame(
        [(1, 3, 4, "t", c, i, "dt", n) for c, i, n in requests or [("none", "NA", 0)]],
        "project_id int, pipeline_id int, scenario_id int, table_name string, column_name string, additional_info string, "
        "date_partition_columns string, number_of_partitions int",
    )
    known = spark.createDataFrame(
        [(1, 2, 3, c, r, b) for c, r, b in rules],
        "project_id int, sub_project_id int, pipeline_id int, column_name string, rule string, trend_rule string",
    )
    return asked, known


def run_on(spark, folder, day, sequence, *requests, **kw):
    asked, known = controls(spark, *requests, **kw)
    run = sw.Run(1, 2, 3, 4, day, sequence, "distribution")
    return sw.run_distribution(observed(spark), "dt", "t", asked, known, run, str(folder)).collect()


def read(spark, folder, name, ddl):
    return sw.read_rows(spark, f"{folder}/{name}", ddl)


REQUESTS = [("gender", "NA", 3), ("salary", "0<->100<->50", 3)]


def test_days_in_a_row(spark, tmp_path):
    first = run_on(spark, tmp_path, "2024-01-01", 1, *REQUESTS)
    second = run_on(spark, tmp_path, "2024-01-02", 1, *REQUESTS)
    assert [r["status"] for r in first + second] == ["Fail", "Fail"]
    stats = read(spark, tmp_path, "stats", STATS_SCHEMA)
    day = stats.filter("batch_date = '2024-01-02'")
    assert rows(day, "column_name", "stat_kind", "column_value", "error_records_count", "table_count") == [
        ("gender", "value", "f", 30, 40),
        ("gender", "value", "m", 10, 40),
        ("salary", "column", None, 20, 40),
        ("salary", "range", "0 <-> 50", 10, 40),
        ("salary", "range", "50 <-> 100", 10, 40),
    ]
    judged = read(spark, tmp_path, "validation", JUDGED_SCHEMA).filter("batch_date = '2024-01-02'")
    assert rows(judged.filter("column_name = 'gender'"), "column_value", "error_percentage", "status", "average_error_records_count", "trend_status") == [
        ("f", -25.0, "Pass", 30, "Pass"),
        ("m", -75.0, "Pass", 10, "Pass"),
    ]
    # The first day had a value on the high bound, hence one bucket more, which is now seen in the past only.
    salary = judged.filter("column_name = 'salary' AND trend_status = 'Fail'")
    assert rows(salary, "column_value", "past_column_value") == [
        ("0 <-> 50", "0 <-> 50"),
        ("50 <-> 100", "50 <-> 100"),
        (None, "100 <-> 150"),
        (None, None),
    ]


def test_a_repeated_run_changes_nothing(spark, tmp_path):
    for _ in range(2):
        run_on(spark, tmp_path, "2024-01-01", 1, *REQUESTS)
    assert read(spark, tmp_path, "stats", STATS_SCHEMA).count() == 6
    assert read(spark, tmp_path, "status", STATUS_SCHEMA).count() == 1


def test_passing_run(spark, tmp_path):
    assert run_on(spark, tmp_path, "2024-01-01", 1, ("gender", "NA", 3))[0]["status"] == "Pass"


def test_missing_slice_and_missing_requests_abort(spark, tmp_path):
    gone = run_on(spark, tmp_path, "2024-02-01", 1, *REQUESTS)
    assert [(r["status"], r["comments"]) for r in gone] == [("Abort", "no rows for the batch date")]
    asked, known = controls(spark, *REQUESTS)
    run = sw.Run(9, 2, 3, 4, "2024-01-01", 1)
    none = sw.run_distribution(observed(spark), "dt", "t", asked, known, run, str(tmp_path)).first()
    assert (none["status"], none["comments"]) == ("Abort", "no column request")


def test_column_without_rule_aborts(spark, tmp_path):
    found = run_on(spark, tmp_path, "2024-01-01", 1, ("gender", "NA", 0), rules=(("salary", "<=10%", None),))
    assert found[0]["status"] == "Abort"


def test_an_error_leaves_an_abort_row_and_is_raised(spark, tmp_path, monkeypatch):
    def broken(*args):
        raise RuntimeError("broken")

    monkeypatch.setattr(distribution, "judge_stats", broken)
    with pytest.raises(RuntimeError):
        run_on(spark, tmp_path, "2024-01-01", 1, *REQUESTS)
    row = read(spark, tmp_path, "status", STATUS_SCHEMA).first()
    assert (row["status"], row["comments"]) == ("Abort", "error: RuntimeError")


def test_statistics_survive_an_error_while_judging(spark, tmp_path, monkeypatch):
    """They count for the averages of later days; the manifest says that the run ended early."""
    def broken(*args):
        raise RuntimeError("broken")

    run_on(spark, tmp_path, "2024-01-01", 1, *REQUESTS)
    before = rows(read(spark, tmp_path, "stats", STATS_SCHEMA))
    with monkeypatch.context() as patched:
        patched.setattr(distribution, "judge_stats", broken)
        for _ in range(2):
            with pytest.raises(RuntimeError):
                run_on(spark, tmp_path, "2024-01-02", 1, *REQUESTS)
    stats = read(spark, tmp_path, "stats", STATS_SCHEMA)
    assert rows(stats.filter("batch_date = '2024-01-01'")) == before and stats.count() == len(before) + 5
    early = sw.runs_in_state(spark, str(tmp_path), "2024-01-02", "aborted")
    assert rows(early, "table_name", "batch_sequence") == [("t", 1)]
    average = sw.history_average(stats, "2024-01-02", 1).filter("column_value = 'm'").first()
    assert average["past_count"] == 10
    # An error that comes before the statistics leaves those of the earlier try.
    with pytest.raises(ValueError):
        run_on(spark, tmp_path, "2024-01-02", 1, ("gone", "NA", 3))
    assert read(spark, tmp_path, "stats", STATS_SCHEMA).count() == len(before) + 5
    assert run_on(spark, tmp_path, "2024-01-02", 1, *REQUESTS)[0]["status"] == "Fail"
    assert sw.runs_in_state(spark, str(tmp_path), "2024-01-02", "aborted").count() == 0


def test_tables_no_longer_asked_for_are_taken_back(spark, tmp_path):
    asked, known = controls(spark, ("gender", "NA", 0), rules=(("gender", "<=-100%", "0%<->0%"),))
    run = sw.Run(1, 2, 3, 4, "2024-01-01", 1, "distribution")
    both = asked.unionByName(asked.withColumn("table_name", F.lit("u")))
    tables = {"t": (observed(spark).withColumn("gender", F.lit("x")), "dt"), "u": (observed(spark), "dt")}

    def status(requests, rules=known):
        return sw.run_distribution_tables(tables, requests, rules, run, str(tmp_path)).first()["status"]

    def names(name, ddl):
        return sorted({r["table_name"] for r in read(spark, tmp_path, name, ddl).collect()})

    assert status(both) == "Fail"
    assert names("stats", STATS_SCHEMA) == names("validation", JUDGED_SCHEMA) == ["t", "u"]
    _, easy = controls(spark, rules=(("gender", "<=400%", "-500%<->500%"),))
    assert status(asked, easy) == "Pass"  # the other table failed, and is not asked for any more
    assert names("stats", STATS_SCHEMA) == names("validation", JUDGED_SCHEMA) == ["t"]
    assert status(asked.limit(0)) == "Abort" and names("stats", STATS_SCHEMA) == []
    assert status(asked, easy) == "Pass"
    with pytest.raises(ValueError, match="not given: v"):
        status(asked.withColumn("table_name", F.lit("v")))


def test_a_request_for_a_missing_column_aborts(spark, tmp_path):
    with pytest.raises(ValueError):
        run_on(spark, tmp_path, "2024-01-01", 1, ("gender", "NA", 3), ("gone", "NA", 3))
    assert read(spark, tmp_path, "status", STATUS_SCHEMA).first()["status"] == "Abort"


def test_csv_store(spark, tmp_path):
    asked, known = controls(spark, *REQUESTS)
    run = sw.Run(1, 2, 3, 4, "2024-01-01", 1)
    status = sw.run_distribution(observed(spark), "dt", "t", asked, known, run, str(tmp_path), fmt="csv").first()
    assert status["status"] == "Fail"
    assert sw.read_rows(spark, f"{tmp_path}/stats", STATS_SCHEMA, "csv").filter(F.col("column_value") == "m").count() == 1


def test_judge_slice_equals_the_written_run(spark, tmp_path):
    run_on(spark, tmp_path, "2024-01-01", 1, *REQUESTS)
    earlier = read(spark, tmp_path, "stats", STATS_SCHEMA)
    asked, known = controls(spark, *REQUESTS)
    run = sw.Run(1, 2, 3, 4, "2024-01-02", 1, "distribution")
    preview = rows(sw.judge_slice(observed(spark), "dt", "t", asked, known, earlier, run))
    run_on(spark, tmp_path, "2024-01-02", 1, *REQUESTS)
    written = read(spark, tmp_path, "validation", JUDGED_SCHEMA).filter("batch_date = '2024-01-02'")
    assert preview == rows(written.select(*[c.strip().split()[0] for c in JUDGED_SCHEMA.replace("\n", " ").split(",")]))


def run_table(spark, folder, name, rules, *requests):
    asked, known = controls(spark, *requests, rules=rules)
    run = sw.Run(1, 2, 3, 4, "2024-01-01", 1, "distribution")
    asked = asked.withColumn("table_name", F.lit(name))
    return sw.run_distribution(observed(spark), "dt", name, asked, known, run, str(folder)).first()["status"]


def test_two_tables_of_a_run_stay_apart(spark, tmp_path):
    strict, easy = (("gender", "<=-100%", "0%<->0%"),), (("gender", "<=400%", "-500%<->500%"),)
    assert run_table(spark, tmp_path, "t", strict, ("gender", "NA", 0)) == "Fail"
    assert run_table(spark, tmp_path, "u", easy, ("gender", "NA", 0)) == "Fail"  # the first table still fails
    for name, ddl in (("stats", STATS_SCHEMA), ("validation", JUDGED_SCHEMA)):
        assert {r["table_name"] for r in read(spark, tmp_path, name, ddl).collect()} == {"t", "u"}
    assert run_table(spark, tmp_path, "t", easy, ("gender", "NA", 0)) == "Pass"


def test_a_later_try_without_rows_leaves_none_of_the_old_ones(spark, tmp_path):
    assert run_table(spark, tmp_path, "t", (("gender", "<=-100%", "0%<->0%"),), ("gender", "NA", 0)) == "Fail"
    assert run_table(spark, tmp_path, "t", (("gender", "no operator", "0%<->0%"),), ("gender", "NA", 0)) == "Pass"
    assert read(spark, tmp_path, "validation", JUDGED_SCHEMA).count() == 0


def test_an_abort_of_one_table_is_not_hidden_by_another(spark, tmp_path):
    easy = (("gender", "<=400%", "-500%<->500%"),)
    with pytest.raises(ValueError):
        run_table(spark, tmp_path, "t", easy, ("gone", "NA", 0))
    assert run_table(spark, tmp_path, "u", easy, ("gender", "NA", 0)) == "Abort"


def test_a_neighbour_that_passes_the_gate_does_not_change_a_text(spark, tmp_path):
    """On the second day the other decimal has many values and is no longer profiled beside the first."""
    df = spark.sql(
        "SELECT date_add(DATE'2024-01-01', d) AS dt, CAST(0.5 AS DECIMAL(10,2)) AS a, "
        "CAST(IF(d = 0, 1, id) AS DECIMAL(10,4)) AS b FROM range(20) CROSS JOIN (SELECT explode(sequence(0, 1)) AS d)"
    )
    asked, known = controls(spark, ("a", "NA", 3), ("b", "NA", 0), rules=(("a", "<=10%", "-5%<->5%"), ("b", "<=900%", None)))
    for day in ("2024-01-01", "2024-01-02"):
        sw.run_distribution(df, "dt", "t", asked, known, sw.Run(1, 2, 3, 4, day, 1), str(tmp_path))
    judged = read(spark, tmp_path, "validation", JUDGED_SCHEMA).filter("column_name = 'a'")
    assert {(r["column_value"], r["trend_status"]) for r in judged.collect()} == {("0.50", "Pass")}
