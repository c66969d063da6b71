import json

import pytest
from conftest import plan, rows

import slicewise as sw
from slicewise.layout import STATUS_SCHEMA, VALIDATION_SCHEMA


def side(spark, *data, ddl="a int, b string"):
    return spark.createDataFrame(list(data), ddl)


def test_counts(spark):
    one, two = side(spark, (1, "x")), side(spark, (1, "x"), (2, "y"))
    found = rows(sw.shape_parity({"p": one, "q": two}), "check_name", "side_counts", "status")
    assert found == [("Column Count", "2||2", "Pass"), ("Record Count", "1||2", "Fail")]
    assert rows(sw.shape_parity({"p": two, "q": two, "r": two}), "status") == [("Pass",), ("Pass",)]


def test_a_missing_side_fails(spark):
    found = rows(sw.shape_parity({"p": side(spark, (1, "x")), "q": None}), "check_name", "side_counts", "status")
    assert found == [("Column Count", "2||NA", "Fail"), ("Record Count", "1||NA", "Fail")]


def test_counting_reads_no_column(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    assert "ReadSchema: struct<>" in plan(sw.side_shapes({"p": df}))


def test_cells_are_held_against_the_last_side(spark):
    small, large = side(spark, (1, "x")), side(spark, (1, "x"), (2, "y"))
    assert sw.result_set_parity({"p": small, "q": large}).first()["status"] == "Pass"
    assert sw.result_set_parity({"p": large, "q": small}).first()["status"] == "Fail"


def test_place_and_number_of_cells_do_not_matter(spark):
    left, right = side(spark, (1, "x"), (1, "x")), side(spark, ("x", 1), ddl="a string, b bigint")
    assert tuple(sw.result_set_parity({"p": left, "q": right}).first()) == (2, 2, "Pass")


def test_null_is_a_cell(spark):
    with_null, without = side(spark, (1, None)), side(spark, (1, "x"))
    assert sw.result_set_parity({"p": with_null, "q": without}).first()["status"] == "Fail"
    assert sw.result_set_parity({"p": with_null, "q": with_null}).first()["status"] == "Pass"


def test_empty_sides_agree(spark):
    none = side(spark)
    assert sw.result_set_parity({"p": none, "q": none}).first()["status"] == "Pass"


def test_limit_takes_the_first_rows_in_order(spark):
    many, few = side(spark, (3, "z"), (1, "x"), (2, "y")), side(spark, (1, "x"), (2, "y"))
    assert sw.result_set_parity({"p": many, "q": few}, limit=2).first()["status"] == "Pass"
    assert sw.result_set_parity({"p": many, "q": few}).first()["status"] == "Fail"


def test_json(spark):
    sides = {"p": side(spark, (10, "z"), (9, 'q"'), (None, "n")), "q": side(spark, (1, "x"))}
    text = sw.result_json(sides, limit=3).first()["result"]
    left, right = text.split("|||")
    assert [json.loads(r) for r in left.split(";")] == [{"b": "n"}, {"a": 9, "b": 'q"'}, {"a": 10, "b": "z"}]
    assert json.loads(right) == {"a": 1, "b": "x"}
    with pytest.raises(ValueError):
        sw.result_json(sides, limit=0)


def test_scenario_rows(spark, tmp_path):
    run = sw.Run(1, 2, 3, 4, "2024-01-05", 1, "cross")
    sides = {"p": side(spark, (1, "x")), "q": side(spark, (1, "x"), (2, "y"))}
    validation = sw.shape_validation(sides, run)
    assert rows(validation, "table_name", "check_name", "comments", "status") == [
        ("p|||q", "Column Count", "2||2", "Pass"),
        ("p|||q", "Record Count", "1||2", "Fail"),
    ]
    assert sw.run_parity(validation, run, str(tmp_path)).first()["status"] == "Fail"
    # The other check of the run still fails.
    later = sw.run_parity(sw.shape_validation(sides, run, check_id=3), run, str(tmp_path)).first()
    assert later["status"] == "Fail" and later["start_time"] and later["end_time"]
    kept = sw.read_rows(spark, f"{tmp_path}/validation", VALIDATION_SCHEMA)
    assert rows(kept, "check_name", "status") == [("Column Count", "Pass"), ("Record Count", "Fail")]
    again = {"p": sides["q"], "q": sides["q"]}
    assert sw.run_parity(sw.shape_validation(again, run), run, str(tmp_path)).first()["status"] == "Pass"
    result = sw.result_validation(sides, run, limit=1)
    assert rows(result, "status", "comments") == [("Pass", '{"a":1,"b":"x"}|||{"a":1,"b":"x"}')]


def test_a_column_check_reads_no_side(spark):
    sides = {"p": side(spark, (1, "x")), "q": spark.range(3)}
    assert "Range (0, 3" not in plan(sw.shape_parity(sides, ("Column Count",)))
    assert rows(sw.shape_parity(sides, ("Column Count",)), "side_counts", "status") == [("2||1", "Fail")]


def parity_requests(spark, *asked):
    names = "table_name string, check_id int, date_partition_columns string, filter_condition string"
    df = spark.createDataFrame(list(asked), names)
    return df.selectExpr("1 AS project_id", "3 AS pipeline_id", "4 AS scenario_id", "*")


def test_requests_drive_all_checks_of_a_run(spark, tmp_path):
    run = sw.Run(1, 2, 3, 4, "2024-01-05", 1, "cross")
    tables = {"t": {"p": side(spark, (1, "x"), (2, "y")), "q": side(spark, (1, "x"))}}
    asked = parity_requests(spark, ("t", 12, "NA", "NA"), ("t", 3, "NA", "NA"), ("t", 20, None, "1"))
    assert sw.run_parity_requests(asked, tables, run, str(tmp_path)).first()["status"] == "Fail"
    kept = sw.read_rows(spark, f"{tmp_path}/validation", VALIDATION_SCHEMA)
    assert rows(kept, "check_id", "status") == [("12", "Fail"), ("20", "Pass"), ("3", "Pass")]
    with pytest.raises(ValueError):
        sw.run_parity_requests(parity_requests(spark, ("u", 3, "NA", "NA")), tables, run, str(tmp_path))
    status = sw.read_rows(spark, f"{tmp_path}/status", STATUS_SCHEMA).first()
    assert (status["status"], status["comments"]) == ("Abort", "no sides for u")


def test_checks_no_longer_asked_for_are_taken_back(spark, tmp_path):
    run = sw.Run(1, 2, 3, 4, "2024-01-05", 1, "cross")
    other = sw.Run(1, 2, 3, 4, "2024-01-05", 2, "cross")
    tables = {"t": {"p": side(spark, (1, "x"), (2, "y")), "q": side(spark, (1, "x"))}}
    both = parity_requests(spark, ("t", 12, "NA", "NA"), ("t", 5, "NA", "NA"))
    for each in (run, other):
        assert sw.run_parity_requests(both, tables, each, str(tmp_path)).first()["status"] == "Fail"
    fewer = parity_requests(spark, ("t", 5, "NA", "NA"))
    assert sw.run_parity_requests(fewer, tables, run, str(tmp_path)).first()["status"] == "Pass"
    kept = sw.read_rows(spark, f"{tmp_path}/validation", VALIDATION_SCHEMA)
    assert rows(kept, "batch_sequence", "check_id", "status") == [(1, "5", "Pass"), (2, "12", "Fail"), (2, "5", "Pass")]
    assert [(p.check_name, s) for p, s in sw.read_manifest(spark, str(tmp_path), run).items()] == [("Column Count", "judged")]
    # A try that broke off after its rows were written left them in the manifest; the next one takes them back.
    assert sw.run_parity_requests(both, tables, run, str(tmp_path)).first()["status"] == "Fail"
    none = sw.run_parity_requests(both.limit(0), tables, run, str(tmp_path)).first()
    kept = sw.read_rows(spark, f"{tmp_path}/validation", VALIDATION_SCHEMA)
    assert none["status"] == "Abort" and kept.filter("batch_sequence = 1").count() == 0
