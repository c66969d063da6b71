"""Plans of the registered queries: no product joins, no Python in the data path, single tasks only over aggregates."""

import re

import pytest
from conftest import SMALL, plan

import slicewise as sw
from catalogue import QUERIES
from slicewise.operators import requests
from slicewise.operators.profiles import ends_of


def physical(df) -> str:
    text = plan(df)
    return text[text.index("== Physical Plan ==") :]


@pytest.mark.parametrize("name", QUERIES)
def test_no_product_join_and_no_python(spark, name):
    text = physical(QUERIES[name](spark, SMALL))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInArrow", "MapInPandas"):
        assert banned not in text




@pytest.mark.parametrize("name", ["column_profile", "bounded_histogram", "shape_parity", "table_count", "dq_checks"])
def test_single_tasks_take_aggregated_rows_only(spark, name):
    text = physical(QUERIES[name](spark, SMALL))
    for part in re.split(r"(?=Exchange SinglePartition)", text)[1:]:
        assert "Aggregate" in part.splitlines()[1]


def test_windows_run_over_groups(spark):
    """Below the windows of the trends and of the gate lies an aggregate, not the table."""
    for name in ("table_trend", "column_trend", "column_value_trend", "gated_profile"):
        text = physical(QUERIES[name](spark, SMALL))
        assert "Window" in text and "Aggregate" in text[text.index("Window") :]


def test_scans_read_only_what_is_used(spark):
    lineitem = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    text = physical(sw.multi_column_profile(lineitem, ["l_returnflag", "l_quantity"]))
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string>" in text
    assert text.count("FileScan") == 2 and "ReadSchema: struct<>" in text


def test_gate_reads_open_columns_only_in_its_second_scan(spark):
    lineitem = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    text = physical(sw.gated_profile(lineitem, ["l_returnflag", "l_orderkey", "l_extendedprice"]))
    assert text.count("FileScan") == 1 and "ReadSchema: struct<l_returnflag:string>" in text


def test_numeric_aggregates_are_generated_code(spark):
    lineitem = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    text = physical(sw.column_profile(lineitem, ["l_quantity", "l_orderkey"]))
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text


def test_small_control_tables_are_broadcast(spark):
    text = physical(QUERIES["request_profile"](spark, SMALL))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_many_requests_need_no_join_of_cells(spark):
    """20,001 requests: cells, one row each, go into the aggregate without a shuffle or a join, and none is sorted."""
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet").selectExpr("CAST(l_orderkey AS STRING) AS t", "l_orderkey", "l_quantity")
    asked = spark.range(20_000).selectExpr(
        "CASE id % 3 WHEN 0 THEN 't' WHEN 1 THEN 'l_orderkey' ELSE 'l_quantity' END AS column_name",
        "concat(id, '<->', id + 1, '<->NA') AS additional_info",
    ).unionByName(spark.createDataFrame([("l_orderkey", "0<->9000<->50")], "column_name string, additional_info string"))
    wanted = requests.read_requests(lines, asked, False)
    assert len(wanted) == 20_001
    cuts = [requests.Cuts(c, lane, wanted) for c, lane in (("t", "text"), ("l_orderkey", "whole"), ("l_quantity", "real"))]
    for part in (cuts[:1], cuts[1:]):
        lanes = [cut.lane for cut in part]
        sums = requests._cells(lines, part).groupBy("column_no", "segment").agg(*[e for lane in lanes for e in ends_of(lane)])
        text = physical(sums)
        assert text.count("Generate stack") == 1 and "Join" not in text and "Sort" not in text
        below = text[text.rindex("Exchange") :]
        assert "Exchange" not in below[8:] and "Aggregate" in below
    found = sw.request_profile(lines, asked)
    assert "SortMergeJoin" not in physical(found)
    assert found.filter("additional_info = '0<->9000<->50' AND stat_kind = 'range'").count() > 20


def test_text_requests_sort_no_cells(spark):
    lineitem = spark.read.parquet(f"{SMALL}/lineitem.parquet").selectExpr("CAST(l_orderkey AS STRING) AS t", "l_quantity")
    asked = spark.createDataFrame([("t", "NA"), ("t", "1<->5<->1")], "column_name string, additional_info string")
    text = physical(sw.request_profile(lineitem, asked))
    assert not re.search(r"\bSort \[request_no", text)


@pytest.mark.parametrize("exact", [True, False])
def test_trends_of_text_sort_no_cells(spark, exact):
    """Extremes of text are kept in hash maps; the one sort is that of the daily rows, for the window."""
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    text = physical(sw.column_trend(events, "ts", ["event_type", "value", "props"], 3, exact_distinct=exact))
    assert "SortAggregate" not in text and "ObjectHashAggregate" in text and text.count("Sort [") == 1


def test_file_profiles_sort_no_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("h\n1\n")
    text = physical(sw.file_profile(spark, str(tmp_path), "1"))
    aggregate = text[text.index("ObjectHashAggregate") :]
    assert "SortAggregate" not in text and "Sort [" not in aggregate[: aggregate.index("FileScan text")]


def test_past_window_prunes_folders(spark, tmp_path):
    from slicewise.layout import STATS_SCHEMA
    from slicewise.operators.verdicts import past_for_settings
    from test_verdicts import settings, two_days

    path = str(tmp_path / "h")
    sw.write_rows(two_days(spark), path)
    history = sw.read_rows(spark, path, STATS_SCHEMA)
    past = past_for_settings(history, settings(spark, ("c", 3, "<=10%", "0%<->0%")), "2024-01-05")
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        scan = next(line for line in physical(past).splitlines() if "FileScan" in line)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    found = scan[scan.index("PartitionFilters") : scan.index("PushedFilters")]
    assert "<= 2024-01-05" in found and ">= date_sub(2024-01-05, " in found
