import pytest
from conftest import plan, rows

import slicewise as sw


def test_input_order(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 1000, numPartitions=7).write.parquet(path)
    df = spark.read.parquet(path)
    found = sw.row_index(df)
    want = {r["id"]: i for i, r in enumerate(df.collect(), start=1)}
    assert {r["id"]: r["row_index"] for r in found.collect()} == want


def test_by_key(spark):
    df = spark.range(0, 5000, numPartitions=9).selectExpr("(id * 7919) % 5000 AS k")
    found = {r["k"]: r["row_index"] for r in sw.row_index(df, order_by=["k"]).collect()}
    assert found == {k: k + 1 for k in range(5000)}


def test_hot_key_is_spread_over_partitions(spark):
    df = spark.range(0, 30000, numPartitions=6).selectExpr("CASE WHEN id % 3 < 2 THEN 5 ELSE id END AS k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = sw.row_index(df, order_by=["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = [tuple(r) for r in found.select("k", "row_index").collect()]
    assert sorted(i for _, i in got) == list(range(1, 30001))
    by_index = [k for k, _ in sorted(got, key=lambda t: t[1])]
    assert by_index == sorted(by_index)
    hot = found.selectExpr("k", "spark_partition_id() AS p").filter("k = 5").select("p").distinct().count()
    assert hot > 1


def test_an_input_whose_partitions_change_is_settled(spark):
    df = spark.range(100).repartition(5)
    assert sorted(r["row_index"] for r in sw.row_index(df).collect()) == list(range(1, 101))


def test_empty(spark):
    assert sw.row_index(spark.range(0)).count() == 0


def test_no_window_and_no_shuffle(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select("o_orderkey")
    physical = plan(sw.row_index(df)).split("== Physical Plan ==")[1]
    assert "Window" not in physical and "hashpartitioning" not in physical and "SinglePartition" not in physical
    assert rows(sw.row_index(df).selectExpr("max(row_index)"))[0][0] == df.count()


def test_two_reads_in_different_partitions(spark, tmp_path):
    """Between numbering and use, files are dealt out in other partitions."""
    spark.range(5000).repartition(8).write.parquet(str(tmp_path / "t"))
    numbered = sw.row_index(spark.read.parquet(str(tmp_path / "t")))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        assert sorted(r["row_index"] for r in numbered.collect()) == list(range(1, 5001))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_wide_rows_by_key_copy_only_the_keys(spark, monkeypatch):
    """What is checkpointed holds the key and the tie; the other columns are joined, whatever they hold."""
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    seen, checkpoint = [], type(orders).checkpoint
    monkeypatch.setattr(type(orders), "checkpoint", lambda self, *a, **b: seen.append(self.columns) or checkpoint(self, *a, **b))
    found = sw.row_index(orders, order_by=["o_orderdate"], tie=["o_orderkey"])
    assert seen == [["o_orderdate", "o_orderkey"]] and found.columns == [*orders.columns, "row_index"]
    got = sorted(found.collect(), key=lambda r: r.row_index)
    assert [r.row_index for r in got] == list(range(1, orders.count() + 1))
    assert [tuple(r)[:-1] for r in got] == sorted(map(tuple, orders.collect()), key=lambda r: (r[4], r[0]))


def test_keys_with_nulls_and_shared_keys(spark):
    df = spark.createDataFrame([(None, 1, "a"), (2, None, "b"), (None, None, "c"), (2, 1, "d")], "k int, t int, x string")
    found = sw.row_index(df, order_by=["k"], tie=["t"]).collect()
    assert [r.x for r in sorted(found, key=lambda r: r.row_index)] == ["c", "a", "b", "d"]
    with pytest.raises(ValueError, match="share the key k"):
        sw.row_index(df, order_by=["k"], tie=[])
    index = sw.key_index(df, ["k"])
    assert index.columns == ["k", "row_index"] and sorted(r.row_index for r in index.collect()) == [1, 2, 3, 4]
