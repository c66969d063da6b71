"""Trends over slices, row checks, query checks and merged file sets."""

from __future__ import annotations

from pyspark.sql import functions as F

import slicewise as sw
from slicewise.session import scratch_path

from .common import DAY, registry, table

QUERIES, ORACLES, register = registry()


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


PAST = "RANGE BETWEEN INTERVAL 3 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING"


@register(
    "table_trend",
    f"""WITH daily AS (SELECT CAST(ts AS DATE) AS batch_date, count(*) AS n_rows FROM events GROUP BY 1),
        seen AS (SELECT *, avg(n_rows) OVER (ORDER BY batch_date {PAST}) AS past FROM daily)
        SELECT batch_date, 'events' AS table_name, n_rows, round(past, 6) AS past_average,
               round((n_rows - past) / past * 100, 6) AS change_percentage,
               CASE WHEN past IS NULL THEN NULL WHEN (n_rows - past) / past * 100 BETWEEN -5 AND 5 THEN 'Pass'
                    ELSE 'Fail' END AS status
        FROM seen""",
)
def table_trend(spark, sf_dir):
    trend = sw.table_trend(table(spark, sf_dir, "events"), "ts", "events", look_back=3, band="-5%<->5%")
    return _rounded(trend, "past_average", "change_percentage")


def _column_trend_sql(column: str, kind: str) -> str:
    number = [f"{f}(CAST({column} AS DOUBLE))" if kind == "number" else "CAST(NULL AS DOUBLE)" for f in ("min", "max", "avg")]
    text = [f"{f}({column})" if kind == "text" else "CAST(NULL AS VARCHAR)" for f in ("min", "max")]
    return f"""
      SELECT batch_date, '{column}' AS column_name, count(*) AS n_rows, count(*) - count({column}) AS n_null,
             count(DISTINCT {column}) AS n_distinct, {text[0]} AS min_value, {text[1]} AS max_value,
             {number[0]} AS min_number, {number[1]} AS max_number, {number[2]} AS mean_number,
             CAST(count(*) - count({column}) AS DOUBLE) / count(*) AS null_share
      FROM seen GROUP BY batch_date"""


@register(
    "column_trend",
    f"""WITH seen AS (SELECT CAST(ts AS DATE) AS batch_date, value, user_id, nullif(event_type, 'error') AS known_type
                      FROM events),
        daily AS ({_column_trend_sql('value', 'number')} UNION ALL {_column_trend_sql('user_id', 'number')}
                  UNION ALL {_column_trend_sql('known_type', 'text')})
        SELECT batch_date, column_name, n_rows, n_null, n_distinct, min_value, max_value, min_number, max_number,
               round(mean_number, 6) AS mean_number, round(null_share, 6) AS null_share,
               round(avg(null_share) OVER w, 6) AS past_null_share, round(avg(n_distinct) OVER w, 6) AS past_distinct,
               round(avg(mean_number) OVER w, 6) AS past_mean
        FROM daily WINDOW w AS (PARTITION BY column_name ORDER BY batch_date {PAST})""",
)
def column_trend(spark, sf_dir):
    known = F.expr("nullif(event_type, 'error')").alias("known_type")
    events = table(spark, sf_dir, "events").select("ts", "value", "user_id", known)
    trend = sw.column_trend(events, "ts", ["value", "user_id", "known_type"], look_back=3)
    return _rounded(trend, "mean_number", "null_share", "past_null_share", "past_distinct", "past_mean")


@register(
    "column_value_trend",
    f"""WITH seen AS (SELECT CAST(ts AS DATE) AS batch_date, nullif(event_type, 'error') AS known_type, event_id % 3 AS shard
                      FROM events),
        daily AS (
          SELECT batch_date, 'known_type' AS column_name, known_type AS column_value, count(known_type) AS group_count
          FROM seen GROUP BY batch_date, known_type
          UNION ALL
          SELECT batch_date, 'shard', CAST(shard AS VARCHAR), count(shard) FROM seen GROUP BY batch_date, shard),
        past AS (SELECT *, avg(group_count) OVER (PARTITION BY column_name, column_value ORDER BY batch_date {PAST}) AS p
                 FROM daily)
        SELECT batch_date, column_name, column_value, group_count, round(p, 6) AS past_average,
               round((group_count - p) / nullif(p, 0) * 100, 6) AS change_percentage FROM past""",
)
def column_value_trend(spark, sf_dir):
    known, shard = F.expr("nullif(event_type, 'error')").alias("known_type"), F.expr("event_id % 3").alias("shard")
    events = table(spark, sf_dir, "events").select("ts", known, shard)
    trend = sw.column_value_trend(events, "ts", ["known_type", "shard"], look_back=3)
    return _rounded(trend, "past_average", "change_percentage")


@register(
    "zero_slices",
    "SELECT CAST(d AS DATE) AS slice_date FROM generate_series(DATE '2023-12-28', DATE '2024-02-03', INTERVAL 1 DAY) s(d) "
    "WHERE CAST(d AS DATE) NOT IN (SELECT CAST(ts AS DATE) FROM events)",
)
def zero_slices(spark, sf_dir):
    return sw.zero_slices(table(spark, sf_dir, "events"), "ts", "2023-12-28", "2024-02-03")


@register(
    "custom_query",
    f"SELECT count(*) AS n_violations, CASE WHEN count(*) = 0 THEN 'Pass' ELSE 'Fail' END AS status FROM events "
    f"WHERE CAST(ts AS DATE) = DATE '{DAY}' AND value > 250",
)
def custom_query(spark, sf_dir):
    text = "SELECT event_id FROM observed WHERE CAST(ts AS DATE) = :batch_date AND value > 250"
    return sw.custom_query(spark, text, DAY, {"observed": table(spark, sf_dir, "events")})


def _check_sql(no: int, kind: str, column: str, violated: str) -> str:
    return (
        f"SELECT {no} AS check_no, '{kind}' AS check_name, '{column}' AS column_name, count(*) AS table_count, "
        f"count(*) FILTER (WHERE {violated}) AS failing_rows FROM rows_seen"
    )


SOME_SEGMENT = "nullif(c_mktsegment, 'BUILDING')"


@register(
    "dq_checks",
    f"WITH rows_seen AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, {SOME_SEGMENT} AS segment FROM customer), checked AS ("
    + " UNION ALL ".join(
        [
            _check_sql(0, "not_null", "segment", "segment IS NULL"),
            _check_sql(1, "unique", "c_custkey", "c_custkey IN (SELECT c_custkey FROM rows_seen GROUP BY 1 HAVING count(*) > 1)"),
            _check_sql(2, "unique", "segment", "segment IN (SELECT segment FROM rows_seen GROUP BY 1 HAVING count(*) > 1)"),
            _check_sql(3, "in_set", "segment", "segment NOT IN ('AUTOMOBILE', 'MACHINERY')"),
            _check_sql(4, "in_range", "c_acctbal", "c_acctbal NOT BETWEEN 0 AND 9000"),
            _check_sql(5, "matches", "c_name", "NOT regexp_matches(c_name, '^Customer.*[0-4]$')"),
            _check_sql(6, "not_null", "c_nationkey", "c_nationkey IS NULL"),
        ]
    )
    + ") SELECT *, round(CAST(failing_rows AS DOUBLE) / table_count * 100, 6) AS failing_percentage, "
    "CASE WHEN failing_rows = 0 THEN 'Pass' ELSE 'Fail' END AS status FROM checked",
)
def dq_checks(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").withColumn("segment", F.expr(SOME_SEGMENT))
    checks = [
        sw.not_null("segment"),
        sw.unique("c_custkey"),
        sw.unique("segment"),
        sw.in_set("segment", "AUTOMOBILE", "MACHINERY"),
        sw.in_range("c_acctbal", 0, 9000),
        sw.matches("c_name", "^Customer.*[0-4]$"),
        sw.not_null("c_nationkey"),
    ]
    return _rounded(sw.dq_checks(customers, checks), "failing_percentage")


MERGED_SQL = (
    "SELECT o_orderkey, o_custkey, o_totalprice, CAST(NULL AS VARCHAR) AS o_orderpriority FROM orders "
    "WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey, NULL, NULL, o_orderpriority FROM orders WHERE o_orderstatus <> 'F'"
)


def _two_sets(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return (
        orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_totalprice"),
        orders.filter("o_orderstatus <> 'F'").select("o_orderkey", "o_orderpriority"),
    )


@register("merge_frames", MERGED_SQL)
def merge_frames(spark, sf_dir):
    return sw.merge_frames(list(_two_sets(spark, sf_dir)))


@register("merge_files", f"SELECT fmt, m.* FROM (VALUES ('parquet'), ('orc'), ('json'), ('csv')) AS f(fmt), ({MERGED_SQL}) m")
def merge_files(spark, sf_dir):
    """Two file sets with different columns, merged from each format."""
    merged = []
    for fmt in ("parquet", "orc", "json", "csv"):
        paths = [scratch_path(spark, f"merge-{fmt}") for _ in range(2)]
        for rows, path in zip(_two_sets(spark, sf_dir), paths):
            rows.write.format(fmt).option("header", "true").save(path)
        files = sw.merge_files(spark, paths, fmt)
        merged.append(
            files.select(
                F.lit(fmt).alias("fmt"),
                F.col("o_orderkey").cast("bigint"),
                F.col("o_custkey").cast("bigint"),
                F.col("o_totalprice").cast("double"),
                "o_orderpriority",
            )
        )
    return sw.merge_frames(merged)
