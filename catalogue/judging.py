"""History, comparison with the past, rules and verdicts."""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

import slicewise as sw
from slicewise.layout import STATS_SCHEMA
from slicewise.operators.history import SCOPE
from slicewise.operators.verdicts import (
    JUDGED_SCHEMA,
    column_settings,
    past_for_settings,
    rule_status,
    validation_rows,
)
from slicewise.session import scratch_path

from .common import (
    DAY,
    DAY_BEFORE,
    HISTORY_SQL,
    REQUEST_ROWS,
    RULES,
    RUN,
    Rule,
    events_history,
    judged_events,
    registry,
    requests,
    rules,
    table,
)

QUERIES, ORACLES, register = registry()
D = f"DATE '{DAY}'"


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


HISTORY_COLUMNS = ["batch_date", "column_name", "column_value", "table_count", "error_records_count"]


def _written(spark, sf_dir, fmt):
    path = scratch_path(spark, f"history-{fmt}")
    stats = events_history(spark, sf_dir)
    sw.write_rows(stats, path, fmt)
    sw.write_rows(stats, path, fmt)
    return sw.read_rows(spark, path, STATS_SCHEMA, fmt).select(F.lit(fmt).alias("fmt"), *HISTORY_COLUMNS)


@register(
    "history_roundtrip",
    f"WITH {HISTORY_SQL} SELECT fmt, batch_date, column_name, column_value, table_count, n AS error_records_count "
    "FROM history, (VALUES ('parquet'), ('csv'), ('orc'), ('json')) AS f(fmt)",
)
def history_roundtrip(spark, sf_dir):
    """Written twice in each format; a run that is written again must not double."""
    return sw.merge_frames([_written(spark, sf_dir, fmt) for fmt in ("parquet", "csv", "orc", "json")])


@register(
    "history_append",
    f"WITH {HISTORY_SQL} SELECT batch_date, count(*) * 2 AS n, CAST(sum(n) * 2 AS BIGINT) AS total FROM history GROUP BY batch_date",
)
def history_append(spark, sf_dir):
    """A plain append keeps both copies."""
    path = scratch_path(spark, "history-append")
    stats = events_history(spark, sf_dir)
    for _ in range(2):
        sw.write_rows(stats, path, replace_runs=False)
    kept = sw.read_rows(spark, path, STATS_SCHEMA)
    return kept.groupBy("batch_date").agg(F.count("*").alias("n"), F.sum("error_records_count").alias("total"))


def _past_sql(days: int = 5) -> str:
    return (
        "SELECT column_name, column_value, CAST(trunc(avg(table_count)) AS BIGINT) AS past_table_count, "
        "CAST(trunc(avg(n)) AS BIGINT) AS past_count FROM history "
        f"WHERE batch_date BETWEEN {D} - {days} AND {D} GROUP BY column_name, column_value"
    )


@register("history_average", f"WITH {HISTORY_SQL} {_past_sql()}")
def history_average(spark, sf_dir):
    past = sw.history_average(events_history(spark, sf_dir), DAY, 5)
    return past.drop("table_name", "stat_kind", "filter_condition")


@register("history_average_newest", f"WITH {HISTORY_SQL} {_past_sql()}")
def history_average_newest(spark, sf_dir):
    """An older run of the same dates, with other counts, must not show."""
    newest = events_history(spark, sf_dir)
    older = newest.withColumns({"batch_sequence": F.lit(0), "error_records_count": F.col("error_records_count") * 3})
    return sw.history_average(older.unionByName(newest), DAY, 5, runs="newest").drop("table_name", "stat_kind", "filter_condition")


COMPARED_SQL = f"""
    WITH {HISTORY_SQL},
    past AS ({_past_sql()}),
    today AS (SELECT column_name, column_value, table_count, n FROM history WHERE batch_date = {D}),
    compared AS (
      SELECT coalesce(t.column_name, p.column_name) AS column_name, t.column_value,
             p.column_value AS past_column_value, coalesce(t.table_count, 0) AS table_count,
             coalesce(t.n, 0) AS error_records_count, coalesce(p.past_table_count, 0) AS past_table_count,
             coalesce(p.past_count, 0) AS past_count
      FROM today t FULL OUTER JOIN past p ON t.column_name = p.column_name AND t.column_value = p.column_value)
"""


def _compared(spark, sf_dir):
    history = events_history(spark, sf_dir)
    today = sw.current_stats(history, DAY, RUN.batch_sequence)
    return sw.trend_compare(today, sw.history_average(history, DAY, 5)).drop("table_name", "stat_kind")


@register("trend_compare", f"{COMPARED_SQL} SELECT * FROM compared")
def trend_compare(spark, sf_dir):
    return _compared(spark, sf_dir)


POINT_SQL = "(CAST(table_count - {n} AS DOUBLE) / nullif({n}, 0)) * 100"
TREND_SQL = "CAST((error_records_count - table_count) * 100 AS DOUBLE) / nullif(table_count, 0)"
AVERAGE_SQL = "(CAST(past_table_count - past_count AS DOUBLE) / nullif(past_count, 0)) * 100"
CHANGE_SQL = "(CAST(error_records_count - past_count AS DOUBLE) / nullif(past_count, 0)) * 100"


@register(
    "point_gap",
    f"WITH {HISTORY_SQL} SELECT column_name, column_value, table_count, n AS error_records_count, "
    f"round({POINT_SQL.format(n='n')}, 6) AS error_percentage FROM history WHERE batch_date = {D}",
)
def point_gap(spark, sf_dir):
    today = sw.current_stats(events_history(spark, sf_dir), DAY, RUN.batch_sequence)
    fields = ["column_name", "column_value", "table_count", "error_records_count", "error_percentage"]
    return _rounded(sw.with_point_gap(today).select(*fields), "error_percentage")


GAPS_SQL = (
    f"SELECT *, round({TREND_SQL}, 6) AS error_percentage, round({AVERAGE_SQL}, 6) AS average_error_percentage, "
    f"round({CHANGE_SQL}, 6) AS change_percentage"
)
GAPS = ["error_percentage", "average_error_percentage", "change_percentage"]


@register("trend_gap", f"{COMPARED_SQL} {GAPS_SQL} FROM compared")
def trend_gap(spark, sf_dir):
    return _rounded(sw.with_trend_gaps(_compared(spark, sf_dir)), *GAPS)


@register(
    "trend_band",
    f"{COMPARED_SQL} {GAPS_SQL}, CASE WHEN {AVERAGE_SQL} BETWEEN -15 AND 400 THEN 'Pass' ELSE 'Fail' END AS trend_status "
    "FROM compared",
)
def trend_band(spark, sf_dir):
    gaps = sw.with_trend_gaps(_compared(spark, sf_dir))
    return _rounded(sw.with_trend_status(gaps, F.lit("-15%<->400%")), *GAPS)


def _verdict_sql(rule: Rule, gap: str) -> str:
    return f"CASE WHEN {gap} {rule.compare} {rule.limit} THEN 'Pass' ELSE 'Fail' END"


TODAY_GATED_SQL = f"""
    few AS (SELECT column_name FROM history WHERE batch_date = {D} GROUP BY column_name HAVING count(*) < 5),
    gated AS (
      SELECT *, 'value' AS kind FROM history WHERE batch_date = {D} AND column_name IN (SELECT column_name FROM few)
      UNION ALL
      SELECT DISTINCT batch_date, column_name, CAST(NULL AS VARCHAR), table_count, table_count, 'column' FROM history
      WHERE batch_date = {D} AND column_name NOT IN (SELECT column_name FROM few))
"""
# The stored history in three states: value rows of all days; the same with today gated; today alone, gated.
STORED_ALL = "stored AS (SELECT *, 'value' AS kind FROM history)"
STORED_GATED = (
    f"{TODAY_GATED_SQL}, stored AS (SELECT *, 'value' AS kind FROM history WHERE batch_date < {D} "
    "UNION ALL SELECT * FROM gated)"
)
STORED_TODAY = f"{TODAY_GATED_SQL}, stored AS (SELECT * FROM gated)"


def _judged_sql(stored: str = STORED_ALL) -> str:
    """One select per column: its own look-back, its rule written out."""
    rule_of = {rule.column: rule for rule in RULES}
    parts = []
    for column, _, days in REQUEST_ROWS:
        rule = rule_of[column]
        today = f"SELECT * FROM stored WHERE batch_date = {D} AND column_name = '{column}'"
        if days > 0:
            past = (
                "SELECT column_name, column_value, kind, CAST(trunc(avg(table_count)) AS BIGINT) AS past_table_count, "
                f"CAST(trunc(avg(n)) AS BIGINT) AS past_count FROM stored WHERE column_name = '{column}' "
                f"AND batch_date BETWEEN {D} - {days} AND {D} GROUP BY column_name, column_value, kind"
            )
            parts.append(f"""
              SELECT column_name, column_value, past_column_value, table_count, error_records_count,
                     round({TREND_SQL}, 6) AS error_percentage, '{rule.text}' AS threshold_percentage,
                     {_verdict_sql(rule, f"({TREND_SQL})")} AS status, past_table_count AS average_table_count,
                     past_count AS average_error_records_count,
                     CAST(trunc({AVERAGE_SQL}) AS BIGINT) AS average_error_percentage,
                     '{rule.band}' AS trend_threshold_percentage,
                     CASE WHEN {AVERAGE_SQL} BETWEEN {rule.low} AND {rule.high} THEN 'Pass' ELSE 'Fail' END AS trend_status
              FROM (SELECT coalesce(t.column_name, p.column_name) AS column_name, t.column_value,
                           p.column_value AS past_column_value,
                           coalesce(t.table_count, 0) AS table_count, coalesce(t.n, 0) AS error_records_count,
                           coalesce(p.past_table_count, 0) AS past_table_count, coalesce(p.past_count, 0) AS past_count
                    FROM ({today}) t FULL OUTER JOIN ({past}) p
                    ON t.kind = p.kind AND (t.kind = 'column' OR t.column_value = p.column_value)) j""")
        else:
            gap = POINT_SQL.format(n="n")
            parts.append(f"""
              SELECT column_name, column_value, NULL, table_count, n, round({gap}, 6), '{rule.text}',
                     {_verdict_sql(rule, f"({gap})")}, NULL, NULL, NULL, NULL, NULL
              FROM ({today}) t""")
    return f"WITH {HISTORY_SQL}, {stored}, judged_rows AS ({' UNION ALL '.join(parts)})"


JUDGED = [
    "column_name",
    "column_value",
    "past_column_value",
    "table_count",
    "error_records_count",
    "error_percentage",
    "threshold_percentage",
    "status",
    "average_table_count",
    "average_error_records_count",
    "average_error_percentage",
    "trend_threshold_percentage",
    "trend_status",
]


def _validation(spark, sf_dir):
    history, settings = events_history(spark, sf_dir), column_settings(requests(spark), rules(spark))
    today = sw.current_stats(history, DAY, RUN.batch_sequence)
    return validation_rows(rule_status(today, past_for_settings(history, settings, DAY), settings), RUN)


@register("rule_status", f"{_judged_sql()} SELECT * FROM judged_rows")
def rule_status_query(spark, sf_dir):
    return _rounded(_validation(spark, sf_dir).select(*JUDGED), "error_percentage")


@register(
    "scenario_status",
    f"{_judged_sql()} SELECT 7 AS scenario_id, {D} AS batch_date, 1 AS batch_seq_id, "
    "CASE WHEN count(*) FILTER (WHERE status = 'Fail' OR trend_status = 'Fail') > 0 THEN 'Fail' ELSE 'Pass' END AS status "
    "FROM judged_rows",
)
def scenario_status(spark, sf_dir):
    rows = sw.scenario_status(_validation(spark, sf_dir))
    return rows.select("scenario_id", "batch_date", "batch_seq_id", "status")


@register(
    "run_verdict",
    f"""{_judged_sql()}, per_column AS (
          SELECT column_name, CASE WHEN count(*) FILTER (WHERE status = 'Fail' OR trend_status = 'Fail') > 0
                                   THEN 'Fail' ELSE 'Pass' END AS status FROM judged_rows GROUP BY column_name)
        SELECT CASE WHEN count(*) = 0 OR count(*) FILTER (WHERE status IN ('Abort', 'Fail')) > 0 THEN 'fail'
                    WHEN count(*) FILTER (WHERE status <> 'Pass') = 0 THEN 'pass' END AS verdict,
               count(DISTINCT status) AS n_statuses
        FROM per_column""",
)
def run_verdict(spark, sf_dir):
    """Each column stands for a scenario of its own."""
    validation = _validation(spark, sf_dir).withColumn("scenario_name", F.col("column_name"))
    return sw.run_verdict(sw.scenario_status(validation))


@register("judge_slice", f"{_judged_sql(STORED_GATED)} SELECT * FROM judged_rows")
def judge_slice(spark, sf_dir):
    """Requests to verdicts in one plan, the history being the daily statistics before the batch date."""
    earlier = events_history(spark, sf_dir).filter(F.col("batch_date") < F.lit(DAY).cast("date"))
    observed = judged_events(spark, sf_dir)
    judged = sw.judge_slice(observed, "ts", "events", requests(spark), rules(spark), earlier, RUN)
    return _rounded(judged.select(*JUDGED), "error_percentage")


@register(
    "distribution_run",
    f"{_judged_sql(STORED_TODAY)} SELECT 7 AS scenario_id, 'daily events' AS scenario_name, {D} AS batch_date, "
    "1 AS batch_seq_id, CASE WHEN count(*) FILTER (WHERE status = 'Fail' OR trend_status = 'Fail') > 0 THEN 'Fail' "
    "ELSE 'Pass' END AS status FROM judged_rows",
)
def distribution_run(spark, sf_dir):
    """The scenario with its three written tables; the status row of the run."""
    folder = scratch_path(spark, "distribution")
    status = sw.run_distribution(judged_events(spark, sf_dir), "ts", "events", requests(spark), rules(spark), RUN, folder)
    return status.select("scenario_id", "scenario_name", "batch_date", "batch_seq_id", "status")


@register(
    "distribution_run_two_tables",
    f"{_judged_sql(STORED_TODAY)} SELECT t.table_name, judged_rows.* FROM judged_rows, "
    "(VALUES ('events'), ('more events')) AS t(table_name)",
)
def distribution_run_two_tables(spark, sf_dir):
    """Two tables under one run, the first of them twice: the validation rows of both."""
    folder, observed = scratch_path(spark, "distribution"), judged_events(spark, sf_dir)
    asked = requests(spark)
    asked = asked.unionByName(asked.withColumn("table_name", F.lit("more events")))
    for name in ("events", "more events", "events"):
        sw.run_distribution(observed, "ts", name, asked, rules(spark), RUN, folder)
    judged = sw.read_rows(spark, f"{folder}/validation", JUDGED_SCHEMA)
    return _rounded(judged.select("table_name", *JUDGED), "error_percentage")


@register(
    "distribution_run_fewer_tables",
    f"{_judged_sql(STORED_TODAY)}, s AS (SELECT CASE WHEN count(*) FILTER (WHERE status = 'Fail' OR trend_status = 'Fail') > 0 "
    "THEN 'Fail' ELSE 'Pass' END AS run_status FROM judged_rows) SELECT 'events' AS table_name, s.run_status, judged_rows.* FROM judged_rows, s",
)
def distribution_run_fewer_tables(spark, sf_dir):
    """Control rows of two tables, then of one under the same run: what is left of both result tables."""
    folder, observed = scratch_path(spark, "distribution"), judged_events(spark, sf_dir)
    asked, tables = requests(spark), {"events": (observed, "ts"), "more events": (observed, "ts")}
    both = asked.unionByName(asked.withColumn("table_name", F.lit("more events")))
    for rows in (both, asked):
        status = sw.run_distribution_tables(tables, rows, rules(spark), RUN, folder).first()["status"]
    kept = sw.read_rows(spark, f"{folder}/stats", STATS_SCHEMA).select("table_name").distinct()
    judged = sw.read_rows(spark, f"{folder}/validation", JUDGED_SCHEMA).join(kept, "table_name")
    return _rounded(judged.select("table_name", F.lit(status).alias("run_status"), *JUDGED), "error_percentage")


@register(
    "statistics_after_abort",
    f"WITH {HISTORY_SQL}, {TODAY_GATED_SQL} SELECT 'Abort' AS status, column_name, column_value, table_count AS past_table_count, "
    "n AS past_count FROM gated",
)
def statistics_after_abort(spark, sf_dir):
    """A run that has no rule for its columns ends in Abort once its statistics are written; the averages of later days have them."""
    folder, observed = scratch_path(spark, "distribution"), judged_events(spark, sf_dir)
    status = sw.run_distribution(observed, "ts", "events", requests(spark), rules(spark).limit(0), RUN, folder).first()["status"]
    average = sw.history_average(sw.read_rows(spark, f"{folder}/stats", STATS_SCHEMA), DAY, 5)
    return average.select(F.lit(status).alias("status"), "column_name", "column_value", "past_table_count", "past_count")


BOUNDS = {"0<->49<->50": (0, 49), "0<->199<->100": (0, 199)}


@register(
    "history_average_two_requests",
    " UNION ALL ".join(
        f"""SELECT '{info}' AS filter_condition, CAST(trunc(avg(t)) AS BIGINT) AS past_table_count,
                   CAST(trunc(avg(n)) AS BIGINT) AS past_count
            FROM (SELECT CAST(ts AS DATE) AS d, count(*) AS t, count(*) FILTER (value BETWEEN {low} AND {high}) AS n
                  FROM events WHERE CAST(ts AS DATE) BETWEEN {D} - 1 AND {D} GROUP BY d)"""
        for info, (low, high) in BOUNDS.items()
    ),
)
def history_average_two_requests(spark, sf_dir):
    """Two bounds on one column: each request has a past of its own."""
    asked = spark.sql("SELECT * FROM VALUES " + ", ".join(f"('value', '{b}')" for b in BOUNDS) + " AS t(column_name, additional_info)")
    events, stats = table(spark, sf_dir, "events"), []
    for day in (DAY_BEFORE, DAY):
        profile = sw.request_profile(sw.slice_scan(events, "ts", day), asked)
        stats.append(sw.to_stats(profile, dataclasses.replace(RUN, batch_date=day), "events"))
    average = sw.history_average(stats[0].unionByName(stats[1]), DAY, 1).filter("stat_kind = 'column'")
    return average.select("filter_condition", "past_table_count", "past_count")


@register(
    "threshold_suggest",
    f"WITH {HISTORY_SQL} SELECT column_name, column_value, count(*) AS n_stored, round(avg(n), 6) AS mean_count, "
    "round(stddev_samp(n), 6) AS stddev_count, round(avg(n) - 2.0 * stddev_samp(n), 6) AS suggested_low, "
    "round(avg(n) + 2.0 * stddev_samp(n), 6) AS suggested_high FROM history GROUP BY column_name, column_value",
)
def threshold_suggest(spark, sf_dir):
    bands = sw.threshold_suggest(events_history(spark, sf_dir), spread=2.0).drop("table_name", "stat_kind", "filter_condition", *SCOPE)
    return _rounded(bands, "mean_count", "stddev_count", "suggested_low", "suggested_high")


@register(
    "threshold_suggest_scoped",
    f"WITH {HISTORY_SQL} SELECT project_id, column_name, column_value, count(*) AS n_stored, "
    "round(avg(n * project_id), 6) AS mean_count, round(stddev_samp(n * project_id), 6) AS stddev_count, "
    "round(avg(n * project_id) - 2.0 * stddev_samp(n * project_id), 6) AS suggested_low, "
    "round(avg(n * project_id) + 2.0 * stddev_samp(n * project_id), 6) AS suggested_high "
    "FROM history, (VALUES (1), (5)) AS p(project_id) GROUP BY project_id, column_name, column_value",
)
def threshold_suggest_scoped(spark, sf_dir):
    """Two projects with the same columns, and every date of the first run twice: kept apart, and each date counted once."""
    newest = events_history(spark, sf_dir)
    older = newest.withColumns({"batch_sequence": F.lit(0), "error_records_count": F.col("error_records_count") * 3})
    other = newest.withColumns({"project_id": F.lit(5), "error_records_count": F.col("error_records_count") * 5})
    bands = sw.threshold_suggest(older.unionByName(newest).unionByName(other), spread=2.0, runs="newest")
    fields = ["project_id", "column_name", "column_value", "n_stored", "mean_count", "stddev_count", "suggested_low", "suggested_high"]
    return _rounded(bands.select(*fields), "mean_count", "stddev_count", "suggested_low", "suggested_high")
