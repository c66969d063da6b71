"""Inputs shared by the registered queries."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession, functions as F

import slicewise as sw


def registry():
    """Two empty dicts, queries and SQL by name, and the decorator that fills them."""
    queries, oracles = {}, {}

    def register(name: str, sql: str):
        def keep(query):
            queries[name], oracles[name] = query, sql
            return query

        return keep

    return queries, oracles, register


DAY, DAY_BEFORE = "2024-01-15", "2024-01-14"
RUN = sw.Run(1, 1, 1, 7, DAY, 1, "daily events")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def judged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with columns for every kind of rule: groups of several sizes, a NULL group, values that come and go."""
    return table(spark, sf_dir, "events").select(
        "ts",
        "event_type",
        F.expr("CASE WHEN value < 50 THEN 'low' WHEN value < 150 THEN 'mid' ELSE 'high' END").alias("value_band"),
        F.expr("nullif(event_type, 'error')").alias("known_type"),
        F.expr("CASE WHEN event_type = 'purchase' THEN 'yes' ELSE 'no' END").alias("is_purchase"),
        F.expr("CASE WHEN value > 400 THEN 'peak' ELSE 'usual' END").alias("peak"),
        F.expr("'all'").alias("everything"),
    )


JUDGED_COLUMNS = ["event_type", "value_band", "known_type", "is_purchase", "peak", "everything"]


def events_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sw.stats_of_all_slices(judged_events(spark, sf_dir), "ts", JUDGED_COLUMNS, RUN, "events")


# The same history for the check engine.
HISTORY_SQL = """
    judged AS (
      SELECT CAST(ts AS DATE) AS batch_date, event_type,
             CASE WHEN value < 50 THEN 'low' WHEN value < 150 THEN 'mid' ELSE 'high' END AS value_band,
             nullif(event_type, 'error') AS known_type,
             CASE WHEN event_type = 'purchase' THEN 'yes' ELSE 'no' END AS is_purchase,
             CASE WHEN value > 400 THEN 'peak' ELSE 'usual' END AS peak,
             'all' AS everything
      FROM events),
    cells AS (
      SELECT batch_date, 'event_type' AS column_name, event_type AS column_value FROM judged
      UNION ALL SELECT batch_date, 'value_band', value_band FROM judged
      UNION ALL SELECT batch_date, 'known_type', known_type FROM judged
      UNION ALL SELECT batch_date, 'is_purchase', is_purchase FROM judged
      UNION ALL SELECT batch_date, 'peak', peak FROM judged
      UNION ALL SELECT batch_date, 'everything', everything FROM judged),
    history AS (
      SELECT batch_date, column_name, column_value,
             CAST(sum(count(*)) OVER (PARTITION BY batch_date, column_name) AS BIGINT) AS table_count,
             count(column_value) AS n
      FROM cells GROUP BY batch_date, column_name, column_value)
"""

REQUEST_ROWS = [
    # column_name, additional_info, look-back
    ("event_type", "NA", 5),
    ("value_band", "NA", 3),
    ("known_type", "NA", 5),
    ("is_purchase", "NA", 0),
    ("peak", "NA", 5),
    ("everything", "NA", 0),
]

@dataclasses.dataclass(frozen=True)
class Rule:
    """A rule in parts, for the check engine; the control table holds its text. ``compare`` is SQL's word for the operator."""

    column: str
    operator: str
    compare: str
    limit: int
    low: int
    high: int

    @property
    def text(self) -> str:
        return f"{self.operator}{self.limit}%"

    @property
    def band(self) -> str:
        return f"{self.low}%<->{self.high}%"


RULES = [
    Rule("event_type", "<=", "<=", 10, -15, 15),
    Rule("value_band", ">=", ">=", -90, -50, 900),
    Rule("known_type", "<", "<", 0, 300, 500),
    Rule("is_purchase", ">", ">", 50, 0, 0),
    Rule("peak", "<=", "<=", 10, -10, 10),
    Rule("everything", "==", "=", 0, 0, 0),
]
# As written into the control table; the last one is no rule, and a column's first text counts.
RULE_ROWS = [(r.column, r.text, r.band) for r in RULES] + [("everything", "not a rule", "0%<->0%")]


def requests(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"(1, 1, 7, 1, 'events', '{c}', '{i}', 'ts', {n}, 'NA')" for c, i, n in REQUEST_ROWS)
    names = "project_id, pipeline_id, scenario_id, check_id, table_name, column_name, additional_info, "
    names += "date_partition_columns, number_of_partitions, filter_condition"
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({names})")


def rules(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"(1, 1, 1, '{c}', 'NA', '{r}', '{t}')" for c, r, t in RULE_ROWS)
    names = "project_id, sub_project_id, pipeline_id, column_name, column_value, rule, trend_rule"
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({names})")
