"""Row layouts of the control and result tables.

Missing facts are typed NULLs, dates are DATE inside and text only at the edge.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, functions as F, types as T

# Names and order of the columns of the control and result tables.
REQUEST_SCHEMA = """
    project_id int, pipeline_id int, scenario_id int, check_id int, table_name string, column_name string,
    additional_info string, date_partition_columns string, number_of_partitions int, filter_condition string
"""

RULE_SCHEMA = """
    project_id int, sub_project_id int, pipeline_id int,
    column_name string, column_value string, rule string, trend_rule string
"""

# What every profile operator returns for one slice. ``stat_kind`` tells a group of equal values ("value"),
# the whole column ("column") and one histogram bucket ("range") apart.
PROFILE_SCHEMA = """
    column_name string, stat_kind string, column_value string, table_count bigint, group_count bigint,
    min_value string, max_value string, min_number double, max_number double, range_start bigint, range_end bigint
"""

STATS_SCHEMA = """
    scenario_id int, check_id string, table_name string, filter_condition string, column_name string,
    column_value string, table_count bigint, error_records_count bigint, project_id int, sub_project_id int,
    pipeline_id int, batch_date date, batch_sequence int, stat_kind string, min_value string, max_value string,
    min_number double, max_number double, range_start bigint, range_end bigint
"""

VALIDATION_SCHEMA = """
    scenario_id int, check_id string, table_name string, filter_condition string, column_name string,
    column_value string, table_count bigint, error_records_count bigint, error_percentage double,
    threshold_percentage string, status string, average_table_count bigint, average_error_records_count bigint,
    average_error_percentage bigint, trend_threshold_percentage string, trend_status string, comments string,
    batch_date date, batch_sequence int, scenario_name string, check_name string, project_id int,
    sub_project_id int, pipeline_id int
"""

STATUS_SCHEMA = """
    project_id int, sub_project_id int, pipeline_id int, scenario_id int, scenario_name string, batch_date date,
    batch_seq_id int, status string, comments string, additionalcomments string, start_time string, end_time string
"""


@lru_cache(maxsize=None)
def fields_of(ddl: str) -> tuple[T.StructField, ...]:
    """The fields of a DDL text."""
    return tuple(T.StructType.fromDDL(ddl).fields)


def fit(df: DataFrame, ddl: str) -> DataFrame:
    """Project ``df`` on a layout: its own columns cast, absent ones as typed NULLs, the rest dropped."""
    have = {f.name: f.dataType for f in df.schema.fields}
    cells = []
    for field in fields_of(ddl):
        if have.get(field.name) == field.dataType:
            cells.append(field.name)
            continue
        cell = F.col(field.name) if field.name in have else F.lit(None)
        cells.append(cell.cast(field.dataType).alias(field.name))
    return df.select(*cells)
