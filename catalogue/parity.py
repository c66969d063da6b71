"""Agreement between sides, nested records and files."""

from __future__ import annotations

from pyspark.sql import functions as F

import slicewise as sw
from slicewise.layout import VALIDATION_SCHEMA
from slicewise.session import scratch_path

from .common import DAY, DAY_BEFORE, RUN, registry, table

QUERIES, ORACLES, register = registry()


def _shape_sql(label: str, sides: list[tuple[str, int]]) -> str:
    """Counts of sides given as (count query, number of columns)."""
    counts = [f"({query})" for query, _ in sides]
    rows = ", ".join(f"({c})" for c in counts)
    texts = " || '||' || ".join(f"CAST({c} AS VARCHAR)" for c in counts)
    widths = [n for _, n in sides]
    agree = "'Pass'" if len(set(widths)) == 1 else "'Fail'"
    return (
        f"SELECT '{label}' AS what, 'Record Count' AS check_name, count(DISTINCT n) AS n_distinct, {texts} AS side_counts, "
        f"CASE WHEN count(DISTINCT n) = 1 THEN 'Pass' ELSE 'Fail' END AS status FROM (VALUES {rows}) AS t(n) "
        f"UNION ALL SELECT '{label}', 'Column Count', {len(set(widths))}, '{'||'.join(map(str, widths))}', {agree}"
    )


ON, BEFORE = f"CAST(ts AS DATE) = DATE '{DAY}'", f"CAST(ts AS DATE) = DATE '{DAY_BEFORE}'"


@register(
    "shape_parity",
    _shape_sql("orders", [("SELECT count(*) FROM orders", 6)] * 3)
    + " UNION ALL "
    + _shape_sql("events", [("SELECT count(*) FROM events", 6), (f"SELECT count(*) FROM events WHERE {ON}", 2)]),
)
def shape_parity(spark, sf_dir):
    orders, events = table(spark, sf_dir, "orders"), table(spark, sf_dir, "events")
    same = sw.shape_parity({"a": orders, "b": orders, "c": orders})
    part = sw.shape_parity({"all": events, "day": sw.slice_scan(events, "ts", DAY, ["event_id", "value"])})
    return sw.merge_frames([f.select(F.lit(n).alias("what"), "*") for n, f in (("orders", same), ("events", part))])


@register(
    "slice_parity",
    _shape_sql("slice", [(f"SELECT count(*) FROM events WHERE {ON}", 6)] * 2),
)
def slice_parity(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    sides = sw.slice_sides({"here": events, "there": events}, "ts", DAY)
    return sw.shape_parity(sides).select(F.lit("slice").alias("what"), "*")


@register(
    "query_parity",
    _shape_sql(
        "types",
        [
            (f"SELECT count(*) FROM (SELECT event_type, count(*) FROM events WHERE {ON} GROUP BY event_type) q", 2),
            (f"SELECT count(*) FROM (SELECT event_type FROM events WHERE {ON} GROUP BY event_type) q", 1),
        ],
    ),
)
def query_parity(spark, sf_dir):
    texts = {
        "counted": "SELECT event_type, count(*) FROM observed WHERE CAST(ts AS DATE) = :batch_date GROUP BY event_type",
        "listed": "SELECT DISTINCT event_type FROM observed WHERE CAST(ts AS DATE) = :batch_date",
    }
    views = {"observed": table(spark, sf_dir, "events")}
    return sw.query_parity(spark, texts, DAY, views).select(F.lit("types").alias("what"), "*")


def _cells_sql(name: str, sides: list[str]) -> str:
    cells = " UNION ALL ".join(f"SELECT cell, {i} AS side FROM ({q}) s{i}" for i, q in enumerate(sides))
    return (
        f"SELECT '{name}' AS what, count(*) AS n_cells, count(*) FILTER (WHERE last = {len(sides) - 1}) AS n_last_cells, "
        f"CASE WHEN count(*) = count(*) FILTER (WHERE last = {len(sides) - 1}) THEN 'Pass' ELSE 'Fail' END AS status "
        f"FROM (SELECT cell, max(side) AS last FROM ({cells}) c GROUP BY cell) k"
    )


def _status_cells(where: str) -> str:
    return (
        f"SELECT unnest([o_orderstatus, o_orderpriority, CAST(o_custkey AS VARCHAR)]) AS cell FROM orders WHERE {where}"
    )


@register(
    "result_set_parity",
    _cells_sql("part in whole", [_status_cells("o_totalprice < 200000"), _status_cells("TRUE")])
    + " UNION ALL "
    + _cells_sql("whole in part", [_status_cells("TRUE"), _status_cells("o_totalprice < 200000")])
    + " UNION ALL "
    + _cells_sql(
        "with nulls",
        [
            "SELECT nullif(event_type, 'view') AS cell FROM events",
            f"SELECT nullif(event_type, 'view') AS cell FROM events WHERE {ON}",
        ],
    ),
)
def result_set_parity(spark, sf_dir):
    fields = ["o_orderstatus", "o_orderpriority", "o_custkey"]
    orders = table(spark, sf_dir, "orders")
    whole, part = orders.select(*fields), orders.filter("o_totalprice < 200000").select(*fields)
    seen = table(spark, sf_dir, "events").select("ts", F.expr("nullif(event_type, 'view')").alias("event_type"))
    day = sw.slice_scan(seen, "ts", DAY, ["event_type"])
    found = {
        "part in whole": sw.result_set_parity({"part": part, "whole": whole}),
        "whole in part": sw.result_set_parity({"whole": whole, "part": part}),
        "with nulls": sw.result_set_parity({"all": seen.select("event_type"), "day": day}),
    }
    return sw.merge_frames([f.select(F.lit(n).alias("what"), "*") for n, f in found.items()])


@register(
    "result_set_parity_first_rows",
    _cells_sql(
        "first",
        [
            "SELECT unnest([event_type, CAST(n AS VARCHAR)]) AS cell FROM (SELECT event_type, count(*) AS n FROM events "
            f"WHERE {where} GROUP BY event_type ORDER BY 1, 2 LIMIT 3) t"
            for where in (ON, BEFORE)
        ],
    ),
)
def result_set_parity_first_rows(spark, sf_dir):
    sides = _type_counts(spark, sf_dir)
    return sw.result_set_parity(sides, limit=3).select(F.lit("first").alias("what"), "*")


def _type_counts(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return {
        day: sw.slice_scan(events, "ts", day).groupBy("event_type").agg(F.count("*").alias("n"))
        for day in (DAY, DAY_BEFORE)
    }


def _json_sql(where: str) -> str:
    return (
        "(SELECT string_agg('{\"event_type\":\"' || event_type || '\",\"n\":' || CAST(n AS VARCHAR) || '}', ';' "
        "ORDER BY event_type, n) FROM (SELECT event_type, count(*) AS n FROM events "
        f"WHERE {where} GROUP BY event_type ORDER BY 1, 2 LIMIT 3) t)"
    )


@register("result_json", f"SELECT {_json_sql(ON)} || '|||' || {_json_sql(BEFORE)} AS result")
def result_json(spark, sf_dir):
    return sw.result_json(_type_counts(spark, sf_dir), limit=3)


@register(
    "parity_status",
    "SELECT CASE WHEN (SELECT count(*) FROM orders) = (SELECT count(*) FROM lineitem) THEN 'Pass' ELSE 'Fail' END AS status",
)
def parity_status(spark, sf_dir):
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return sw.parity_status(sw.shape_parity({"orders": orders, "lines": lines.select(*lines.columns[:6])}))


@register(
    "parity_run",
    f"SELECT 7 AS scenario_id, 1 AS batch_seq_id, CASE WHEN (SELECT count(*) FROM events WHERE {ON}) = "
    f"(SELECT count(*) FROM events WHERE {BEFORE}) THEN 'Pass' ELSE 'Fail' END AS status",
)
def parity_run(spark, sf_dir):
    """The scenario with its validation and status rows written."""
    events = table(spark, sf_dir, "events")
    sides = {day: sw.slice_scan(events, "ts", day) for day in (DAY, DAY_BEFORE)}
    validation = sw.shape_validation(sides, RUN, check_id=12)
    status = sw.run_parity(validation, RUN, scratch_path(spark, "parity"))
    return status.select("scenario_id", "batch_seq_id", "status")


@register(
    "parity_run_two_checks",
    """SELECT t.*, 'Fail' AS run_status FROM (
         SELECT '12' AS check_id, 'Record Count' AS check_name,
                (SELECT count(*) FROM orders) || '||' || (SELECT count(*) FROM lineitem) AS comments, 'Fail' AS status
         UNION ALL SELECT '3', 'Column Count', '6||6', 'Pass'
         UNION ALL SELECT '20', 'Result', NULL, 'Fail') t""",
)
def parity_run_two_checks(spark, sf_dir):
    """Three control rows of one run: the validation rows, and the status they give together."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    tables = {"both": {"orders": orders, "lines": lines.select(*lines.columns[:6])}}
    rows = ", ".join(f"(1, 1, 7, 'both', {check}, 'NA', '3')" for check in (12, 3, 20))
    names = "project_id, pipeline_id, scenario_id, table_name, check_id, date_partition_columns, filter_condition"
    asked, folder = spark.sql(f"SELECT * FROM VALUES {rows} AS t({names})"), scratch_path(spark, "parity")
    status = sw.run_parity_requests(asked, tables, RUN, folder).select(F.col("status").alias("run_status"))
    kept = sw.read_rows(spark, f"{folder}/validation", VALIDATION_SCHEMA)
    comments = F.when(F.col("check_name") != "Result", F.col("comments"))
    return kept.select("check_id", "check_name", comments.alias("comments"), "status", F.lit(status.first()[0]).alias("run_status"))


@register(
    "parity_run_fewer_checks",
    """SELECT '5' AS check_id, 'Column Count' AS check_name, '6||6' AS comments, 'Pass' AS status, 'Pass' AS run_status,
              CASE WHEN (SELECT count(*) FROM orders) = (SELECT count(*) FROM lineitem) THEN 'Pass' ELSE 'Fail' END AS first_status""",
)
def parity_run_fewer_checks(spark, sf_dir):
    """Control rows of two checks, then of one under the same run: the row that is left, and the status of both tries."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    tables = {"both": {"orders": orders, "lines": lines.select(*lines.columns[:6])}}
    names = "project_id, pipeline_id, scenario_id, table_name, check_id, date_partition_columns, filter_condition"
    folder, told = scratch_path(spark, "parity"), []
    for checks in ((12, 5), (5,)):
        rows = ", ".join(f"(1, 1, 7, 'both', {check}, 'NA', 'NA')" for check in checks)
        asked = spark.sql(f"SELECT * FROM VALUES {rows} AS t({names})")
        told.append(sw.run_parity_requests(asked, tables, RUN, folder).first()["status"])
    kept = sw.read_rows(spark, f"{folder}/validation", VALIDATION_SCHEMA)
    status = {"first_status": F.lit(told[0]), "run_status": F.lit(told[1])}
    return kept.select("check_id", "check_name", "comments", "status", *[c.alias(n) for n, c in status.items()])


def _nested(spark, sf_dir):
    """One record per document, with its lines as an array of structs and its origin as a struct of structs."""
    lines = F.transform(
        F.split("text", "\n"),
        lambda line, no: F.struct(no.cast("bigint").alias("no"), F.length(line).cast("bigint").alias("size")),
    )
    origin = F.struct("source", F.struct("lang", "n_chars").alias("facts"))
    return table(spark, sf_dir, "documents").select("doc_id", lines.alias("lines"), origin.alias("origin"))


LINES_SQL = """
    lines AS (SELECT doc_id, source, lang, n_chars, unnest(range(len(parts))) AS no, unnest(parts) AS line
              FROM (SELECT *, string_split(text, chr(10)) AS parts FROM documents) d)
"""


@register(
    "nested_flatten",
    f'WITH {LINES_SQL} SELECT doc_id, no AS "lines~no", length(line) AS "lines~size", source AS "origin~source", '
    'lang AS "origin~facts~lang", n_chars AS "origin~facts~n_chars" FROM lines',
)
def nested_flatten(spark, sf_dir):
    return sw.flatten(_nested(spark, sf_dir), keep_structs=False)


@register(
    "nested_flatten_keep_empty",
    "WITH turns AS (SELECT conv_id, turn, CASE WHEN role = 'user' THEN string_split(text, ' ') END AS words FROM conversations) "
    "SELECT conv_id, turn, unnest(words) AS word FROM turns WHERE words IS NOT NULL UNION ALL "
    "SELECT conv_id, turn, NULL FROM turns WHERE words IS NULL",
)
def nested_flatten_keep_empty(spark, sf_dir):
    """Arrays of plain values, NULL for the turns of the other side, whose records are kept."""
    words = F.when(F.col("role") == "user", F.split("text", " ")).alias("word")
    return sw.flatten(table(spark, sf_dir, "conversations").select("conv_id", "turn", words), keep_empty=True)


@register("nested_record_count", "SELECT count(*) AS n_records FROM documents")
def nested_record_count(spark, sf_dir):
    return sw.nested_record_count(_nested(spark, sf_dir))


@register(
    "json_source",
    f"WITH {LINES_SQL} SELECT doc_id, count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars FROM lines "
    "GROUP BY doc_id",
)
def json_source(spark, sf_dir):
    """Nested records written as JSON, read back with an inferred schema, and flattened."""
    path = scratch_path(spark, "json")
    _nested(spark, sf_dir).write.json(path)
    flat = sw.flatten(sw.read_json(spark, path))
    return flat.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.sum("lines~size").alias("n_chars"))


@register(
    "json_field_profile",
    "SELECT key, count(*) AS n, (SELECT count(*) FROM events) AS n_rows "
    "FROM (SELECT unnest(json_keys(props)) AS key FROM events) k GROUP BY key",
)
def json_field_profile(spark, sf_dir):
    return sw.json_field_profile(table(spark, sf_dir, "events"), "props")


TEXT_FOLDERS = "l_returnflag"


@register(
    "file_profile",
    "SELECT l_returnflag AS folder, count(*) AS n_rows, 'l_orderkey|l_quantity' AS header, "
    "CAST(sum(length(CAST(l_orderkey AS VARCHAR)) + length(CAST(l_quantity AS VARCHAR)) + 2) AS BIGINT) AS n_bytes "
    "FROM lineitem GROUP BY l_returnflag",
)
def file_profile(spark, sf_dir):
    """Order lines as delimited files, a folder per flag; file facts summed per folder, headers taken off. Empty files hold
    no line and are not listed."""
    path = scratch_path(spark, "text")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", TEXT_FOLDERS)
    lines.write.partitionBy(TEXT_FOLDERS).options(header=True, sep="|").csv(path)
    files = sw.file_profile(spark, path, "1").withColumn(
        "folder", F.regexp_extract("file_path", TEXT_FOLDERS + "=([^/]+)/", 1)
    )
    return (
        files.filter("folder <> ''")
        .groupBy("folder")
        .agg(
            F.sum(F.col("n_newlines") - 1).alias("n_rows"),
            F.max("header").alias("header"),
            F.sum(F.col("size") - F.octet_length("header") - 1).alias("n_bytes"),
        )
    )


@register(
    "line_consistency",
    "SELECT count(*) AS n_rows, count(*) FILTER (WHERE contains(text, ',')) AS n_bad_lines FROM documents",
)
def line_consistency(spark, sf_dir):
    """Whole texts as unquoted delimited lines: a comma inside a text makes a field too many."""
    path = scratch_path(spark, "raw-lines")
    text = F.regexp_replace("text", "[\r\n]", " ").alias("text")
    plain = {"header": True, "sep": ",", "quote": "", "escapeQuotes": False}
    table(spark, sf_dir, "documents").select("doc_id", "lang", text).write.options(**plain).csv(path)
    return sw.line_consistency(spark, path, ",").agg(
        F.sum(F.col("n_lines") - 1).alias("n_rows"), F.sum("n_bad_lines").alias("n_bad_lines")
    )
