"""Slices, profiles and histograms."""

from __future__ import annotations

from pyspark.sql import functions as F

import slicewise as sw

from .common import DAY, DAY_BEFORE, registry, table

QUERIES, ORACLES, register = registry()


@register("slice_scan", f"SELECT event_id, event_type, value FROM events WHERE CAST(ts AS DATE) = DATE '{DAY}'")
def slice_scan(spark, sf_dir):
    return sw.slice_scan(table(spark, sf_dir, "events"), "ts", DAY, ["event_id", "event_type", "value"])


DATED = {"events": "ts", "orders": "o_orderdate", "lineitem": "l_shipdate"}


def _per_table(spark, sf_dir, make):
    frames = [make(table(spark, sf_dir, t), c).select(F.lit(t).alias("table_name"), "*") for t, c in DATED.items()]
    return sw.merge_frames(frames)


@register(
    "latest_slice_date",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, CAST(max({c}) AS DATE) AS max_date FROM {t}" for t, c in DATED.items()),
)
def latest_slice_date(spark, sf_dir):
    return _per_table(spark, sf_dir, sw.latest_slice_date)


ASKED = ["2023-12-31", "2024-01-01", DAY, "2024-01-30", "2024-01-31"]


@register(
    "slice_exists",
    "SELECT d AS slice_date, EXISTS (SELECT 1 FROM events WHERE CAST(ts AS DATE) = d) AS present FROM (VALUES "
    + ", ".join(f"(DATE '{d}')" for d in ASKED)
    + ") AS t(d)",
)
def slice_exists(spark, sf_dir):
    return sw.slice_exists(table(spark, sf_dir, "events"), "ts", ASKED)


@register(
    "slice_probe",
    f"SELECT DISTINCT CAST(ts AS DATE) AS slice_date FROM events WHERE CAST(ts AS DATE) = DATE '{DAY}'",
)
def slice_probe(spark, sf_dir):
    return sw.slice_probe(table(spark, sf_dir, "events"), "ts", DAY)


@register(
    "prior_slice_lookup",
    "SELECT max(CAST(ts AS DATE)) AS prior_date FROM events "
    "WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-26' AND DATE '2024-02-02'",
)
def prior_slice_lookup(spark, sf_dir):
    return sw.prior_slice_date(table(spark, sf_dir, "events"), "ts", "2024-02-03", step=-1, max_steps=7)


@register(
    "latest_slice_count",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n FROM {t} "
        f"WHERE CAST({c} AS DATE) = (SELECT max(CAST({c} AS DATE)) FROM {t})"
        for t, c in DATED.items()
    ),
)
def latest_slice_count(spark, sf_dir):
    return _per_table(spark, sf_dir, sw.latest_slice_count)


@register(
    "slice_count",
    "SELECT 'events' AS table_name, count(*) AS n FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15' UNION ALL "
    "SELECT 'lineitem', count(*) FROM lineitem WHERE CAST(l_shipdate AS DATE) = DATE '1998-01-15'",
)
def slice_count(spark, sf_dir):
    events = sw.slice_count(table(spark, sf_dir, "events"), "ts", DAY)
    lines = sw.slice_count(table(spark, sf_dir, "lineitem"), "l_shipdate", "1998-01-15")
    return sw.merge_frames(
        [f.select(F.lit(t).alias("table_name"), "n") for t, f in (("events", events), ("lineitem", lines))]
    )


@register("table_count", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in DATED))
def table_count(spark, sf_dir):
    return _per_table(spark, sf_dir, lambda df, c: sw.table_count(df))


@register(
    "query_dataset",
    f"SELECT event_type, count(*) AS n FROM events WHERE CAST(ts AS DATE) = DATE '{DAY}' GROUP BY event_type",
)
def query_dataset(spark, sf_dir):
    text = "SELECT event_type, count(*) AS n FROM observed WHERE CAST(ts AS DATE) = :batch_date GROUP BY event_type"
    return sw.query_dataset(spark, text, DAY, {"observed": table(spark, sf_dir, "events")})


def _value_sql(tbl: str, column: str, kind: str = "text", where: str = "TRUE") -> str:
    number = f"CAST({column} AS DOUBLE)" if kind == "number" else "CAST(NULL AS DOUBLE)"
    return (
        f"SELECT '{column}' AS column_name, 'value' AS stat_kind, CAST({column} AS VARCHAR) AS column_value, "
        f"(SELECT count(*) FROM {tbl} WHERE {where}) AS table_count, count({column}) AS group_count, "
        f"CAST({column} AS VARCHAR) AS min_value, CAST({column} AS VARCHAR) AS max_value, "
        f"{number} AS min_number, {number} AS max_number FROM {tbl} WHERE {where} GROUP BY {column}"
    )


def _column_sql(tbl: str, column: str, kind: str = "text", where: str = "TRUE") -> str:
    # Adding 0 writes both zeros of floating point in one form.
    low, high = (f"{f}({column}) + 0" if kind == "number" else f"{f}({column})" for f in ("min", "max"))
    ends = [f"CAST({end} AS DOUBLE)" if kind == "number" else "CAST(NULL AS DOUBLE)" for end in (low, high)]
    return (
        f"SELECT '{column}' AS column_name, 'column' AS stat_kind, CAST(NULL AS VARCHAR) AS column_value, "
        f"count(*) AS table_count, count(*) AS group_count, CAST({low} AS VARCHAR) AS min_value, "
        f"CAST({high} AS VARCHAR) AS max_value, {ends[0]} AS min_number, {ends[1]} AS max_number "
        f"FROM {tbl} WHERE {where} HAVING count(*) > 0"
    )


@register("value_profile", _value_sql("lineitem", "l_returnflag"))
def value_profile(spark, sf_dir):
    return sw.value_profile(table(spark, sf_dir, "lineitem"), "l_returnflag")


@register(
    "multi_column_profile",
    " UNION ALL ".join(
        [
            _value_sql("lineitem", "l_returnflag"),
            _value_sql("lineitem", "l_linestatus"),
            _value_sql("lineitem", "l_linenumber", "number"),
            _value_sql("lineitem", "l_quantity", "number"),
        ]
    ),
)
def multi_column_profile(spark, sf_dir):
    columns = ["l_returnflag", "l_linestatus", "l_linenumber", "l_quantity"]
    return sw.multi_column_profile(table(spark, sf_dir, "lineitem"), columns)


TYPED = {"q2": "CAST(l_linenumber AS DECIMAL(10, 2))", "q4": "CAST(l_linenumber AS DECIMAL(38, 4))", "f": "CAST(l_discount AS FLOAT)"}


@register(
    "typed_value_texts",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({e} AS VARCHAR) AS column_value, count(*) AS group_count FROM lineitem GROUP BY ALL"
        for c, e in TYPED.items()
    ),
)
def typed_value_texts(spark, sf_dir):
    """Decimals of two scales and a FLOAT together: each value has the text of its own column's type."""
    rows = table(spark, sf_dir, "lineitem").select(*[F.expr(e).alias(c) for c, e in TYPED.items()])
    return sw.multi_column_profile(rows, list(TYPED)).select("column_name", "column_value", "group_count")


@register(
    "null_value_profile",
    "WITH t AS (SELECT nullif(o_orderstatus, 'O') AS o_orderstatus FROM orders) " + _value_sql("t", "o_orderstatus"),
)
def null_value_profile(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.expr("nullif(o_orderstatus, 'O')").alias("o_orderstatus"))
    return sw.value_profile(orders, "o_orderstatus")


NUMERIC = ["l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("column_profile", " UNION ALL ".join(_column_sql("lineitem", c, "number") for c in NUMERIC))
def column_profile(spark, sf_dir):
    return sw.column_profile(table(spark, sf_dir, "lineitem"), NUMERIC)


def _gated_sql(tbl: str, columns: dict[str, str], gate: int) -> str:
    parts = []
    for column, kind in columns.items():
        few = f"(SELECT count(*) FROM (SELECT {column} FROM {tbl} GROUP BY {column}) g) < {gate}"
        parts.append(f"SELECT * FROM ({_value_sql(tbl, column, kind)}) v WHERE {few}")
        parts.append(f"SELECT * FROM ({_column_sql(tbl, column, kind)}) c WHERE NOT {few}")
    return " UNION ALL ".join(parts)


GATED = {"o_orderstatus": "text", "o_orderpriority": "text", "o_totalprice": "number", "o_custkey": "number"}


@register("gated_profile", _gated_sql("orders", GATED, 5))
def gated_profile(spark, sf_dir):
    return sw.gated_profile(table(spark, sf_dir, "orders"), list(GATED))


LINES = {
    "l_returnflag": "text",
    "l_linestatus": "text",
    "l_linenumber": "number",
    "l_quantity": "number",
    "l_orderkey": "number",
}


@register("gated_profile_lineitem", _gated_sql("lineitem", LINES, 5))
def gated_profile_lineitem(spark, sf_dir):
    return sw.gated_profile(table(spark, sf_dir, "lineitem"), list(LINES))


def _buckets_sql(value: str, width: int) -> str:
    return f"CAST({value} - ({value} % {width}) AS BIGINT)"


def _label_sql(width: int) -> str:
    return f"CAST(range_start AS VARCHAR) || ' <-> ' || CAST(range_start + {width} AS VARCHAR)"


def _range_sql(tbl: str, column: str, width: int, where: str = "TRUE", extra: str = "") -> str:
    return (
        f"SELECT '{column}' AS column_name, 'range' AS stat_kind, {_label_sql(width)} AS column_value, {extra}"
        f"count(range_start) AS group_count, CAST(min({column}) AS DOUBLE) AS min_number, "
        f"CAST(max({column}) AS DOUBLE) AS max_number, range_start, range_start + {width} AS range_end "
        f"FROM (SELECT {column}, {_buckets_sql(column, width)} AS range_start FROM {tbl} WHERE {where}) b "
        "GROUP BY range_start"
    )


@register(
    "range_histogram",
    _range_sql("lineitem", "l_extendedprice", 10000) + " UNION ALL " + _range_sql("customer", "c_acctbal", 1000),
)
def range_histogram(spark, sf_dir):
    prices = sw.range_histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice", 10000, sort=True)
    balances = sw.range_histogram(table(spark, sf_dir, "customer"), "c_acctbal", 1000, sort=True)
    return sw.merge_frames([prices, balances])


@register(
    "floor_histogram",
    "SELECT 'c_acctbal' AS column_name, 'range' AS stat_kind, " + _label_sql(1000) + " AS column_value, "
    "count(*) AS group_count, min(c_acctbal) AS min_number, max(c_acctbal) AS max_number, range_start, "
    "range_start + 1000 AS range_end FROM (SELECT c_acctbal, CAST(floor(c_acctbal / 1000) * 1000 AS BIGINT) AS range_start "
    "FROM customer) b GROUP BY range_start",
)
def floor_histogram(spark, sf_dir):
    return sw.range_histogram(table(spark, sf_dir, "customer"), "c_acctbal", 1000, mode="floor")


@register(
    "bounded_histogram",
    _range_sql(
        "orders",
        "o_totalprice",
        50000,
        "o_totalprice BETWEEN 0 AND 300000",
        "(SELECT count(*) FROM orders) AS table_count, ",
    ),
)
def bounded_histogram(spark, sf_dir):
    return sw.bounded_histogram(table(spark, sf_dir, "orders"), "o_totalprice", 0, 300000, 50000)


REQUESTS = [("event_type", "NA"), ("value", "0<->300<->50"), ("user_id", "0<->100<->10"), ("value", "-1<->3<->4"), ("gone", "NA")]
ON_DAY = f"CAST(ts AS DATE) = DATE '{DAY}'"


def _request_sql(column: str, info: str, kind: str, where: str) -> str:
    few = f"(SELECT count(*) FROM (SELECT {column} FROM events WHERE {where} GROUP BY {column}) g) < 5"
    total = f"(SELECT count(*) FROM events WHERE {ON_DAY}) AS table_count"
    fields = (
        f"column_name, '{info}' AS additional_info, stat_kind, column_value, {total}, group_count, min_value, "
        "max_value, min_number, max_number, CAST(NULL AS BIGINT) AS range_start, CAST(NULL AS BIGINT) AS range_end"
    )
    return (
        f"SELECT {fields} FROM ({_value_sql('events', column, kind, where)}) v WHERE {few} UNION ALL "
        f"SELECT {fields} FROM ({_column_sql('events', column, kind, where)}) c WHERE NOT {few}"
    )


def _request_ranges_sql(column: str, info: str, where: str, width: int) -> str:
    return (
        f"SELECT column_name, '{info}' AS additional_info, stat_kind, column_value, "
        f"(SELECT count(*) FROM events WHERE {ON_DAY}) AS table_count, group_count, CAST(NULL AS VARCHAR) AS min_value, "
        "CAST(NULL AS VARCHAR) AS max_value, min_number, max_number, range_start, range_end "
        f"FROM ({_range_sql('events', column, width, where)}) r"
    )


@register(
    "request_profile",
    " UNION ALL ".join(
        [
            _request_sql("event_type", "NA", "text", ON_DAY),
            _request_sql("value", "0<->300<->50", "number", f"{ON_DAY} AND value BETWEEN 0 AND 300"),
            _request_sql("user_id", "0<->100<->10", "number", f"{ON_DAY} AND user_id BETWEEN 0 AND 100"),
            _request_ranges_sql("value", "0<->300<->50", f"{ON_DAY} AND value BETWEEN 0 AND 300", 50),
            _request_ranges_sql("user_id", "0<->100<->10", f"{ON_DAY} AND user_id BETWEEN 0 AND 100", 10),
        ]
    ),
)
def request_profile(spark, sf_dir):
    rows = ", ".join(f"('{c}', '{i}')" for c, i in REQUESTS)
    requests = spark.sql(f"SELECT * FROM VALUES {rows} AS t(column_name, additional_info)")
    rows = sw.slice_scan(table(spark, sf_dir, "events"), "ts", DAY)
    return sw.request_profile(rows, requests, ignore_unknown=True)


# Nested, crossing and single-value bounds on one numeric and one text column; the last of each has no values.
NESTED = [(low, low + reach) for low in range(0, 200, 20) for reach in (0, 9, 60)] + [(900_000, 900_001)]
NESTED_REQUESTS = [("user_id", f"{a}<->{b}<->{w}") for a, b in NESTED for w in ("7", "NA")] + [
    ("code", f"{a}<->{b}<->NA") for a, b in NESTED
]


def _nested_sql() -> str:
    """Per request a count of its rows, its extremes and its buckets, each by a scan of its own."""
    parts = []
    for column, info in NESTED_REQUESTS:
        low, high, width = info.split("<->")
        value, ends = ("user_id", (low, high)) if column == "user_id" else ("CAST(user_id % 1000 AS VARCHAR)", (f"'{low}'", f"'{high}'"))
        buckets = f"count(DISTINCT user_id // {width})" if width != "NA" else "0"
        parts.append(
            f"SELECT '{column}' AS column_name, '{info}' AS additional_info, count(*) AS n_rows, CAST(min({value}) AS VARCHAR) AS low, "
            f"CAST(max({value}) AS VARCHAR) AS high, {buckets} AS n_buckets FROM events WHERE {value} BETWEEN {ends[0]} AND {ends[1]} "
            "HAVING count(*) > 0"
        )
    return " UNION ALL ".join(parts)


@register("request_profile_nested_bounds", _nested_sql())
def request_profile_nested_bounds(spark, sf_dir):
    """Many requests of two columns whose bounds nest and cross, summed up per request."""
    rows = ", ".join(f"('{c}', '{i}')" for c, i in NESTED_REQUESTS)
    requests = spark.sql(f"SELECT * FROM VALUES {rows} AS t(column_name, additional_info)")
    code = F.expr("CAST(user_id % 1000 AS STRING)").alias("code")
    found = sw.request_profile(table(spark, sf_dir, "events").select("user_id", code), requests)
    values, number = F.col("stat_kind") != "range", F.col("column_name") == "user_id"

    def end(f):
        """Numbers are compared as numbers, texts as texts."""
        name = f.__name__
        whole = f(F.when(values & number, F.col(f"{name}_number"))).cast("bigint").cast("string")
        return F.coalesce(whole, f(F.when(values & ~number, F.col(f"{name}_value"))))

    return found.groupBy("column_name", "additional_info").agg(
        F.sum(F.when(values, F.col("group_count"))).alias("n_rows"),
        end(F.min).alias("low"),
        end(F.max).alias("high"),
        F.count_if(~values).alias("n_buckets"),
    )


@register(
    "row_index",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS row_index FROM orders",
)
def row_index(spark, sf_dir):
    return sw.row_index(table(spark, sf_dir, "orders").select("o_orderkey"), order_by=["o_orderkey"])


@register(
    "row_index_wide",
    "SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate), row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_index "
    "FROM orders",
)
def row_index_wide(spark, sf_dir):
    """All columns of the orders, numbered by date; only the two key columns are sorted."""
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    return sw.row_index(orders, order_by=["o_orderdate"], tie=["o_orderkey"])


@register(
    "row_index_keys",
    "SELECT o_custkey, count(*) AS n_orders, min(i) AS first_index, max(i) AS last_index FROM "
    "(SELECT o_custkey, row_number() OVER (ORDER BY o_custkey) AS i FROM orders) GROUP BY o_custkey",
)
def row_index_keys(spark, sf_dir):
    """Numbers by a key that rows share: where each key's run begins and ends."""
    index = sw.key_index(table(spark, sf_dir, "orders"), ["o_custkey"]).groupBy("o_custkey")
    return index.agg(F.count("*").alias("n_orders"), F.min("row_index").alias("first_index"), F.max("row_index").alias("last_index"))


@register(
    "row_index_input_order",
    """SELECT (i - 1) // 1000 AS bucket, count(*) AS n_rows, min(i) AS first_index, max(i) AS last_index, count(DISTINCT i) AS n_indexes
       FROM (SELECT row_number() OVER () AS i FROM lineitem) GROUP BY 1""",
)
def row_index_input_order(spark, sf_dir):
    numbered = sw.row_index(table(spark, sf_dir, "lineitem").select("l_orderkey"))
    bucket = F.expr("(row_index - 1) DIV 1000").alias("bucket")
    return numbered.groupBy(bucket).agg(
        F.count("*").alias("n_rows"),
        F.min("row_index").alias("first_index"),
        F.max("row_index").alias("last_index"),
        F.count_distinct("row_index").alias("n_indexes"),
    )


VS = f"CAST(ts AS DATE) = DATE '{DAY}'", f"CAST(ts AS DATE) = DATE '{DAY_BEFORE}'"


def _pair_sql(here: str, before: str, on: str, fields: list[str], extra: str = "") -> str:
    cells = f"DATE '{DAY}'", f"DATE '{DAY_BEFORE}'"
    out = [f"CASE WHEN a.column_name IS NOT NULL THEN {cells[0]} END AS dt", "a.column_name AS column_name"]
    out += [f"a.{f} AS {f}" for f in fields]
    out += [f"CASE WHEN b.column_name IS NOT NULL THEN {cells[1]} END AS past_dt", "b.column_name AS past_column_name"]
    out += [f"b.{f} AS past_{f}" for f in fields]
    return f"SELECT {extra}{', '.join(out)} FROM ({here}) a FULL OUTER JOIN ({before}) b ON {on}"


PROFILE_FIELDS = ["column_value", "group_count", "min_value", "max_value", "min_number", "max_number"]
SAME_VALUE = "a.column_name = b.column_name AND a.column_value = b.column_value"


def _values_vs_prior(column: str, tbl: str = "events", kind: str = "text", extra: str = "") -> str:
    here, before = (_value_sql(tbl, column, kind, where) for where in VS)
    return _pair_sql(here, before, SAME_VALUE, PROFILE_FIELDS, extra)


def _columns_vs_prior(column: str, kind: str, extra: str = "") -> str:
    here, before = (_column_sql("events", column, kind, where) for where in VS)
    return _pair_sql(here, before, "a.column_name = b.column_name", PROFILE_FIELDS, extra)


def _ranges_vs_prior(column: str, width: int) -> str:
    here, before = (_range_sql("events", column, width, where) for where in VS)
    fields = ["column_value", "group_count", "min_number", "max_number", "range_start", "range_end"]
    return _pair_sql(here, before, SAME_VALUE, fields)


@register(
    "value_profile_vs_prior",
    "WITH t AS (SELECT ts, nullif(event_type, 'error') AS known_type, event_id % 7 AS shard FROM events) "
    + _values_vs_prior("known_type", "t")
    + " UNION ALL "
    + _values_vs_prior("shard", "t", "number"),
)
def value_profile_vs_prior(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "ts", F.expr("nullif(event_type, 'error')").alias("known_type"), F.expr("event_id % 7").alias("shard")
    )
    return sw.value_profile_vs_prior(events, "ts", DAY, DAY_BEFORE, ["known_type", "shard"])


@register(
    "column_profile_vs_prior", _columns_vs_prior("event_type", "text") + " UNION ALL " + _columns_vs_prior("value", "number")
)
def column_profile_vs_prior(spark, sf_dir):
    return sw.column_profile_vs_prior(table(spark, sf_dir, "events"), "ts", DAY, DAY_BEFORE, ["event_type", "value"])


@register("histogram_vs_prior", _ranges_vs_prior("value", 50))
def histogram_vs_prior(spark, sf_dir):
    return sw.histogram_vs_prior(table(spark, sf_dir, "events"), "ts", DAY, DAY_BEFORE, "value", 50)


FEW = "CASE WHEN value < 50 THEN 'low' WHEN value < 150 THEN NULL ELSE 'high' END"
FEW_SQL = f"WITH t AS (SELECT ts, {FEW} AS few FROM events) "


@register(
    "gated_profile_pair",
    FEW_SQL
    + _columns_vs_prior("event_type", "text", "'column' AS stat_kind, ")
    + " UNION ALL "
    + _columns_vs_prior("value", "number", "'column' AS stat_kind, ")
    + " UNION ALL "
    + _values_vs_prior("few", "t", extra="'value' AS stat_kind, "),
)
def gated_profile_pair(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("ts", "event_type", "value", F.expr(FEW).alias("few"))
    return sw.gated_profile_pair(events, "ts", DAY, DAY_BEFORE, ["event_type", "value", "few"])


@register(
    "compare_with_prior",
    "WITH t AS (SELECT * FROM events), "
    "present AS (SELECT max(CAST(ts AS DATE)) AS d FROM events), "
    "prior AS (SELECT max(CAST(ts AS DATE)) AS d FROM events WHERE CAST(ts AS DATE) < (SELECT d FROM present) "
    "AND CAST(ts AS DATE) >= (SELECT d FROM present) - 8), "
    "sides AS (SELECT CASE WHEN CAST(ts AS DATE) = (SELECT d FROM present) THEN 1 ELSE 0 END AS here, value, "
    f"{_buckets_sql('value', 50)} AS range_start FROM events "
    "WHERE CAST(ts AS DATE) IN ((SELECT d FROM present), (SELECT d FROM prior))) "
    "SELECT 'column' AS stat_kind, (SELECT d FROM present) AS dt, 'value' AS column_name, CAST(NULL AS VARCHAR) AS column_value, "
    "count(*) FILTER (WHERE here = 1) AS group_count, min(value) FILTER (WHERE here = 1) AS min_number, "
    "max(value) FILTER (WHERE here = 1) AS max_number, (SELECT d FROM prior) AS past_dt, "
    "count(*) FILTER (WHERE here = 0) AS past_group_count, min(value) FILTER (WHERE here = 0) AS past_min_number, "
    "max(value) FILTER (WHERE here = 0) AS past_max_number FROM sides UNION ALL "
    "SELECT 'range', CASE WHEN max(here) = 1 THEN (SELECT d FROM present) END, CASE WHEN max(here) = 1 THEN 'value' END, "
    f"CASE WHEN max(here) = 1 THEN {_label_sql(50)} END, nullif(count(*) FILTER (WHERE here = 1), 0), "
    "min(value) FILTER (WHERE here = 1), max(value) FILTER (WHERE here = 1), "
    "CASE WHEN min(here) = 0 THEN (SELECT d FROM prior) END, nullif(count(*) FILTER (WHERE here = 0), 0), "
    "min(value) FILTER (WHERE here = 0), max(value) FILTER (WHERE here = 0) FROM sides GROUP BY range_start",
)
def compare_with_prior(spark, sf_dir):
    """The newest slice beside the nearest earlier one, whole column and histogram."""
    compared = sw.compare_with_prior(table(spark, sf_dir, "events"), "ts", ["value"], widths={"value": 50})
    fields = ["stat_kind", "dt", "column_name", "column_value", "group_count", "min_number", "max_number"]
    return compared.select(*fields, "past_dt", "past_group_count", "past_min_number", "past_max_number")
