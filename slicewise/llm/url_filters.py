"""URL filters by host-suffix and path-prefix expressions.

Every URL is expanded into expressions ``host suffix + path prefix``; the first four bytes of their SHA-256 meet those of
the rules in an equi-join, the whole digest confirms, and the longest rule wins. Only DataFrame functions are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX_DIGITS = 8


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for NULL."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _count(text: Column, mark: str) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(mark), F.lit("")))


def shapes_of(table: DataFrame) -> list[tuple[int, int | None, int | None]]:
    """The distinct (labels of the host, slashes of a path that ends in one, else None, length of any other path) of the rules."""
    at_slash = F.endswith("rule_path", F.lit("/"))
    shapes = table.select(
        (_count(F.col("rule_host"), ".") + 1).alias("labels"),
        F.when(at_slash, _count(F.col("rule_path"), "/")).alias("slashes"),
        F.when(~at_slash, F.char_length("rule_path")).alias("size"),
    )
    return sorted((tuple(r) for r in shapes.distinct().collect()), key=str)


def _expressions(host: Column, path: Column, shapes: list[tuple[int, int | None, int | None]]) -> Column:
    """(suffix, prefix) of a URL for each shape that it is long enough for."""
    asked = []
    for labels, slashes, size in shapes:
        fits = _count(host, ".") + 1 >= labels
        if slashes is None:
            fits, prefix = fits & (F.char_length(path) >= size), F.substring(path, 1, size)
        else:
            fits, prefix = fits & (_count(path, "/") >= slashes), F.concat(F.substring_index(path, "/", slashes), F.lit("/"))
        pair = F.struct(F.substring_index(host, ".", -labels).alias("suffix"), prefix.alias("prefix"))
        asked.append(F.when(fits, pair))
    return F.array_compact(F.array(*asked))


def _digest(df: DataFrame, expression: Column) -> DataFrame:
    digest = df.withColumn("digest", F.sha2(expression.cast("binary"), 256))
    return digest.withColumn("short", F.substring("digest", 1, PREFIX_DIGITS))


def rule_table(rules: DataFrame) -> DataFrame:
    """``rules`` (host, path, verdict) as expressions with their digests.

    Rows with a NULL or an empty host fit nothing. Of equal rules ``block`` goes before ``allow``.
    """
    host = F.translate(F.col("host"), UPPER, LOWER)
    rows = rules.select(host.alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"), "verdict")
    rows = rows.filter("rule_host <> '' AND verdict IS NOT NULL").groupBy("rule_host", "rule_path")
    rows = rows.agg(F.max("verdict").alias("verdict"))
    return _digest(rows, F.concat("rule_host", "rule_path"))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``; ``pages`` must not hold these names, else it is an error.

    A rule fits its host and all subdomains of it, if the path starts with the rule's; the longest expression wins, of
    equally long ones the longer host. Pages that no rule fits get NULL and ``default``. Repeated URLs are judged once. A URL
    is expanded to the shapes that rules have: pairs of labels of the host and slashes (or, without one at its end, length) of
    the path. These are few, whatever the number of rules, come to the driver, and each costs one pass over the URL.
    """
    clash = sorted({"host", "path", "rule", "verdict"} & set(pages.columns))
    if clash:
        raise ValueError(f"pages already hold columns named {', '.join(clash)}")
    table = rule_table(rules)
    shapes = shapes_of(table)
    judged = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    if not shapes:
        return judged.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    places = judged.select("host", "path").filter("host <> ''").distinct()
    spread = places.select("host", "path", F.inline(_expressions(F.col("host"), F.col("path"), shapes)))
    asked = _digest(spread, F.concat("suffix", "prefix")).select("host", "path", "suffix", "digest", "short")
    ruled = table.withColumnsRenamed({"digest": "rule_digest", "short": "rule_short", "verdict": "rule_verdict"})
    exact = (F.col("digest") == F.col("rule_digest")) & (F.col("suffix") == F.col("rule_host"))
    found = asked.join(ruled, (F.col("short") == F.col("rule_short")) & exact)
    order = F.struct(
        (F.char_length("rule_host") + F.char_length("rule_path")).alias("size"),
        F.char_length("rule_host").alias("host_size"),
        F.concat("rule_host", "rule_path").alias("rule"),
        F.col("rule_verdict").alias("verdict"),
    )
    best = found.groupBy("host", "path").agg(F.max(order).alias("best"))
    best = best.select(F.col("host").alias("best_host"), F.col("path").alias("best_path"), "best")
    joined = judged.join(best, (F.col("host") == F.col("best_host")) & (F.col("path") == F.col("best_path")), "left")
    return joined.select(
        *[judged[c] for c in judged.columns],
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


def rules_of(spark, rows: list[tuple[str, str, str]]) -> DataFrame:
    """Rules from (host, path, verdict) tuples."""
    one = [F.struct(*[F.lit(v).alias(n) for n, v in zip(("host", "path", "verdict"), row)]) for row in rows]
    rows = reduce(lambda a, b: a.unionAll(b), [spark.range(1).select(x.alias("r")) for x in one])
    return rows.select("r.*")
