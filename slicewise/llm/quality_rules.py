"""Quality rules judged by host: rule failures per host, rates shrunk by an empirical beta prior, verdicts joined back.

Everything is computed by column expressions: the counts of a text inside its own row, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import let, row_key, words_of, written

WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
MAX_SYMBOL_PERCENT, MAX_DUP_LINE_PERCENT = 20, 50
MAX_HOST_RATE = 0.5
RULES = ["short", "repeats", "symbols", "dup_lines"]


def _covered(hashes: Column) -> Column:
    """Words inside windows whose hash occurs more than once; ``hashes`` has one entry per window start."""
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(pairs: Column) -> Column:
        equal = lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
        kept = F.filter(
            pairs, lambda e, k: equal(F.get(pairs, k - 1), e) | equal(F.get(pairs, k + 1), e)
        )
        return F.sort_array(F.transform(kept, lambda e: e["i"]))

    zero = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
    step = lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"))
    return F.aggregate(let(pairs, repeated), zero, step, lambda a: a["n"])


def repeat_words(words: Column) -> Column:
    """Words in 8-word windows found twice or more, the first included."""

    def of(h: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)])
        )
        return let(windows, lambda g: F.when(F.size(F.array_distinct(g)) < F.size(g), _covered(g)).otherwise(0))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < WINDOW, 0).otherwise(let(hashed, of))


def text_counts(text: Column) -> dict[str, Column]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_lines of a whole text; NULL counts as empty."""
    text = F.coalesce(text, F.lit(""))
    words = words_of(text)
    with_word = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    counted = let(
        words,
        lambda w: F.struct(
            F.size(w).alias("n_words"), F.char_length(F.array_join(w, "")).alias("word_chars"), repeat_words(w).alias("n")
        ),
    )
    lines = let(
        with_word, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"))
    )
    return {
        "counted": counted,
        "lines": lines,
        "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
    }


def document_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One row per row of ``docs``: its key, its host and its counts. The text itself is not carried on."""
    counts = docs.select(*row_key(doc_id, text), F.col(host).cast("string").alias("host"), *[
        c.alias(n) for n, c in text_counts(F.col(text)).items()
    ])
    return counts.select(
        "doc_id",
        "text_key",
        "host",
        F.col("counted.n_words").cast("long").alias("n_words"),
        F.col("counted.word_chars").cast("long").alias("word_chars"),
        "n_symbols",
        F.col("lines.dup").cast("long").alias("n_dup_lines"),
        F.col("counted.n").cast("long").alias("n_repeat_words"),
        F.col("lines.n").cast("long").alias("n_lines"),
    )


def rule_failures() -> dict[str, Column]:
    """Which rule a document fails; ``short`` and ``repeats`` are the base rules."""
    return {
        "short": F.col("n_words") < MIN_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"),
        "symbols": 100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("n_words"),
        "dup_lines": 100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines"),
    }


def host_rates(counts: DataFrame) -> DataFrame:
    """Per host: documents, failures of each rule and of any, and the rate of failing documents shrunk to the mean.

    The beta prior comes from the hosts themselves: its mean is the failing share of all documents, its strength follows
    from the spread of the host rates by the method of moments. Hosts that differ no more than chance allows are all
    drawn to the mean. Documents without a host belong to none and take no part.
    """
    fails = rule_failures()
    failed = counts.filter("host IS NOT NULL").select("host", *[c.cast("long").alias(n) for n, c in fails.items()])
    hosts = failed.withColumn("any", F.greatest(*RULES)).groupBy("host")
    hosts = hosts.agg(F.count("*").alias("host_docs"), *[F.sum(n).alias(f"host_{n}") for n in [*RULES, "any"]])
    n, bad = F.col("host_docs"), F.col("host_any")
    total = hosts.agg(F.sum(n).alias("docs"), F.sum(bad).alias("bad"), F.sum(n * n).alias("squares"), F.count("*").alias("k"),
                      F.sum(bad * bad / n).alias("pull"))
    mean = F.col("bad") / F.col("docs")
    noise = mean * (1 - mean)
    between = F.col("pull") - F.col("docs") * mean * mean - noise * (F.col("k") - 1)
    room = noise * (F.col("docs") - F.col("squares") / F.col("docs") - (F.col("k") - 1))
    alike = F.when(room > 0, F.greatest(F.lit(1e-6), F.least(F.lit(1.0), between / room))).otherwise(1e-6)
    prior = total.select(mean.alias("mean"), (1 / alike - 1).alias("strength")).first()
    mean, strength = prior.mean, prior.strength  # NULL, and never used, where there are no hosts
    rate = (bad + F.lit(mean) * F.lit(strength)) / (n + F.lit(strength))
    return hosts.withColumn("host_rate", rate.cast("double"))


def judge_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", max_host_rate: float = MAX_HOST_RATE
) -> DataFrame:
    """Counts, base failure, host rate and verdict of every row of ``docs``.

    ``kept`` is false for documents that fail a base rule and for all documents of a host whose shrunk failure rate is
    over ``max_host_rate``. A document without a host is judged by the base rules alone. NULL and empty texts have no
    words and fail. Equal rows get equal results. An empty table gives an empty result.
    """
    counts = written(document_counts(docs, doc_id, text, host), "quality-counts")
    hosts = written(host_rates(counts).withColumnRenamed("host", "of_host"), "quality-hosts")
    fails = rule_failures()
    joined = counts.join(hosts, F.col("host") == F.col("of_host"), "left")
    base = fails["short"] | fails["repeats"]
    blocked = F.coalesce(F.col("host_rate") > max_host_rate, F.lit(False))
    return joined.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base.alias("base_failed"),
        (~base & ~blocked).alias("kept"),
        "host",
        "host_docs",
        *[f"host_{n}" for n in RULES],
        F.round("host_rate", 6).alias("host_rate"),
        blocked.alias("host_blocked"),
    )
