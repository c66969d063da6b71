"""From raw documents to a training mix: five stages, each on what its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are written as Parquet and read again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from slicewise.llm import decontamination, line_dedup, mixing, quality_classifier, simhash_dedup
from slicewise.llm.common import likely_rows, row_key, same_row, written

MIN_SCORE = 0.5
MIN_SITES, MIN_TEXTS = 10, 10


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that score below ``MIN_SCORE`` go. It learns from all labels of these documents."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    # Texts stay where they are: a filter of the labelled ids lets some others pass, and training joins by id.
    ids = labels.select(F.col("doc_id").try_cast(docs.schema["doc_id"].dataType).alias("doc_id"))
    stats = written(quality_classifier.document_statistics(likely_rows(docs, ids, "doc_id")), "statistics")
    model = quality_classifier.train(stats, labels, F.lit(True))
    return docs.filter(quality_classifier.score_texts(model)(F.col("text")) >= MIN_SCORE)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: boilerplate lines go from the texts, whatever share of a text they are. ``n_chars`` follows.

    A text that loses nothing stays as it is, one of nothing but boilerplate becomes empty.
    """
    cleaned = line_dedup.clean_documents(docs, MIN_SITES, min_texts=MIN_TEXTS)
    new = {"text": F.col("cleaned"), "n_chars": F.when(F.col("n_removed") > 0, F.char_length("cleaned")).otherwise(F.col("row.n_chars"))}
    return cleaned.select(*[new.get(c, F.col("row")[c]).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


def keyed(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as ``row``, with the key that tells them apart."""
    return docs.select(*row_key(), F.struct(*docs.columns).alias("row"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: of each group of rows whose fingerprints link (four words, 4 of 64 bits or fewer) one row stays.

    It is the one with the smallest id (NULL last), then the smallest text hash; of rows equal in both the one with the
    smallest hash of all columns. Other texts of an id that goes are judged by their own group.
    """
    linked = written(simhash_dedup.near_duplicates(docs), "near-copies")
    counted = linked.groupBy("component", "doc_id", "text_key").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key", "n")).alias("first")
    kept = counted.groupBy("component").agg(first).select("first.doc_id", "first.text_key", "first.n")
    kept = written(kept, "kept")
    left, once, again = keyed(docs), kept.filter("n = 1"), kept.filter("n > 1")
    alone = left.join(once.hint("shuffle_hash"), same_row(left, once), "left_semi").select("row.*")
    equal = left.join(again.hint("shuffle_hash"), same_row(left, again), "left_semi").groupBy("doc_id", "text_key")
    return alone.unionAll(equal.agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row.*"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: rows with an exact window of a benchmark item go; other texts of their ids stay."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    matched = decontamination.find_matches(docs, items).filter(F.size("spans") > 0)
    gone = written(matched.select("doc_id", "text_key").distinct(), "leaks")
    left = keyed(docs)
    return left.join(gone, same_row(left, gone), "left_anti").select("row.*")


def sample_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: documents drawn so that source, language and topic meet their target shares of the tokens.

    ``topic``, ``n_tokens`` and ``probability`` are added, but for those whose name a column of the documents has already.
    """
    mixed = mixing.mix_documents(docs).filter("sampled")
    more = {"topic": "labels.topic", "n_tokens": "n_tokens", "probability": "probability"}
    taken = {c.lower() for c in docs.columns}
    return mixed.select("row.*", *[F.col(source).alias(name) for name, source in more.items() if name not in taken])


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_boilerplate),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("mixing to target weights", sample_mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


# Fingerprint links, a fitted model and a raked sample are beyond SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None
