import collections
import math
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from cases import HARD, documents, empty, folder
from pyspark.sql import functions as F

from slicewise.llm import quality_classifier, toxicity
from slicewise.llm.queries import QUERIES

LARGER = "/root/testdata/sf0.1"
BOTH = [("op2_quality_classifier", "quality", 3, 1, 0.97), ("op8_toxicity", "toxic", 5, 0, 0.94)]


@pytest.mark.parametrize("name, label, mod, held, least", BOTH)
def test_held_out_accuracy(spark, name, label, mod, held, least):
    told = {r["doc_id"]: r[label] for r in pq.read_table(f"{LARGER}/labels.parquet").to_pylist()}
    rows = QUERIES[name](spark, LARGER).collect()
    assert len(rows) == pq.read_metadata(f"{LARGER}/documents.parquet").num_rows
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % mod == held) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    pairs = [(told[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in told]
    assert np.mean([a == b for a, b in pairs]) > least


@pytest.mark.parametrize("name, label, mod, held, least", BOTH)
def test_hard_rows_get_scores(spark, tmp_path, name, label, mod, held, least):
    table = documents()
    rows = QUERIES[name](spark, folder(tmp_path, table)).collect()
    assert len(rows) == len(table) and all(0 <= r.score <= 1 for r in rows)
    score = {r.doc_id: r.score for r in rows}
    assert score[900_001] == score[900_002]  # NULL and empty
    assert score[900_004] == score[900_005]


@pytest.mark.parametrize("name, label, mod, held, least", BOTH)
def test_without_labels_or_documents(spark, tmp_path, name, label, mod, held, least):
    rows = QUERIES[name](spark, folder(tmp_path, documents(), labels=empty("labels"))).collect()
    assert {r.score for r in rows} == {0.5}
    other = tmp_path / "none"
    other.mkdir()
    assert QUERIES[name](spark, folder(other, documents([], base=False))).collect() == []


def brute_statistics(text):
    """Each statistic of a text by its definition."""
    text = text or ""
    words, lines, raw = text.split(), [x for x in text.split("\n") if x.strip()], text.encode()
    sizes, n, size = [len(w) for w in words] or [0], max(1, len(words)), max(1, len(raw))
    mean = sum(sizes) / len(sizes)
    bytes_of = [raw.count(bytes([b])) for b in range(256)]
    return [
        math.log(1 + len(words)),
        mean,
        math.sqrt(sum((x - mean) ** 2 for x in sizes) / len(sizes)),
        math.log(1 + max(sizes)),
        len(set(words)) / n,
        len({(a, b) for a, b in zip(words, words[1:])}) / n,
        max((words.count(w) for w in set(words)), default=0) / n if len(words) < 5000 else collections.Counter(words).most_common(1)[0][1] / n,
        math.log(1 + size / max(1, len(lines))),
        len(set(lines)) / max(1, len(lines)),
        -sum(k / size * math.log(k / size) for k in bytes_of if k),
        sum(bytes_of[128:]) / size,
        *[math.sqrt(sum(bytes_of[b] for b in kind) / size) for kind in quality_classifier.CLASSES],
    ]


def brute_rising(x, weight, total):
    """The rising fit by its formula: at each place the largest, over starts, of the least mean to a later end."""
    n, below = len(x), np.concatenate([[0], np.cumsum(total)])
    held = np.concatenate([[0], np.cumsum(weight)])
    fit = [
        max(min((below[b + 1] - below[a]) / (held[b + 1] - held[a]) for b in range(i, n)) for a in range(i + 1))
        for i in range(n)
    ]
    pools = []
    for at, w, value in zip(x, weight, fit):
        if pools and abs(pools[-1][2] - value) < 1e-9:
            pools[-1][0] += at * w
            pools[-1][1] += w
        else:
            pools.append([at * w, w, value])
    return [p[0] / p[1] for p in pools], [p[2] for p in pools]


def brute_ridge(z, y):
    """Ridge weights by least squares on rows for the penalty, none but a trace for the constant."""
    penalty = np.full(z.shape[1], math.sqrt(quality_classifier.RIDGE))
    penalty[-1] = 1e-3
    return np.linalg.lstsq(np.vstack([z, np.diag(penalty)]), np.concatenate([y, np.zeros(z.shape[1])]), rcond=None)[0]


def brute_quality(train, texts):
    """Scores of ``texts`` by a model of the (text, label, fold) in ``train``."""
    stats = np.array([brute_statistics(t) for t, _, _ in train])
    y, fold = (np.array([r[i] for r in train]) for i in (1, 2))
    mean, sd = stats.mean(axis=0), stats.std(axis=0)
    drawn = quality_classifier.projection_of(mean, sd)

    def features(rows):
        scaled = np.clip((rows - mean) / np.where(sd > 1e-9, sd, 1.0), -6, 6)
        waves = np.array([np.cos(drawn.waves.T @ r + drawn.phases) for r in scaled]) * math.sqrt(2 / len(drawn.phases))
        return np.hstack([waves, np.ones((len(rows), 1))])

    z, bins = features(stats), {}
    for k in set(fold.tolist()):
        for raw, label in zip(z[fold == k] @ brute_ridge(z[fold != k], y[fold != k]), y[fold == k]):
            one = bins.setdefault(round(min(1.5, max(-0.5, raw)) * quality_classifier.BINS), [0, 0])
            one[0] += 1
            one[1] += label
    at = sorted(bins)
    knots, values = brute_rising(at, [bins[b][0] for b in at], [bins[b][1] for b in at])
    raw = features(np.array([brute_statistics(t) for t in texts])) @ brute_ridge(z, y)
    return np.interp(raw, np.array(knots) / quality_classifier.BINS, values)


@pytest.mark.parametrize("text", [t for _, t, _, _ in HARD])
def test_statistics_against_their_definitions(text):
    assert np.allclose(quality_classifier.statistics(text), brute_statistics(text))


def test_quality_query_against_brute_force(spark, tmp_path):
    """The whole query: training rows by the remainder, five folds, calibration, the scores of all documents."""
    table = documents()
    where = folder(tmp_path, table)
    rows = QUERIES["op2_quality_classifier"](spark, where).collect()
    said = dict(zip(table["doc_id"].to_pylist(), table["text"].to_pylist()))
    told = {}
    for r in pq.read_table(f"{where}/labels.parquet").to_pylist():
        if r["quality"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1:
            told[r["doc_id"]] = min(r["quality"], told.get(r["doc_id"], 1))
    folds = {r.id: r.fold for r in spark.range(1_000_000).filter(F.col("id").isin(list(told))).selectExpr("id", "pmod(xxhash64(id), 5) AS fold").collect()}
    train = [(said[i], told[i], folds[i]) for i in told if i in said]
    assert len(train) > 20 and len({r[1] for r in train}) == 2
    want = brute_quality(train, [said[r.doc_id] for r in rows])
    assert len(rows) == len(table) and np.allclose([r.score for r in rows], want, atol=2e-3)


def test_normal_equations_are_those_of_all_rows(spark):
    draw = np.random.default_rng(2)
    stats, label, fold = draw.normal(size=(300, 4)), draw.integers(0, 2, 300), draw.integers(0, 5, 300)
    rows = [(s.tolist(), float(y), int(k)) for s, y, k in zip(stats, label, fold)]
    df = spark.createDataFrame(rows, "stats array<double>, label double, fold int").repartition(7)
    projection = quality_classifier.projection_of([0.0] * 4, [1.0] * 4, features=16)
    z = projection.of(stats)
    want = np.stack([z[fold == k].T @ np.hstack([z[fold == k], label[fold == k, None]]) for k in range(5)])
    assert np.allclose(quality_classifier.normal_equations(df, projection), want)


def test_random_features_approximate_the_kernel():
    draw = np.random.default_rng(3)
    rows = draw.normal(size=(40, 6))
    z = quality_classifier.projection_of([0.0] * 6, [1.0] * 6, features=8192).of(rows)[:, :-1]
    apart = ((rows[:, None] - rows[None]) ** 2).sum(axis=2)
    assert np.abs(z @ z.T - np.exp(-apart / 2 / 6)).max() < 0.08


def test_isotonic_pools_violators():
    knots, values = quality_classifier.isotonic(np.array([0.0, 1, 2, 3]), np.array([1.0, 1, 1, 1]), np.array([0.0, 1, 0, 1]))
    assert values.tolist() == [0, 0.5, 1] and knots.tolist() == [0, 1.5, 3]


def test_repeated_and_null_labels(spark):
    stats = spark.createDataFrame([(1, [1.0]), (2, [2.0])], "doc_id long, stats array<double>")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1)], "doc_id long, quality int")
    rows = quality_classifier.training_rows(stats, labels, F.lit(True)).collect()
    assert [(r.stats, r.label) for r in rows] == [([1.0], 0.0)]


def test_unseen_spelling_of_a_toxic_word():
    draw = np.random.default_rng(4)
    words = ["".join(draw.choice(list("aeioutrns"), size=6)) for _ in range(400)]
    texts, labels = [], []
    for i in range(600):
        said = list(draw.choice(words, size=60))
        if i % 3 == 0:
            said[draw.integers(60)] = "horribleton"
        texts.append(toxicity.plain(" ".join(said)))
        labels.append(int(i % 3 == 0))
    model = toxicity.train_model(texts, np.array(labels), np.ones(600))
    clean = " ".join(draw.choice(words, size=200))
    scores = model.scores([toxicity.plain(clean), toxicity.plain(clean + " horriblet0n"), toxicity.plain("Horribletonn " + clean)])
    assert scores[0] < 0.5 < min(scores[1:])


def test_scores_do_not_depend_on_the_batch():
    model = toxicity.Model(np.random.default_rng(0).normal(size=toxicity.BUCKETS), 0.1)
    texts = [toxicity.plain(t) for _, t, _, _ in HARD]
    assert np.allclose(model.logits(texts), [model.logits([t])[0] for t in texts])


def test_every_subword_of_a_word_is_counted():
    data = np.frombuffer(b" abc d ", dtype=np.uint8)
    _, _, count = toxicity.word_sums(data, np.zeros(toxicity.BUCKETS))
    # " abc ": three of 3 bytes, two of 4, one of 5, the word; " d ": one of 3, the word.
    assert count.tolist() == [7, 2]


def brute_logit(text, model):
    """Most toxic window of eight words, from each word's n-grams one by one."""
    wrap, spread = (1 << 64) - 1, int(toxicity._SPREAD)

    def value(h):
        h = ((h ^ (h >> 29)) * spread) & wrap
        return model.value[h >> (64 - (toxicity.BUCKETS.bit_length() - 1))]

    words = []
    for word in (text or "").lower().encode(errors="replace").split():
        codes = [int(toxicity._CODES[b]) for b in b" %s " % word]
        values = []
        for n in toxicity.GRAMS:
            for i in range(len(codes) - n + 1):
                h = 0
                for c in codes[i : i + n]:
                    h = (h * spread + c) & wrap
                values.append(value((h + n) & wrap))
        values.append(value(sum(c * pow(spread, k, 1 << 64) for k, c in enumerate(codes[1:-1])) & wrap))
        words.append(values)
    windows = [sum(words[i : i + 8], []) for i in range(max(1, len(words) - 7))] if words else []
    return max((sum(w) / len(w) for w in windows), default=0.0) + model.bias


def test_toxicity_scores_against_each_ngram():
    draw = np.random.default_rng(4)
    model = toxicity.Model(draw.normal(size=toxicity.BUCKETS), -0.5)
    made = [" ".join("".join(draw.choice(list("abé-x"), size=draw.integers(1, 9))) for _ in range(n)) for n in (1, 7, 8, 9, 30, 200)]
    texts = [None, "", " \n", "A b", "\u00a0 nbsp", *made]
    got = model.logits([toxicity.plain(t) for t in texts])
    assert np.allclose(got, [brute_logit(t, model) for t in texts])


def test_a_toxic_run_scores_the_same_at_every_place():
    model = toxicity.Model(np.full(toxicity.BUCKETS, -1.0), 0.0)
    run = [f"bad{k}word" for k in range(8)]
    for at, bucket in toxicity.subwords(np.frombuffer(toxicity.plain(" ".join(run)), dtype=np.uint8)):
        model.value[bucket] = 1.0
    texts = [" ".join([f"fine{i}" for i in range(k)] + run + [f"good{i}" for i in range(20 - k)]) for k in range(13)]
    scores = model.logits([toxicity.plain(t) for t in texts])
    assert np.allclose(scores, scores[0]) and scores[0] == 1.0


def test_training_texts_are_bounded(spark):
    docs = spark.createDataFrame([(i, "x" * 100) for i in range(40)] + [(40, "y" * 500), (41, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(42)], "doc_id long, toxic int")
    few = toxicity.training_texts(docs, labels, F.lit(True), per_class=15, max_bytes=200, total_bytes=1050).collect()
    assert sorted((r.label, len(r.text)) for r in few) == [(0, 100)] * 10 + [(1, 100)] * 10
    every = toxicity.training_texts(docs, labels, F.lit(True)).collect()
    assert len(every) == 41
