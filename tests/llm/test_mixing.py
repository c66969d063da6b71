import numpy as np
import pandas as pd
from cases import documents, empty, folder
from pyspark.sql import functions as F

from slicewise.llm import mixing
from slicewise.llm.queries import QUERIES


def brute_rake(cells, targets, most=None, rounds=30, stop=False):
    weight, error = cells["tokens"].to_numpy(float), 0.0
    for turn in range(rounds):
        before, error = error, 0.0
        for dim, target in targets.items():
            now = pd.Series(weight).groupby(cells[dim].to_numpy()).sum()
            scale = cells[dim].map({v: target[v] / now[v] for v in target}).to_numpy()
            error, weight = max(error, np.abs(scale - 1).max()), weight * scale
            weight = weight if most is None else np.minimum(weight, most)
        if stop and (error <= mixing.TOLERANCE or turn and error > mixing.STALLED * before):
            break
    return weight


CELLS = pd.DataFrame([("a", "x", 90), ("a", "y", 10), ("b", "x", 50), ("b", "y", 50), ("c", "x", 5)], columns=["s", "l", "tokens"])
SHARES = {"s": {"a": 0.3, "b": 0.4, "c": 0.3}, "l": {"x": 0.6, "y": 0.4}}


def raked(spark, most=None, shares=SHARES, **options):
    targets = {d: spark.createDataFrame(list(t.items()), "value string, share double") for d, t in shares.items()}
    weighed, error, rounds = mixing.rake(spark.createDataFrame(CELLS), targets, most, **options)
    return weighed.toPandas(), error, rounds


def test_marginals_are_met(spark):
    got, error, _ = raked(spark, tolerance=1e-9, max_rounds=60)
    assert error < 1e-9
    for dim, shares in SHARES.items():
        assert np.allclose(got.groupby(dim).weight.sum()[list(shares)], list(shares.values()))
    want = CELLS.assign(want=brute_rake(CELLS, SHARES, rounds=60)).merge(got, on=["s", "l"])
    assert np.allclose(want.want, want.weight)


def test_bounds_and_targets_of_any_scale(spark):
    most = CELLS["tokens"].to_numpy() / 150
    shares = {"s": {"a": 35.0, "b": 35.0, "c": 3.0, "nowhere": 9.0}, "l": SHARES["l"]}
    got, error, rounds = raked(spark, F.col("tokens") / 150, shares)
    assert (got.weight <= got.tokens / 150 + 1e-12).all() and rounds < 30
    scaled = {"s": {k: v / 73 for k, v in shares["s"].items() if k != "nowhere"}, "l": SHARES["l"]}
    want = CELLS.assign(want=brute_rake(CELLS, scaled, most, rounds)).merge(got, on=["s", "l"])
    assert np.allclose(want.want, want.weight)


def test_targets_that_exclude_each_other_end(spark):
    _, error, rounds = raked(spark, shares={"s": {"c": 1.0}, "l": {"y": 1.0}})
    assert rounds <= 30 and error >= 0


def test_a_step_needs_one_join_and_no_step_before_it(spark, monkeypatch):
    joins, write = [], mixing.written

    def counted(df, name):
        if name == "cells":
            joins.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join Inner"))
        return write(df, name)

    monkeypatch.setattr(mixing, "written", counted)
    _, _, rounds = raked(spark, F.col("tokens") / 150)
    assert rounds > 1 and joins[1:] == [1] * (len(SHARES) * rounds)


def test_targets_that_are_not_met_are_told(spark):
    rows = [(i, "a b c", ["a", "b"][i % 2], ["x", "y"][i % 2]) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")

    def error(shares, keep=0.5):
        targets = {d: spark.createDataFrame(list(t.items()), "value string, share double") for d, t in shares.items()}
        mixed = mixing.mix(docs, {"source": F.col("source"), "lang": F.col("lang")}, F.lit(3), targets, keep=keep).collect()
        assert len({r.target_error for r in mixed}) == 1
        return mixed[0].target_error

    assert error({"source": {"a": 0.4, "b": 0.6}, "lang": {"x": 0.4, "y": 0.6}}) <= mixing.TOLERANCE
    assert error({"source": {"a": 0.9, "b": 0.1}, "lang": {"x": 0.1, "y": 0.9}}) > 0.1
    assert error({"source": {"a": 0.9, "b": 0.1}, "lang": {"x": 0.9, "y": 0.1}}, keep=0.9) > 0.1  # more than there is of a


def test_query_on_hard_rows(spark, tmp_path):
    table = documents()
    got = QUERIES["op10_mixing"](spark, folder(tmp_path, table)).toPandas()
    assert len(got) == len(table) and got.probability.between(0, 1).all()
    tokens = {i: len((t or "").replace("\xa0", "_").replace("\x1c", "_").split()) for i, t in zip(*(table[c].to_pylist() for c in ("doc_id", "text")))}
    rows = got.set_index("doc_id")
    assert rows.n_tokens.to_dict() == tokens
    assert (rows.probability[[900_001, 900_002, 900_003]] == 0).all() and not rows.sampled[[900_001, 900_002, 900_003]].any()
    assert rows.source[900_004] is None and rows.topic[900_001] is None
    # The cells' chances are those of a plain computation.
    got[["source", "lang", "topic"]] = got[["source", "lang", "topic"]].fillna("NULL")
    cells = got.groupby(["source", "lang", "topic"], as_index=False).agg(tokens=("n_tokens", "sum"), p=("probability", "max"))
    cells = cells[cells.tokens > 0].reset_index(drop=True)
    shares = {}
    for dim in ("source", "lang", "topic"):
        t = cells.groupby(dim).tokens.sum() ** mixing.POWER
        shares[dim] = (t / t.sum()).to_dict()
    wanted = mixing.KEEP * cells.tokens.sum()
    want = brute_rake(cells, shares, (cells.tokens / wanted).to_numpy(), stop=True) * wanted / cells.tokens
    assert np.allclose(want, cells.p, rtol=1e-6)
    # The draw follows the chances.
    spread = np.sqrt((got.probability * (1 - got.probability)).sum())
    assert abs(got.sampled.sum() - got.probability.sum()) < 4 * spread


def test_equal_rows_are_drawn_together_and_draws_repeat(spark):
    rows = [(i % 50, f"word {i % 50}", "en", f"s{i % 3}") for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    once, again = ({(r.row.doc_id, r.row.text, r.sampled) for r in mixing.mix_documents(x).collect()} for x in (df, df.repartition(5)))
    assert once == again


def test_empty_table(spark, tmp_path):
    assert QUERIES["op10_mixing"](spark, folder(tmp_path, empty("documents"))).collect() == []
