import re

from slicewise.llm import decontamination
from slicewise.llm.common import likely_rows, runs


def found(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id string, text string")
    rows = decontamination.find_matches(d, b, **options).collect()
    return sorted((str(r.doc_id), [(s.start, s.stop, s.item_key.rpartition(":")[0]) for s in r.spans], [k.rpartition(":")[0] for k in r.near]) for r in rows)


ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"


def test_words_are_those_of_the_pattern():
    text = "A-b_c 1é2 \x00\x7f{x}  \U0001f600Z"
    lower = text.translate({c: c + 32 for c in range(65, 91)})
    assert [w.decode() for w in decontamination.words(text)] == re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def test_blocks_of_items_give_the_same_matches(spark):
    docs = [(1, "x " + ITEM.upper() + " y"), (2, " ".join(ITEM.split()[:10])), (3, " ".join(ITEM.split()[:9])), (4, "pi rho"), (5, None)]
    items = [("a", ITEM), ("b", "rho"), ("b", "pi"), ("c", None), ("d", "?!"), ("e", "sigma tau"), (None, "pi rho")]
    want = [("1", [(1, 13, "a")], []), ("2", [(0, 10, "a")], []), ("3", [], []), ("4", [(0, 1, "b"), (1, 2, "b")], []), ("5", [], [])]
    assert found(spark, docs, items) == want
    assert found(spark, docs, items, block_words=5) == want


def test_proximity(spark):
    words = ITEM.split()
    docs = [
        (1, " ".join(words[:5] + ["inserted"] + words[5:])),
        (2, " ".join(words[:3] + [words[4], words[3]] + words[5:])),
        (3, " ".join(words[:5] + ["far"] * 9 + words[5:])),
        (4, " ".join(words)),
    ]
    assert found(spark, docs, [("a", ITEM)], slop=2) == [("1", [], ["a"]), ("2", [], ["a"]), ("3", [], []), ("4", [(0, 12, "a")], [])]
    assert [r[2] for r in found(spark, docs, [("a", ITEM)])] == [[], [], [], []]


def test_repeated_rows_and_null_ids(spark):
    docs = [(1, ITEM), (1, ITEM), (1, "other"), (None, ITEM), (None, None)]
    hit = [(0, 12, "a")]
    want = [("1", [], []), ("1", hit, []), ("1", hit, []), ("None", [], []), ("None", hit, [])]
    assert found(spark, docs, [("a", ITEM), ("a", ITEM)]) == want


def test_likely_rows(spark):
    """Every row with a key of the others stays, once; few others do, unless the keys are many for the bits."""
    rows = spark.createDataFrame([(k // 2, f"t{k}", k) for k in range(4000)] + [(None, "none", 0)], "key long, text string, bit int")
    keys = spark.range(5, 500, 5).selectExpr("id AS key").unionAll(spark.range(5, 500, 5).selectExpr("id AS key"))
    asked = {k for k in range(10, 1000, 10)} | {k + 1 for k in range(10, 1000, 10)}
    found = likely_rows(rows, keys, "key")
    assert found.columns == rows.columns and "hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()
    got = [r.bit for r in found.filter("key IS NOT NULL").collect()]
    assert len(got) == len(set(got)) == len(asked) and set(got) == asked
    some = [r.bit for r in likely_rows(rows, keys, "key", bits=1024).collect()]
    assert asked <= set(some) and len(asked) < len(some) < 1000
    assert likely_rows(rows, spark.range(5000).selectExpr("id AS key"), "key", bits=64).count() == 4001
    assert likely_rows(rows, keys.limit(0), "key").count() == 0


def test_runs_go_over_batches():
    import pandas as pd

    keys = [1, 1, 2, 2, 2, 3, 3, 4]
    for cuts in ([8], [1] * 8, [2, 0, 3, 3], [3, 5]):
        at, batches = 0, []
        for n in cuts:
            batches.append(pd.DataFrame({"k": keys[at : at + n], "v": range(at, at + n)}))
            at += n
        assert [(g["k"].iloc[0], len(g)) for g in runs(batches, ["k"])] == [(1, 2), (2, 3), (3, 2), (4, 1)]
