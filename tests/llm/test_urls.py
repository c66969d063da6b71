import time

import pytest

from slicewise.llm.url_filters import judge_urls, rules_of


def judged(spark, urls, rules, default="allow"):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    rows = judge_urls(pages, rules_of(spark, rules), default).orderBy("page_id").collect()
    return [(r.host, r.path, r.rule, r.verdict) for r in rows]


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow")]


def test_longest_rule_wins_for_hosts_and_their_subdomains(spark):
    urls = ["http://EXAMPLE.com/en/a?x#y", "https://www.example.com/en/", "http://a.www.example.com/en/b", "http://example.com/english"]
    assert [r[2:] for r in judged(spark, urls, RULES)] == [
        ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("www.example.com/en/", "allow"), ("com/", "allow"),
    ]


def test_urls_without_parts(spark):
    urls = [None, "", "no scheme", "http://", "http://com", "http://x.com?q", "x://h/a\nb", "a://b://c/d", "http://xcom/"]
    rows = judged(spark, urls, RULES, "block")
    assert [r[:2] for r in rows] == [
        ("", ""), ("", ""), ("", ""), ("", ""), ("com", ""), ("x.com", ""), ("h", "/a\nb"), ("b:", "//c/d"), ("xcom", "/"),
    ]
    assert all(r[2:] == (None, "block") for r in rows)


def test_repeated_urls_and_equal_rules(spark):
    rules = [("com", "/", "allow"), ("COM", "/", "block"), ("", "/", "block"), ("com", "/x", "allow")]
    rows = judged(spark, ["http://a.com/y", "http://a.com/y", "http://a.com/xyz"], rules)
    assert [r[2:] for r in rows] == [("com/", "block"), ("com/", "block"), ("com/x", "allow")]


def test_other_columns_stay(spark):
    pages = spark.createDataFrame([("http://a.com/", "z", "s", "d")], "url string, suffix string, short string, digest string")
    row = judge_urls(pages, rules_of(spark, RULES)).first()
    assert (row.suffix, row.short, row.digest, row.verdict) == ("z", "s", "d", "allow")


def test_cost_grows_with_the_length_of_a_url(spark, tmp_path):
    rules = [*RULES, ("net", "/" + "x/" * 7, "block"), ("net", "/x/xy", "block")]
    urls = [f"http://www.example.net/{'x/' * n}" for n in (6, 7, 20_000)] + [f"http://{'a.' * 20_000}com/", "http://n.net/x/xyz"]
    spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").write.parquet(f"{tmp_path}/pages")
    begun = time.monotonic()
    rows = judge_urls(spark.read.parquet(f"{tmp_path}/pages"), rules_of(spark, rules)).orderBy("page_id").collect()
    assert time.monotonic() - begun < 30
    assert [r.rule for r in rows] == [None, "net/x/x/x/x/x/x/x/", "net/x/x/x/x/x/x/x/", "com/", "net/x/xy"]


def test_every_shape_against_each_rule(spark):
    hosts, paths = ["a", "b.a", "c.b.a", ".a", "a."], ["", "/", "/p", "/p/", "//", "/p/q/", "/p/qr", "/p/qr/"]
    rules = [(h, p, "block" if (i + j) % 2 else "allow") for i, h in enumerate(hosts[:4]) for j, p in enumerate(paths) if (i * 3 + j) % 4]
    urls = [f"x://{h}{p}" for h in [*hosts, "xb.a", "z.c.b.a"] for p in [*paths, "/p/q", "/p/qr/s"]]
    got = judged(spark, urls, rules, "none")
    for url, (host, path, rule, verdict) in zip(urls, got):
        fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (rule, verdict) == (max(fits)[2:] if fits else (None, "none")), url


def test_no_rules_and_clashing_names(spark):
    pages = spark.createDataFrame([("http://a.com/", "z")], "url string, host string")
    with pytest.raises(ValueError, match="host"):
        judge_urls(pages, rules_of(spark, RULES))
    row = judge_urls(pages.select("url"), rules_of(spark, [("", "/", "block")])).first()
    assert (row.rule, row.verdict) == (None, "allow")
