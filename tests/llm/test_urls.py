"""Rules against plain Python; the trees' verdicts."""

import re

import pytest

from sylvatab.llm import urls
from sylvatab.llm.queries import op4_urls

SF = "/root/testdata/sf0.01"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    return "".join(c.lower() if c.isascii() else c for c in host), path


def rule(host, path, rules=urls.RULES):
    fits = []
    for r in rules:
        name, start = r[: r.index("/")], r[r.index("/") :]
        if (host == name or host.endswith("." + name)) and path.startswith(start):
            fits.append(r)
    return min(fits, key=lambda r: (-len(r), r), default=None)


URLS = [
    None,
    "",
    "no scheme.net/",
    "http://",
    "http://net",
    "http://net/",
    "HTTP://A.NET/x",
    "http://xnet/",
    "https://m.Example.NET/en/1?x=1#top",
    "https://example.net/EN/1",
    "https://example.net?en/",
    "https://myexample.com/de/",
    "https://www.example.com/de/a/b?c=d&e=f&&g",
    "ftp://Ünï.org/fr/é",
    "http://a.org/fr#x",
    "http://a.org/fr/#x",
    "x://y://example.net/en/",
    "http://a.org\n/fr/",
    "http://host.example/" + "a" * 50_000,
] + [f"http://h{i}.example.{t}/{p}/{i}" for i in range(12) for t in ("net", "com", "org") for p in ("en", "de", "fr")]


def test_like_plain_python(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id bigint, url string").repartition(3)
    rows = urls.judge(pages).collect()
    assert len(rows) == len(URLS)
    for r in rows:
        host, path = parts(URLS[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule(host, path))
        assert r.verdict == (urls.RULES[r.rule] if r.rule else "block" if r.p_block >= 0.5 else "allow")
        assert 0 <= r.p_block <= 1


def test_ties_and_order(spark):
    rules = {"b.c/x": "block", "c/xyzw": "allow", "c/": "allow", "c/xy": "block"}
    hosts = ["http://b.c/xyzw", "http://b.c/x", "http://c/xy", "http://c/z"]
    rows = urls.judge(spark.createDataFrame(list(enumerate(hosts)), "page_id int, url string"), rules).collect()
    assert [r.rule for r in sorted(rows)] == [rule(*parts(u), rules) for u in hosts]


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], "page_id bigint, url string, verdict string, host int")
    assert urls.judge(empty).collect() == []
    one = spark.createDataFrame([(1, "http://a.net/"), (2, None), (2, None), (None, "http://a.com/")], empty.schema[:2])
    rows = urls.judge(one.withColumn("path", one.url)).collect()
    assert sorted((r.page_id or 0, r.verdict, r.p_block) for r in rows) == [
        (0, "allow", None), (1, "block", None), (2, "allow", None), (2, "allow", None),
    ]


def test_entropy(spark):
    rows = spark.createDataFrame([("aabb",), ("abcd",), ("aaaa",), ("",)], "t string")
    assert [r[0] for r in rows.select(urls.entropy(rows.t)).collect()] == pytest.approx([1.0, 2.0, 0.0, 0.0])


def test_held_out_accuracy(spark, monkeypatch):
    """Trees fitted on a part of the ruled URLs agree with the rules on all."""
    monkeypatch.setattr(urls, "TRAINED_ON", 400)
    rows = urls.judge(spark.read.parquet("/root/testdata/sf0.1/pages.parquet")).filter("rule is not null").collect()
    right = sum((r.p_block >= 0.5) == (r.verdict == "block") for r in rows)
    assert right / len(rows) > 0.9


def test_shares_are_of_all_urls(spark):
    rows = [("a", "block")] * 30 + [("a", None)] * 60 + [("b", "allow")] * 5
    got = urls.shares(spark.createDataFrame(rows, "last string, known string"), "last").collect()
    assert {r["last"]: r.last_share for r in got} == pytest.approx({"a": 35 / 100, "b": 5 / 15})


def test_shares_are_not_of_the_sample(spark, monkeypatch):
    """Suffix statistics do not depend on the size of the sample the trees are fitted on."""
    seen, shares = [], urls.shares
    monkeypatch.setattr(urls, "TRAINED_ON", 100)
    monkeypatch.setattr(urls, "shares", lambda df, suffix: seen.append(df.count()) or shares(df, suffix))
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    urls.judge(pages)
    assert seen == [pages.count()] * len(urls.SUFFIXES)


def test_a_hot_url(spark, monkeypatch):
    """A URL on a third of all rows is one row of the sample, and weighs as all of them."""
    seen, fit = [], urls.fit
    monkeypatch.setattr(urls, "fit", lambda learnt: seen.append(learnt.select("url", "rows").collect()) or fit(learnt))
    rows = [(i, u) for i, u in enumerate(URLS + ["http://hot.example.net/de/"] * 60)]
    urls.judge(spark.createDataFrame(rows, "page_id bigint, url string")).collect()
    weights = {r.url: r.rows for r in seen[0]}
    assert len(seen[0]) == len(weights) and weights["http://hot.example.net/de/"] == 60
    assert sum(weights.values()) == sum(rule(*parts(u)) is not None for _, u in rows)


def test_query(spark):
    rows = op4_urls(spark, SF).collect()
    given = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert {r.page_id: (r.host, r.path) for r in rows} == {i: parts(u) for i, u in given.items()}
    assert all(r.rule == rule(r.host, r.path) and r.verdict in ("allow", "block") for r in rows)
