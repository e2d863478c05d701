"""Rules and host reputations."""

import pytest
from pyspark.sql import functions as F

from tickstone.llm import urlfilter

URLS = [
    ("http://WWW.Example.COM/en/1?x#y", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("https://m.example.com/en/", "m.example.com", "/en/", "example.com/en/", "block"),
    ("https://example.com/EN/", "example.com", "/EN/", "com/", "allow"),
    ("https://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    ("http://a.net/es/x", "a.net", "/es/x", "net/es/", "block"),
    ("http://a.net/fr", "a.net", "/fr", None, "allow"),
    ("http://a.com?q=/en/", "a.com", "", None, "allow"),
    ("http://a.com#/", "a.com", "", None, "allow"),
    ("x://y://z/p", "y:", "//z/p", None, "allow"),
    ("no scheme.com/en/", "", "", None, "allow"),
    ("http://", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
]


def test_rules(spark):
    pages = spark.createDataFrame(
        [(i, u[0], "clash") for i, u in enumerate(URLS)], "page_id bigint, url string, verdict string"
    )
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = {r["page_id"]: r for r in urlfilter.filter_urls(pages, labels).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(URLS):
        assert tuple(got[i][c] for c in ("host", "path", "rule", "verdict")) == (host, path, rule, verdict)


@pytest.fixture(scope="module")
def judged(spark):
    rows, labels = [], []
    for i in range(600):  # one host with most rows, one bad, one thin, one unlabelled
        host = "big.org" if i < 400 else "bad.org" if i < 480 else "good.org" if i < 590 else "new.org"
        rows.append((i, f"http://{host}/p{i}"))
        if i < 590 and i % 2 == 0:
            labels.append((i, 0 if host == "bad.org" or i % 20 == 0 else 1, 0))
    rows += [(700, "http://once.org/"), (700, "http://once.org/"), (None, "http://big.org/")]
    labels += [(700, 0, 0), (700, 1, None), (4, None, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    return pages, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_reputation_blocks_what_is_surely_bad(judged):
    out = urlfilter.filter_urls(*judged).groupBy("host").agg(
        F.collect_set("verdict").alias("v"), F.count("*").alias("n")
    )
    got = {r["host"]: (r["v"], r["n"]) for r in out.collect()}
    assert got["bad.org"] == (["block"], 80)
    assert got["big.org"] == (["allow"], 401)
    assert got["good.org"] == (["allow"], 110)
    assert got["new.org"] == (["allow"], 10)
    assert got["once.org"][1] == 2


def test_thin_evidence_is_shrunk(spark):
    rows = [(f"h{k}.org", k == 0 or i == 0) for k in range(40) for i in range(10)] + [("thin.org", True)]
    outcomes = spark.createDataFrame(rows, "host string, is_bad boolean")
    got = {r["host"]: r for r in urlfilter.reputations(outcomes).collect()}
    assert got["thin.org"]["mean"] < got["h0.org"]["mean"] <= 1
    assert got["h1.org"]["bound"] < got["h1.org"]["mean"] < got["thin.org"]["mean"]


def test_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert urlfilter.filter_urls(pages, labels).collect() == []
