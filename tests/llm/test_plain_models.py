"""Learned models against plain versions of their formulas."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickstone.llm import langid, lm, quality, urlfilter

# --- language ID ---------------------------------------------------------------


def plain_symbols(text):
    out = [" "]
    for c in text:
        s = c.lower()[0] if c.isalpha() else " "
        if s != " " or out[-1] != " ":
            out.append(s)
    return out + ([" "] if out[-1] != " " else [])


def plain_grams(text):
    row = plain_symbols(text)
    padded = [" "] * (langid.ORDER - 1) + row
    return [tuple(padded[k:k + langid.ORDER]) for k in range(1, len(row))]


def plain_model(texts, size):
    """Interpolated Kneser-Ney with dictionaries: a probability function."""
    top = Counter(g for t in texts for g in plain_grams(t))
    levels = {langid.ORDER: top}
    for n in range(langid.ORDER - 1, 0, -1):
        levels[n] = Counter(g[1:] for g in levels[n + 1])
    facts = {}
    for n, counts in levels.items():
        once, twice = (sum(c == k for c in counts.values()) for k in (1, 2))
        discount = min(0.9, max(0.1, once / max(once + 2 * twice, 1)))
        total, kinds = Counter(), Counter()
        for g, c in counts.items():
            total[g[:-1]] += c
            kinds[g[:-1]] += 1
        facts[n] = counts, discount, total, kinds

    def p(g):
        if not g:
            return 1 / (size + 1)
        counts, discount, total, kinds = facts[len(g)]
        if not total[g[:-1]]:
            return p(g[1:])
        here = max(counts[g] - discount, 0) / total[g[:-1]]
        return here + discount * kinds[g[:-1]] / total[g[:-1]] * p(g[1:])

    return p


def test_language_models_are_kneser_ney(monkeypatch):
    rng = random.Random(5)
    letters = {"aa": "abcde", "bb": "cdefg", "cc": "éßa xyz", "dd": "a"}

    def text(lang):
        return " ".join("".join(rng.choice(letters[lang]) for _ in range(rng.randrange(1, 6))) for _ in range(20))

    corpus = {lang: [text(lang) for _ in range(6)] for lang in letters}
    size = len({g[-1] for ts in corpus.values() for t in ts for g in plain_grams(t)})
    asked = [text(lang) for lang in letters] + ["zzz qqq", "a", "c,d;e"]
    expected = [
        [-np.mean([math.log(plain_model(ts, size)(g)) for g in plain_grams(t)]) for _, ts in sorted(corpus.items())]
        for t in asked
    ]
    counts = {}
    for lang, ts in corpus.items():
        row, start, _ = langid.symbols([t.encode() for t in ts])
        counts[lang] = np.unique(langid.grams(row, start, langid.ORDER)[0], return_counts=True)
    for block in (1, 3, 32):
        monkeypatch.setattr(langid, "BLOCK", block)
        model = langid.train(counts)
        assert len(model.blocks) == -(-4 // block) and model.langs == sorted(corpus)
        got, _, _ = langid.entropies(model, [t.encode() for t in asked])
        np.testing.assert_allclose(got, expected, rtol=2e-5)


def test_very_many_languages(spark):
    rows = [(f"l{k:04d}", f"{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)} " * 3) for k in range(5000)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    models = langid.fit(df, F.lit(True))
    assert len(models.langs) == 5000
    some = langid.predict(df.filter("hash(lang) % 500 = 0"), models).collect()
    assert some and sum(r["lang"] == r["lang_pred"] for r in some) >= 0.8 * len(some)


# --- quality ---------------------------------------------------------------------


def test_tables_of_two_valued_features_can_interact():
    rng = np.random.default_rng(1)
    x = np.column_stack([rng.integers(0, 2, (4000, 2)), rng.normal(size=(4000, 2))]).astype(float)
    y = ((x[:, 0] != x[:, 1]) ^ (rng.random(4000) < 0.05)).astype(float)
    model = quality.train(x, y)
    assert model.pairs[0] == (0, 1)
    right = (quality.probability(quality.margins(model, x)) >= 0.5) == y
    assert right.mean() > 0.9


def test_a_score_is_the_sum_of_its_table_entries():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 4))
    model = quality.train(x, (x[:, 0] * x[:, 1] > 0).astype(float))
    assert model.pairs
    for row, margin in zip(x[:40], quality.margins(model, x[:40]), strict=True):
        bins = [sum(v >= e for e in edges) for v, edges in zip(row, model.edges, strict=True)]
        cells = [
            b if len(e) < quality.PAIR_BINS else b * quality.PAIR_BINS // (len(e) + 1)
            for b, e in zip(bins, model.edges, strict=True)
        ]
        total = model.start + sum(model.single[f][b] for f, b in enumerate(bins))
        total += sum(model.double[k][cells[f]][cells[g]] for k, (f, g) in enumerate(model.pairs))
        assert margin == pytest.approx(total)


def test_a_shallow_tree_makes_its_best_cut_first(monkeypatch):
    rng = np.random.default_rng(3)
    grad, weight = rng.normal(size=12), rng.random(12) + 0.1
    monkeypatch.setattr(quality, "LEAVES", 2)

    def gain(cut):
        return sum(grad[s].sum() ** 2 / (weight[s].sum() + 1) for s in (slice(0, cut), slice(cut, None)))

    best = max(range(1, 12), key=gain)
    expected = np.concatenate([
        np.full(best, grad[:best].sum() / (weight[:best].sum() + 1)),
        np.full(12 - best, grad[best:].sum() / (weight[best:].sum() + 1)),
    ])
    np.testing.assert_allclose(quality._tree(grad, weight), expected)


# --- language model ----------------------------------------------------------------


def test_scores_do_not_follow_the_partitions(spark, monkeypatch):
    monkeypatch.setattr(lm, "SLICE_TOKENS", 20_000)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(docs.filter("doc_id % 3 = 0"))
    some = docs.filter("doc_id % 10 = 0").distinct()
    found = []
    for n in (2, 16):
        model, counts = lm.fit(docs.repartition(n), F.lit(True))
        found.append({r["doc_id"]: r["score"] for r in lm.score(some, model, counts).collect()})
    assert found[0].keys() == found[1].keys() and len(found[0]) > 5
    for k, score in found[0].items():
        assert score == pytest.approx(found[1][k], rel=1e-6)


# --- URL filter ----------------------------------------------------------------------


def test_ports_users_addresses_and_malformed_urls(spark):
    hosts = ["a.gov.uk", "shop.example.org:8080", "shop.example.org", "u:p@shop.example.org", "10.1.2.3",
             "10.1.2.3:99", "[::1]:80", "", "9.9.9.9", "com"]
    sites = spark.createDataFrame([(h,) for h in hosts], "h string").select(urlfilter.site_of(F.col("h")).alias("s"))
    assert [r.s for r in sites.collect()] == [
        "a.gov.uk", "shop.example.org", "shop.example.org", "shop.example.org", "10.1.2.3", "10.1.2.3", "[::1]",
        None, "9.9.9.9", "com",
    ]
    distinct = sites.filter("s is not null").distinct().toDF("host")
    by_list = {r.host: (r.suffix, r.domain) for r in urlfilter.with_domains(distinct).collect()}
    assert by_list["shop.example.org"] == ("org", "example.org")
    assert by_list["10.1.2.3"] == ("address", "10.1.2.3") and by_list["[::1]"][0] == "address"
    table = spark.createDataFrame([("uk",), ("GOV.uk",), ("com",), ("a.b.c",)], "suffix string")
    more = distinct.unionByName(spark.createDataFrame([("x.y.a.b.c",), ("gov.uk",)], "host string"))
    by_table = {r.host: (r.suffix, r.domain) for r in urlfilter.with_domains(more, table).collect()}
    assert by_table["a.gov.uk"] == ("gov.uk", "a.gov.uk") and by_table["x.y.a.b.c"] == ("a.b.c", "y.a.b.c")
    assert by_table["com"] == ("com", "com") and by_table["gov.uk"] == ("gov.uk", "gov.uk")
    assert by_table["shop.example.org"] == ("org", "example.org")
    pages = spark.createDataFrame(
        [(k, "no url") for k in range(200)] + [(200 + k, f"http://bad.example.net:{k}/x") for k in range(60)]
        + [(400, "http://bad.example.net/y")], "page_id bigint, url string",
    )
    labels = spark.createDataFrame([(k, 0, 0) for k in range(260)], "doc_id bigint, quality int, toxic int")
    got = {r["page_id"]: r["verdict"] for r in urlfilter.filter_urls(pages, labels).collect()}
    assert {got[k] for k in range(200)} == {"allow"} and got[400] == "block"


def test_lines_by_null_hosts_and_copies(spark):
    from tickstone.llm import lines

    def own(k):  # digits would be levelled
        return " ".join("".join(chr(97 + int(d)) for d in f"{k:02d}{j:02d}") for j in range(12))

    rows = [(k, "a line that all of them share\n" + own(k), None) for k in range(30)]
    rows += [(100 + k, " ".join(f"copy{j}" for j in range(12)) + "\nsecond line of the copy", "h") for k in range(25)]
    rows += [(None, "only line of a row without an id " * 2, "g")] * 40
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = defaultdict(set)
    for r in lines.judge(df).collect():
        got["copy" if r["doc_id"] and r["doc_id"] >= 100 else r["doc_id"] is None].add((r["n_removed"], r["kept"]))
    assert got[False] == {(7, True)}
    assert got["copy"] == {(17, False)}
    assert {n for n, _ in got[True]} == {0}
