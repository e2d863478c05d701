"""Tokens, languages, quality, line rules, language model and decontamination on small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickstone.llm import bpe, decontaminate, langid, lines, lm, quality
from tickstone.llm.common import fold, salted_lookup

SF = "/root/testdata/sf0.001"
ODD = [
    None, "", " \n\t", "\xa0", "1234 !!", "a", "I'll don't 's", "Σίσυφος ΑΣ", "日本語 テキスト", "\U0001f600 x",
    "<|endoftext|> a<|startoftext|>b <|x|>", "word " * 30_000, "x" * 3000, "\x1c a\x85b",
]


@pytest.fixture(scope="module")
def docs(spark):
    real = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    odd = spark.createDataFrame([(10_000 + i, t, None, None) for i, t in enumerate(ODD)], real.schema)
    again = odd.limit(5)
    noid = spark.createDataFrame([(None, "no id here", "en", "src0")], real.schema)
    return real.union(odd).union(again).union(noid).withColumns(
        {"score": F.lit("clash"), "token_ids": F.lit("clash"), "n_tokens": F.lit("clash")}
    ).repartition(3).cache()


def test_bpe_equals_the_library(docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    library, vocabulary = Tokenizer.from_file(path), bpe.read_vocabulary(path)
    rows = bpe.encode_texts(docs, vocabulary).collect()
    assert len(rows) == docs.count()
    for r in rows:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["token_ids"] == ids
        assert r["decoded"] == library.decode(ids, skip_special_tokens=False)
    for r in bpe.encode_digests(docs, vocabulary, keep=["text"]).collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_languages(docs):
    models = langid.fit(docs, fold("doc_id", 5) != 0)
    rows = langid.predict(docs, models).collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r["lang"] and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held)
    for r in rows:
        letter = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") != letter
        assert 0 <= r["score"] <= 1
    strange = {r["text"]: r["rejected"] for r in rows}
    assert strange["日本語 テキスト"] and not any(r["rejected"] for r in held if len(r["text"]) > 200)


def test_languages_of_many_copies_and_of_one_text(spark):
    def words(alphabet, i):
        return " ".join("".join(alphabet[(i * 7 + j * k) % len(alphabet)] for k in range(1, 6)) for j in range(1, 30))

    # One text of "xx" is copied until a sample of the rows would hardly reach the others.
    rows = [("xx", words("ăęįőů", 0))] * 20_000 + [("xx", words("ăęįőů", i)) for i in range(1, 5)]
    rows += [("en", words("abcdefgh", i)) for i in range(60)]
    rows += [(f"one{k}", f"{chr(0x3b1 + k) * 5} {chr(0x430 + k) * 3}") for k in range(12)]  # a text each
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    sample = langid._sampled(df.toDF("_lang", "_text"), 40).collect()
    drawn = Counter(r["_lang"] for r in sample)
    assert drawn["xx"] == 5 and all(drawn[f"one{k}"] == 1 for k in range(12))
    assert 0 < drawn["en"] < 60
    models = langid.fit(df, F.lit(True), sample_docs=40)
    assert models.langs == sorted({n for n, _ in rows})
    got = langid.predict(df.distinct(), models).collect()
    assert all(r["lang_pred"] == r["lang"] for r in got)


def test_nothing_learned(spark, docs):
    assert langid.fit(docs, F.lit(False)) is None
    assert {r["lang_pred"] for r in langid.predict(docs, None).collect()} == {"und"}


def test_quality_on_held_out_rows(spark, docs):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    more = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = quality.fit(more, labels, fold("doc_id", 3) != 1)
    rows = quality.score(more, model).join(labels, "doc_id").filter(fold("doc_id", 3) == 1).collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.95 * len(rows)
    odd = quality.score(docs, model).collect()
    assert len(odd) == docs.count() and all(0 <= r["score"] <= 1 for r in odd)
    nothing = quality.fit(more, labels, F.lit(False))
    assert {round(r["score"], 6) for r in quality.score(docs, nothing).collect()} == {0.5}


def test_line_rules(spark):
    shared = "Shared  LINE 12 of the host"
    rows = [(i, f"own words number {i} " * 3 + f"\n{shared if i % 2 else shared.lower()}", "h") for i in range(30)]
    rows += [(100 + i, "only\n" + "\n".join([f"shared line {i} x", shared]) + " ", "h") for i in range(3)]
    rows += [(200, "a b c d e f " * 5, "h"), (201, None, "h"), (202, "", None), (203, "few words", None)]
    rows += [rows[0], rows[0]]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = lines.judge(df).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[0]["n_removed"] == 6 and by_id[0]["n_words"] == 18
    assert by_id[200]["n_repeat_words"] == 30 and by_id[200]["base_failed"]
    assert by_id[201]["n_words"] == 0 and not by_id[201]["kept"]
    assert not by_id[100]["kept"]


def test_copies_of_a_text_meet_their_line_under_many_salts(spark, monkeypatch):
    found = []

    def spy(rows, facts, on, salt, salts=16):
        dealt = rows.select(*on, F.pmod(salt, F.lit(salts)).alias("s")).groupBy(*on).agg(F.countDistinct("s").alias("k"))
        found.append(dealt.agg(F.min("k")).first()[0])
        return salted_lookup(rows, facts, on, salt, salts)

    monkeypatch.setattr(lines, "salted_lookup", spy)
    df = spark.createDataFrame([(i, "one line here\nanother line", "h") for i in range(200)], "doc_id bigint, text string, source string")
    assert len(lines.judge(df).collect()) == 200
    assert found and found[0] > 16


def test_language_model(spark, docs):
    model, counts = lm.fit(docs, fold("doc_id", 7) != 2)
    rows = lm.score(docs, model, counts).collect()
    assert len(rows) == docs.count()
    tokens = [[*(r["text"] or "").encode().lower().split(), None] for r in rows]
    held = [zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 7 == 2 for r in rows]
    count = Counter(t for ts, h in zip(tokens, held, strict=True) if not h for t in ts)
    total, kinds = sum(count.values()), len(count)
    for r, ts in zip(rows, tokens, strict=True):
        assert (r["n_tokens"], r["train_tokens"]) == (len(ts), total)
        assert r["n_known"] == sum(count[t] > 0 for t in ts)
        base = sum(math.log10((count[t] + 1) / (total + kinds + 1)) for t in ts)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert r["score"] < 0
    own = [(r["score"], r["base_score"]) for r, h in zip(rows, held, strict=True) if h]
    assert sum(s for s, _ in own) > sum(b for _, b in own)


def test_class_probabilities_add_up(docs):
    import numpy as np

    model, _ = lm.fit(docs, F.lit(True))
    before = np.full((lm.CONTEXT, lm.CLASSES), 3)
    assert math.isclose((10 ** lm.class_log10(model, np.arange(lm.CLASSES), before)).sum(), 1, rel_tol=1e-5)


def test_leaks(spark):
    items = [(1, "What is the tallest hill in the land of seven rivers?\nIt is the old green hill of Marn."),
             (2, "Name the metal that never rusts in salt water. Gold never rusts."), (3, None), (4, " ")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    filler = " ".join(f"filler{i}" for i in range(300))
    rows = [
        (10, f"{filler} {items[0][1].upper()} {filler}"), (11, filler), (12, items[1][1]), (13, None), (14, ""),
        (15, items[0][1].split("\n")[0] + " " + filler), (16, f"{filler} " * 50 + items[1][1]), (12, items[1][1]),
    ]
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id bigint, text string, score string")
    for size in (1 << 20, 90):  # in one index, and in blocks of items
        got = decontaminate.find_leaks(df, bench, index_bytes=size).collect()
        assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(10, 1), (12, 2), (12, 2), (16, 2)]
        left = decontaminate.without_leaks(df, bench, index_bytes=size).collect()
        assert sorted(r["doc_id"] for r in left) == [11, 13, 14, 15]
    assert decontaminate.find_leaks(df, bench.limit(0)).collect() == []


def test_scores_do_not_depend_on_blocks(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    items = [(i, " ".join(f"w{k}" for k in rng.zipf(1.3, int(rng.integers(8, 60))) % 300)) for i in range(80)]
    items += [(90, ""), (91, None), (92, " . ")]
    bench = spark.createDataFrame(items, "item_id bigint, text string").repartition(3)
    # All but some words of each item, so that the score hangs on the words' weights.
    rows = [(i, " ".join(t.split()[:-2])) for i, t in items[:80]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    whole, *parted = (
        {(r["doc_id"], r["item_id"]): r["score"] for r in decontaminate.find_leaks(docs, bench, index_bytes=n).collect()}
        for n in (1 << 20, 4000, 700)
    )
    assert len(whole) > 40 and any(s < 0.99 for s in whole.values())
    for got in parted:
        assert got.keys() == whole.keys()
        assert all(math.isclose(got[k], s, rel_tol=1e-9) for k, s in whole.items())


def test_retrieval_equals_plain_bm25():
    import numpy as np

    rng = np.random.default_rng(3)
    items = [(i, " ".join(f"w{k}" for k in rng.zipf(1.4, rng.integers(5, 30)) % 200)) for i in range(150)]
    x = decontaminate.build(items)
    passages = [sorted(set((rng.zipf(1.4, 60) % 200).tolist())) for _ in range(40)]
    names = {w: i for i, w in enumerate(x.terms.tolist())}
    pairs = []
    for p, words in enumerate(passages):
        hashes = decontaminate.Words([b" ".join(b"w%d" % w for w in words)], gaps=decontaminate._GAPS).each[0]
        pairs += [(p, names[h]) for h in sorted(hashes.tolist()) if h in names]
    p, t = (np.array(c) for c in zip(*sorted(pairs), strict=True))
    got = {(a, b): s for a, b, s in zip(*(c.tolist() for c in decontaminate.retrieve(x, p, t)), strict=True)}
    plain: dict = {}
    for a, b in pairs:
        for k in range(x.item_at[b], x.item_at[b + 1]):
            plain[a, int(x.item[k])] = plain.get((a, int(x.item[k])), 0) + x.weight[k]
    expected = {k: s for k, s in plain.items() if s >= decontaminate.THRESHOLD}
    assert expected and got.keys() == expected.keys()


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert langid.predict(none, langid.fit(none, F.lit(True))).collect() == []
    assert quality.score(none, quality.fit(none, labels, F.lit(True))).collect() == []
    assert lm.score(none, *lm.fit(none, F.lit(True))).collect() == []
    assert lines.judge(none).collect() == []


def test_white_space_is_ascii():
    assert re.split(lines.BLANKS + "+", "a\xa0b\x0bc") == ["a\xa0b", "c"]
