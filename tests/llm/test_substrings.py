"""Repeat removal against a plain window count."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tickstone.llm import substrings


def plain(texts):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[k : k + 35]) for w in words for k in range(len(w) - 34))
    out = []
    for w in words:
        gone = bytearray(len(w))
        for k in range(len(w) - 34):
            if seen[tuple(w[k : k + 35])] > 1:
                gone[k : k + 35] = b"\1" * 35
        out.append((len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()))
    return out


def corpus():
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(40)] + ["é", "Ü,"]

    def prose(n):
        return [rng.choice(vocab) for _ in range(n)]

    texts = [prose(rng.randint(0, 160)) for _ in range(40)]
    passage = prose(70)
    for i in range(25):  # one passage in many texts, at different places
        texts.append(prose(rng.randint(0, 40)) + passage + prose(rng.randint(0, 40)))
    for t in texts[:6]:  # near copies
        texts.append([*t[: len(t) // 2], "changed", *t[len(t) // 2 :]])
    texts += [texts[50]] * 6  # copies
    texts.append(["a", "b"] * 60)  # repeats within itself, equal grams in a window
    texts.append(["z"] * 36)
    texts.append(["y"] * 35)
    texts.append(passage[:34])
    texts.append(passage[:35])
    texts.append(prose(300) * 2)
    texts.append(prose(60_000))
    lines = [rng.choice([" ", "\n", "  ", "\t "]).join(t) for t in texts]
    return [*lines, None, "", " \n "]


@pytest.mark.parametrize(("group_size", "bits"), [(20_000, 1 << 16), (8, 1 << 16), (8, 64)])
def test_equals_plain_count(spark, group_size, bits):
    """Also with frequent anchors, and with bit tables so small that all bits are set."""
    texts = corpus()
    rows = [(i // 2, t, "clash") for i, t in enumerate(texts)]  # ids repeat
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_words string").repartition(5)
    got = substrings.remove_repeats(df, group_size=group_size, filter_bits=bits).collect()
    expected = Counter(
        (i, n, gone, left if gone else t)
        for (i, t, _), (n, gone, left) in zip(rows, plain(texts), strict=True)
    )
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in got) == expected


def plain_ranges(texts):
    """Runs of neighbouring windows that repeat, as word ranges of each text."""
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[k : k + 35]) for w in words for k in range(len(w) - 34))
    out = set()
    for i, w in enumerate(words):
        start = None
        for k in range(len(w) - 33):
            hit = k < len(w) - 34 and seen[tuple(w[k : k + 35])] > 1
            if hit and start is None:
                start = k
            elif not hit and start is not None:
                out.add((str(i), start, k + 34))
                start = None
    return out


@pytest.mark.parametrize(("group_size", "bits"), [(20_000, None), (30, 1 << 16), (1, 64)])
def test_ranges_do_not_follow_the_group_size(spark, group_size, bits):
    texts = corpus()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    got = substrings.repeats(df, group_size=group_size, filter_bits=bits).collect()
    assert {(r["_id"], r["lo"], r["hi"]) for r in got} == plain_ranges(texts) and len(got) == len(plain_ranges(texts))


def test_repeated_rows_and_null_id(spark):
    t = " ".join(f"x{i}" for i in range(40))
    df = spark.createDataFrame([(1, t), (1, t), (None, t + " y"), (2, "short")], "doc_id bigint, text string")
    got = {(r["doc_id"], r["n_removed"], r["text"]) for r in substrings.remove_repeats(df).collect()}
    assert got == {(1, 40, ""), (None, 40, "y"), (2, 0, "short")}


def test_copies_of_a_text_meet_their_window_under_many_salts(spark, monkeypatch):
    found = []
    real = substrings.salted_lookup

    def spy(rows, facts, on, salt, salts=16):
        dealt = rows.select(*on, F.pmod(salt, F.lit(salts)).alias("s")).groupBy(*on).agg(F.countDistinct("s").alias("k"))
        found.append(dealt.agg(F.min("k")).first()[0])
        return real(rows, facts, on, salt, salts)

    monkeypatch.setattr(substrings, "salted_lookup", spy)
    text = " ".join(f"w{i}" for i in range(50))
    df = spark.createDataFrame([(i, text) for i in range(200)], "doc_id bigint, text string")
    rows = substrings.remove_repeats(df, group_size=3).collect()
    assert all(r["n_removed"] == 50 for r in rows)
    assert found and found[0] > 16


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert substrings.remove_repeats(df).collect() == []
