"""The filter audit against a plain walk through every order."""

import random
import re
from itertools import permutations

from pyspark.sql import functions as F

from tickstone.llm import audit, common

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, source string, row_1 int, n string, Fails string"
LABELS = "doc_id bigint, quality int, toxic int, note string"


def failing(rows):
    """The letters each row fails."""
    out = []
    for doc, text, _ in rows:
        t = text or ""
        words = WORD.findall(t)
        out.append({
            x for x, bad in {
                "A": len(words) < 200,
                "B": 100 * len(set(words)) < 50 * len(words),
                "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                "D": any(c in "#$%&*|" for c in t),
                "E": doc is not None and any(
                    (u or "") == t and d is not None and d < doc for d, u, _ in rows
                ),
            }.items() if bad
        })
    return out


def plain(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    fails, out = failing(rows), {}
    for part in {s or "" for _, _, s in rows}:
        mine = [(d, f) for (d, _, s), f in zip(rows, fails, strict=True) if (s or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for k, x in enumerate(order):
                gone = [r for r in left if x in r[1]]
                left = [r for r in left if x not in r[1]]
                shapley[x] += len(gone)
                out[part, "".join(order), k + 1] = [
                    len(left), len(gone), sum(x in f for _, f in mine) - len(gone),
                    sum(f == {x} for _, f in mine), sum(d in good for d, _ in gone),
                    sum(d in toxic for d, _ in gone), x,
                ]
        for key, row in out.items():
            if key[0] == part:
                row[-1] = shapley[key[1][key[2] - 1]]
    return {k: tuple(v) for k, v in out.items()}


def frames(spark, rows, labels):
    docs = spark.createDataFrame([(*r, 5, "n", "F") for r in rows], SCHEMA)
    return docs.repartition(4), spark.createDataFrame([(*r, "x") for r in labels], LABELS)


def report(spark, rows, labels, **options):
    got = audit.audit(*frames(spark, rows, labels), **options).collect()
    return {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in got}


def test_against_a_plain_walk(spark):
    rng = random.Random(3)
    texts = [
        None, "", " \t\n", "WORD " * 250, " ".join(f"w{k}" for k in range(300)),
        " ".join(f"W{k}$" for k in range(220)), "a b a b a b", "x" * 100_000,
        " ".join("abc"[k % 3] * (k % 90 + 1) for k in range(400)), "\x0b\x0c Aé é",
    ]
    rows = [
        (rng.choice([None, *range(60)]), rng.choice(texts), rng.choice([None, "", "s", "t"]))
        for _ in range(150)
    ]
    rows += rows[:20] + [(7, "hot copy", "s")] * 40 + [(100 + k, "hot copy", "t") for k in range(40)]
    labels = [(rng.choice([None, *range(130)]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1]))
              for _ in range(90)]
    got = report(spark, rows, labels)
    assert got == plain(rows, labels)


def test_hot_copies_are_looked_up_by_salt(spark, monkeypatch):
    monkeypatch.setattr(audit, "counted_lookup", lambda *a: common.counted_lookup(*a, hot=5))
    rows = [(k, "hot copy", "s") for k in range(40)] + [(50 + k // 2, f"pair {k % 2}", "t") for k in range(8)]
    assert report(spark, rows, []) == plain(rows, [])


def test_empty_tables(spark):
    assert report(spark, [], []) == {}
    got = report(spark, [(1, None, None)], [])
    assert len(got) == 600
    assert got["", "ABCDE", 1] == (0, 1, 0, 1, 0, 0, 120)
    assert got["", "BACDE", 1] == (1, 0, 0, 0, 0, 0, 0)


def test_other_filters_and_orders(spark):
    docs, labels = frames(spark, [(1, "ab", "s"), (2, "b", "s"), (3, "c", "s")], [(1, 1, 0)])
    fails = F.filter(F.array(F.lit("a"), F.lit("b")), lambda x: F.col("text").contains(x))
    got = audit.audit(docs, labels, "ab", fails, {}, orders=["ba"]).orderBy("step").collect()
    assert [tuple(r)[3:] for r in got] == [(1, 2, 0, 1, 1, 0, 2), (1, 0, 1, 0, 0, 0, 0)]
