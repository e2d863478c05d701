"""The conversation trie against a plain one, for any number of shards."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from tickstone.llm import common, trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id bigint, turn bigint, role string, text string, id int, Seq string, path int"


def plain_sequences(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(ts, key=lambda t: t[:2])] for c, ts in convs.items()}


def plain_rebuilt(seqs):
    out = {}
    for c, own in seqs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        out[c] = seqs.get(base, [])[:h] + own[h:]
    return out


def plain(seqs):
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    out = []
    for p, cs in members.items():
        below = [q for q in members if q[:len(p)] == p]
        ends = sorted(c for c in cs if len(seqs[c]) == len(p))
        out.append((
            min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs),
            sum(len(q) == len(p) + 1 for q in below),
            sum(not any(len(r) == len(q) + 1 and r[:-1] == q for r in below) for q in below),
            sum((len(members[q]) - 1) * len(WORD.findall(q[-1][1])) for q in below if q),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "s", 2) for r in rows], SCHEMA).repartition(3)


def found(spark, rows, **options):
    return sorted(map(tuple, trie.prefix_trie(frame(spark, rows), **options).collect()), key=str)


def drawn(seed):
    """Conversations over few texts, so that prefixes of all lengths are shared."""
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(-700, 1400), 160):
        of = rng.choice([1, 2, 3, 4, 8])
        rows += [
            (c, k if k else rng.choice([None, 0]), rng.choice("ab"), rng.choice(["x", "two words", None, ""]))
            for k in range(of)
        ]
    hot = [(k, t, "user", f"hot {t}") for k in range(5000, 5900, 3) for t in range(4)]
    return rows + hot


@pytest.mark.parametrize(("shards", "rebuild"), [(1, None), (7, None), (40, trie.rebuilt)])
def test_against_a_plain_trie(spark, shards, rebuild, monkeypatch):
    monkeypatch.setattr(trie, "counted_lookup", lambda *a: common.counted_lookup(*a, hot=20))
    rows = drawn(shards)
    seqs = plain_sequences(rows)
    expected = plain(seqs if rebuild is None else plain_rebuilt(seqs))
    assert found(spark, rows, shards=shards, rebuild=rebuild) == expected


def test_nulls_ties_repeats_and_turnless(spark):
    rows = [
        (None, 0, "user", "nobody"), (40, 5, None, None), (40, None, "u", "a b\x0bc"),
        (41, 0, "u", "t"), (41, 0, "u", "t"), (41, 0, "u", "t"), (43, 0, "u", "z" * 200_000),
    ]
    seqs = plain_sequences(rows)
    assert found(spark, rows, rebuild=None) == plain(seqs)
    assert found(spark, rows) == plain(plain_rebuilt(seqs))
    tied = [(1, 0, "u", "p"), (1, 0, "u", "q"), (2, 0, "u", "q"), (2, 0, "u", "p")]
    assert len(found(spark, tied, rebuild=None)) == 3


def test_one_conversation_of_many_turns(spark):
    rows = [(60, k, "u", f"t {k % 7}") for k in range(3000)] + [(61, k, "u", f"t {k % 7}") for k in range(2000)]
    got = found(spark, rows, rebuild=None, shards=3)
    assert len(got) == 3001
    assert sum(r[3] for r in got) == 5002
    assert {r[5] for r in got} == {1}
    assert max(r[6] for r in got) == 2 * 2000


def test_empty(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "u", "t")]) == []
