"""SimHash against a plain all-pairs version."""

import random

import numpy as np
import pytest
import xxhash

from tickstone.llm import simhash


def plain_fingerprint(text):
    words = [w for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    n = max(1, len(words) - 2)
    h = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def near(rng, n):
    """Clusters of fingerprints around a few centres, so that many links exist."""
    centres = [rng.getrandbits(64) for _ in range(6)]
    out = set()
    while len(out) < n:
        f = rng.choice(centres)
        for _ in range(rng.randint(0, 6)):
            f ^= 1 << rng.randrange(64)
        out.add(f)
    return sorted(out)


def test_within_counts_differing_bits():
    rng = random.Random(1)
    f = np.array(near(rng, 300), dtype=np.uint64)
    planes = simhash._planes(f)
    for radius in (0, 1, 2):
        hit = simhash.within(planes, f[:20], radius)[:, : len(f)]
        assert (hit == (np.bitwise_count(f[:20, None] ^ f[None]) <= radius)).all()


@pytest.mark.parametrize("split_above", [2048, 3])
def test_links_connect_what_is_near(spark, split_above):
    prints = near(random.Random(2), 500)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in prints]
    df = spark.createDataFrame(signed, "f bigint").repartition(3)
    links = simhash.fingerprint_links(df, split_above).collect()
    index = {s[0]: i for i, s in enumerate(signed)}
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        x, y = find(index[a]), find(index[b])
        assert (prints[index[a]] ^ prints[index[b]]).bit_count() <= 2
        root[max(x, y)] = min(x, y)
    assert [find(i) for i in range(len(prints))] == plain_components(prints)


def texts():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    base = [" ".join(rng.choice(words) for _ in range(400)) for _ in range(8)]
    rows = list(base)
    for t in base[:5]:
        for _ in range(4):
            w = t.split()
            w[rng.randrange(len(w))] = "other"
            rows.append(" ".join(w))
    rows += [None, "", " \t\n", "one", "one two", "A b C", "a B c", base[0].upper(), "\xa0 é", "x " * 50_000]
    return rows


def test_components_equal_brute_force(spark):
    rows = [(i + 10, t) for i, t in enumerate(texts())]
    rows += [rows[0], (None, "only without an id"), (None, rows[1][1])]
    df = spark.createDataFrame(
        [(i, t, "clash") for i, t in rows], "doc_id bigint, text string, component_id string"
    )
    got = sorted(map(str, (tuple(r) for r in simhash.near_duplicates(df).collect())))
    prints = [plain_fingerprint(t) for _, t in rows]
    roots = plain_components(prints)
    least = {}
    for (i, _), r in zip(rows, roots, strict=True):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    expected = sorted(
        str((i, f - (1 << 64) if f >> 63 else f, least.get(r)))
        for (i, _), f, r in zip(rows, prints, roots, strict=True)
    )
    assert got == expected


def test_keep_one(spark):
    rows = [(1, "a b c d"), (2, "a b c d"), (2, "a b c d"), (3, None), (4, ""), (None, "z"), (9, "q"), (9, "q")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(map(str, map(tuple, simhash.keep_one(df).collect()))) == sorted(
        map(str, [(1, "a b c d"), (3, None), (None, "z"), (9, "q")])
    )


def test_keep_one_by_component(spark):
    # Id 7 repeats with a text near those of id 5 and one near those of id 8.
    x, y = "x1 x2 x3 x4 x5", "y1 y2 y3 y4 y5"
    lone = [(20, "p q r s"), (20, "t u v w"), (20, "t u v w")]  # unrelated texts under one id
    rows = [(5, x), (7, x), (7, y), (8, y), *lone]
    rows += [(None, x), *[(None, "no id at all")] * 3, (None, "another without"), (None, y.upper())]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert sorted(map(str, map(tuple, simhash.keep_one(df).collect()))) == sorted(map(str, [
        (5, x), (7, y), (20, "p q r s"), (20, "t u v w"), (None, "no id at all"), (None, "another without"),
    ]))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.near_duplicates(df).collect() == []
    assert simhash.keep_one(df).collect() == []
