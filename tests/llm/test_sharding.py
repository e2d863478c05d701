"""Shards against a plain minimax partition."""

import random
import zlib
from collections import defaultdict

from tickstone.llm import sharding


def plain_capacity(sizes, shards):
    """Binary search with a greedy check, over a list."""

    def needed(capacity):
        used, room = 1, capacity
        for s in sizes:
            if s > room:
                used, room = used + 1, capacity
            room -= s
        return used

    low, high = max(max(sizes), -(-sum(sizes) // shards)), sum(sizes)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if needed(mid) <= shards else (mid + 1, high)
    return low


def plain_shards(rows, shards):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t].append(i)
    size = {t: len((t or "").encode()) + 1 for t in groups}
    order = sorted(groups, key=lambda t: (min(groups[t]), str(t)))
    capacity = plain_capacity([size[t] * len(groups[t]) for t in order], shards)
    out, k, room = {}, 0, capacity
    for t in order:
        s = size[t] * len(groups[t])
        if s > room:
            k, room = k + 1, capacity
        room -= s
        out[t] = k
    return out


def check(spark, rows, shards, blocks=5):
    df = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id bigint, text string, shard int")
    got = sharding.shard(df.repartition(3), shards=shards, blocks=blocks).collect()
    assert len(got) == len(rows)
    expected = plain_shards(rows, shards)
    left = sorted(rows, key=str)
    seen = defaultdict(list)
    by_id = defaultdict(list)
    for i, t in left:
        by_id[i].append(t)
    for r in got:
        options = [t for t in by_id[r["doc_id"]] if zlib.crc32((t or "").encode()) == r["text_crc32"]
                   and len((t or "").encode()) + 1 == r["size"] and expected[t] == r["shard"]]
        assert options
        by_id[r["doc_id"]].remove(options[0])
        seen[r["shard"]].append(r["slot"])
        assert r["law"] == "bytes" and r["grown_shard"] is None
    for slots in seen.values():
        assert sorted(slots) == list(range(len(slots)))


def test_equals_plain_partition(spark):
    rng = random.Random(4)
    rows = [(i, "x" * rng.randint(0, 90) + "é" * rng.randint(0, 3)) for i in range(400)]
    rows += [(1000 + i, "hot text") for i in range(300)]  # a third of all rows
    rows += [(2000 + i, rows[i][1]) for i in range(30)] + [(3000, None), (3001, None), (3002, "")]
    rows += [rows[5], rows[5]]
    check(spark, rows, 16)


def test_hot_group_fills_a_shard_alone(spark):
    rows = [(i, "a" * 500) for i in range(60)] + [(100 + i, f"t{i}") for i in range(40)]
    check(spark, rows, 4)


def test_fewer_groups_than_shards_and_long_text(spark):
    check(spark, [(1, "a"), (2, "b" * 300_000)], 16, blocks=2)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert sharding.shard(df, blocks=2).collect() == []
