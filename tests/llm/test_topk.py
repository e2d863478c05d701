"""Exact search against plain loops."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickstone.llm import topk

SCHEMA = "vec_id bigint, embedding array<double>, code string, shard int, Dim int"


def plain(rows, k, every=50):
    codes = [
        (i, [math.floor(256 * x) if abs(256 * x) < math.inf else int(math.copysign(2**63 - 1, x)) for x in v])
        for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, q in {(i, tuple(v)) for i, v in codes if i is not None and i % every == 0}:
        scored = [
            (-max(1 - 2**63, min(2**63 - 1, sum(a * b for a, b in zip(q, v, strict=True)))), j is None, j)
            for j, v in codes if len(v) == len(q) and j != i
        ]
        best = sorted(scored, key=lambda s: (s[0], s[1], s[2] or 0))[:k]
        out += [(i, n + 1, j, -s) for n, (s, _, j) in enumerate(best)]
    return sorted(out, key=str)


def found(spark, rows, k=5, **options):
    df = spark.createDataFrame([(*r, "c", 3, 4) for r in rows], SCHEMA).repartition(4)
    return sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 50 == 0, k, **options).collect()), key=str)


@pytest.mark.parametrize("shards", [1, 5, 40])
def test_against_plain_loops(spark, shards):
    rng = random.Random(shards)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(7)]) for i in range(-60, 400)]
    hot = [0.5, -0.25] * 3 + [1.0]
    rows += [(i, hot) for i in range(1000, 1300)]  # ties over all shards
    rng.shuffle(rows)
    assert found(spark, rows, shards=shards) == plain(rows, 5)
    assert found(spark, rows, k=40, shards=shards) == plain(rows, 40)


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 2.0]), (1, [1.0, None]), (2, None), (3, [math.nan, 1.0]), (4, [math.inf, 0.0]),
        (5, [3.0, 1.0]), (None, [3.0, 1.0]), (None, [9.0, 9.0]), (50, []), (51, []), (100, []),
        (150, [1e300, -1e300]), (151, [1e300, 1.0]), (200, [2.0**40, 2.0**41]), (201, [2.0**40, 3.0]),
        (250, [1.0, 2.0, 3.0]), (300, [2e307, 1.0]), (7, [3.0, 1.0]), (7, [3.0, 1.0]), (0, [4.0, 4.0]),
        (0, [1.0, 2.0]),
    ]
    for shards in (1, 3):
        assert found(spark, rows, shards=shards) == plain(rows, 5)
    assert found(spark, []) == []
    assert found(spark, [(50, [1.0])]) == []


def test_selection_takes_ties_from_the_left():
    scores = np.array([[1, 3, 3, 2, 3, -np.inf], [0, 0, 0, 0, 0, 0]])
    assert [x.tolist() for x in topk.select(scores, 2)] == [[1, 2], [0, 1]]
    assert [x.tolist() for x in topk.select(scores[:1], 6)] == [[1, 2, 4, 3, 0]]
