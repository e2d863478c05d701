"""Every training row counts, and what tasks carry over changes no result."""

import numpy as np
from pyspark.sql import functions as F

from tickstone.llm import lines, lm


def test_each_copy_of_a_text_is_trained_on(spark, monkeypatch):
    monkeypatch.setattr(lm, "SLICE_TOKENS", 20_000)  # the copies are dealt to several slices
    cycle = [f"w{chr(97 + k)}" for k in range(20)]
    often, once = " ".join(cycle * 15), " ".join(cycle[::-1] * 15)
    docs = spark.createDataFrame([(k, often) for k in range(200)] + [(200, once)], "doc_id bigint, text string")
    model, counts = lm.fit(docs, F.lit(True))
    stored = lm._as_classes(docs.withColumnRenamed("text", "_text"), model)
    assert sorted(r["times"] for r in stored.collect()) == [1, 200]
    got = {r["text"]: r for r in lm.score(docs, model, counts).collect()}
    assert abs(got[often]["base_score"] - got[once]["base_score"]) < 1e-6
    assert got[often]["score"] > got[once]["score"] + 30


def test_sums_carried_between_chunks_change_no_score(spark, monkeypatch):
    docs = spark.createDataFrame(
        [(k, " ".join(f"w{j * k % 7}" for j in range(40))) for k in range(60)], "doc_id bigint, text string"
    )
    model, _ = lm.fit(docs, F.lit(True))
    rng = np.random.default_rng(1)
    monkeypatch.setattr(lm, "_NORMS", 500)
    met = lm.Norms()
    for _ in range(6):
        classes = rng.integers(0, lm.CLASSES, 300)
        before = rng.integers(0, 9, (lm.CONTEXT, 300))
        expected = lm.class_log10(model, classes, before)
        np.testing.assert_allclose(lm.class_log10(model, classes, before, met), expected, rtol=1e-5)
        assert (np.diff(met.contexts) > 0).all() and len(met.contexts) <= 500


def test_lines_of_a_text_are_made_once(spark):
    rows = [(k, f"a line that all share\nown line {'x' * k} here", "h") for k in range(30)]
    judged = lines.judge(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))
    assert "posexplode" not in judged._jdf.queryExecution().optimizedPlan().toString()
    assert {r["n_removed"] for r in judged.collect()} == {5}
