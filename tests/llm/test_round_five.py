"""What the language model computes once, and that it changes no result."""

import numpy as np
from pyspark.sql import functions as F

from tickstone.llm import lm


def _fitted(spark) -> lm.Model:
    docs = spark.createDataFrame(
        [(k, " ".join(f"w{j * k % 7}" for j in range(40))) for k in range(60)], "doc_id bigint, text string"
    )
    return lm.fit(docs, F.lit(True))[0]


def _plain_step(m: lm.Model, noise_share, classes, before, drawn) -> np.ndarray:
    """Parameters after one noise-contrastive step from ``m``, every drawn class by itself."""
    above = m.bias - np.log(lm.NOISE * noise_share)
    predicted = sum(m.vectors[b] @ p for b, p in zip(before, m.places, strict=True))
    wanted, noise = m.targets[classes], m.targets[drawn]
    up = 1 / (1 + np.exp((predicted * wanted).sum(axis=1) + above[classes]))
    down = -1 / (1 + np.exp(-(predicted @ noise.T + above[drawn])))
    g_predicted = down @ noise + up[:, None] * wanted
    g = [np.zeros_like(x) for x in (m.vectors, m.places, m.targets, m.bias)]
    for k, b in enumerate(before):
        np.add.at(g[0], b, g_predicted @ m.places[k].T)
        g[1][k] = m.vectors[b].T @ g_predicted
    np.add.at(g[2], classes, up[:, None] * predicted)
    np.add.at(g[2], drawn, down.T @ predicted)
    np.add.at(g[3], classes, up)
    np.add.at(g[3], drawn, down.sum(axis=0))
    change = np.concatenate([x.ravel() for x in g]) / len(classes)
    return m.parameters() + lm.RATE * change / np.sqrt(1e-2 + change**2)


def test_a_class_drawn_often_is_computed_once_and_counts_as_often(spark):
    model = _fitted(spark)
    rng = np.random.default_rng(2)
    for n in (lm.BATCH, 70):  # a whole batch, and a last one
        classes, before = rng.integers(0, 9, n), rng.integers(0, 9, (lm.CONTEXT, n))
        drawn = np.repeat([0, 5, 9, 270], [40, 1, 3, 20])
        assert len(drawn) == lm.NOISE
        trainer = lm.Trainer(model, 0)
        expected = _plain_step(model, trainer.noise, classes, before, drawn)
        trainer.space[:] = np.nan
        rows = before * lm.CONTEXT + np.arange(lm.CONTEXT)[:, None]
        trainer.step(classes, rows, *np.unique(drawn, return_counts=True))
        np.testing.assert_allclose(trainer.m.parameters(), expected, rtol=1e-4, atol=2e-6)
        assert np.isfinite(trainer.space).sum() == n * 4  # and not n * NOISE


def test_a_run_takes_every_token_once(spark, monkeypatch):
    model = _fitted(spark)
    classes = np.random.default_rng(3).integers(0, lm.CLASSES, 2500)
    before = lm._before(classes, np.zeros(2500))
    met, noise = [], []
    monkeypatch.setattr(
        lm.Trainer, "step", lambda self, c, b, d, t: (met.append(np.vstack([c, b])), noise.append((d, t)))
    )
    lm.Trainer(model, 0).run(classes, before)
    assert [x.shape[1] for x in met] == [1024, 1024, 452]
    rows = before * lm.CONTEXT + np.arange(lm.CONTEXT)[:, None]
    assert sorted(map(tuple, np.hstack(met).T)) == sorted(map(tuple, np.vstack([classes, rows]).T))
    assert all(t.sum() == lm.NOISE and (np.diff(d) > 0).all() for d, t in noise)


def test_distinct_keys_are_those_of_unique():
    rng = np.random.default_rng(4)
    spread = rng.integers(0, 1 << 63, 300, dtype=np.uint64)[rng.integers(0, 300, 5000)] << np.uint64(1)
    alike = rng.integers(0, 50, 5000).astype(np.uint64)  # the same upper bits
    for keys in (spread, alike, spread[:1], spread[:0]):
        for got, expected in zip(lm._distinct(keys), np.unique(keys, return_index=True, return_inverse=True), strict=True):
            np.testing.assert_array_equal(got, expected)


def test_words_do_not_depend_on_the_pieces(monkeypatch):
    texts = [b"One two, \xc3\xa9t\xc3\xa9 three.", b"", b"  ", b"four\tfive 12345678901", b"\xe6\x97\xa5 x"]
    whole = lm.Tokens(texts)
    monkeypatch.setattr(lm, "_PIECE", 1)
    parts = lm.Tokens(texts)
    for name in ("hash", "text", "spelling"):
        np.testing.assert_array_equal(getattr(whole, name), getattr(parts, name))
    assert whole.text.tolist() == [0] * 4 + [3] * 3 + [4] * 2
    assert whole.spelling.tolist() == [0, 18, 4, 13, 0, 0, 8, 3, 0]
    assert len(lm.Tokens([]).hash) == 0


def test_class_scores_that_lie_far_apart_are_normalised(spark):
    model = _fitted(spark)
    rng = np.random.default_rng(5)
    # Each place has another class far above all others.
    vectors = rng.normal(0, 10, model.vectors.shape)
    model = model.with_parameters(np.concatenate([
        x.ravel() for x in (vectors, model.places, rng.normal(0, 10, model.targets.shape), model.bias)
    ]))
    classes, before = np.arange(lm.CLASSES), rng.integers(0, lm.CLASSES, (lm.CONTEXT, lm.CLASSES))
    scores = sum(vectors[b] @ p for b, p in zip(before, model.places, strict=True)) @ model.targets.T + model.bias
    expected = scores[classes, classes] - np.logaddexp.reduce(scores, axis=1)
    np.testing.assert_allclose(lm.class_log10(model, classes, before), expected / np.log(10), rtol=1e-5, atol=1e-5)
