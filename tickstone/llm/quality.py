"""Quality classifier: a generalised additive model with pairwise interactions.

Features of the whole text are put into bins.  Boosting goes round the features in
turn; each turn fits a shallow tree on one feature alone to the current residuals and
adds its small step to that feature's look-up table, so no feature crowds out another.
Then the pairs of features that still explain most are boosted the same way with
trees over two features.  A score is the sum of one table entry per feature and pair.

The model is fitted on a bounded sample: at most ``sample_rows`` labelled rows, chosen
by a hash of their text.  Scoring reads every whole text.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import beside, carried, released, row_schema, text_chunks, unpacked

#: Labelled rows to learn from at most.
SAMPLE_ROWS = 20_000
BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 120, 60, 8
RATE = 0.1
LEAVES = 4  # of a tree on one feature

_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
_DIGITS, _SYMBOLS = b"0123456789", b"#*$%&|<>{}[]\\^~_=+@/"
_STOPS, _MARKS = b".,;:", b"!?"

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "letter_share", "upper_share", "digit_share",
    "symbol_share", "stop_share", "mark_share", "bars_per_word", "lines_per_word",
    "repeated_words", "repeated_lines", "longest_word", "beyond_ascii",
)


def features(text: bytes) -> list[float]:
    """The features of a text of UTF-8 bytes; all zero when it is empty."""
    n = len(text)
    if not n:
        return [0.0] * len(FEATURES)

    def count(letters: bytes) -> int:
        return n - len(text.translate(None, letters))

    words, lines = text.split(), [x for x in text.split(b"\n") if x]
    w, letters, upper = max(1, len(words)), count(_LETTERS), count(_UPPER)
    return [
        np.log1p(n), np.log1p(len(words)), sum(map(len, words)) / w, letters / n,
        upper / max(1, letters), count(_DIGITS) / n, count(_SYMBOLS) / n, count(_STOPS) / n,
        count(_MARKS) / n, text.count(b"|") / w, text.count(b"\n") / w,
        1 - len(set(words)) / w, 1 - len(set(lines)) / max(1, len(lines)),
        np.log1p(max(map(len, words), default=0)), 1 - len(text.translate(None, bytes(range(128)))) / n,
    ]


@dataclass(frozen=True)
class Model:
    """Bin edges and look-up tables; fixed in size by the number of features and bins."""

    edges: list[np.ndarray]
    start: float
    single: np.ndarray  # (features, BINS)
    pairs: list[tuple[int, int]]
    double: np.ndarray  # (pairs, PAIR_BINS, PAIR_BINS)


def binned(edges: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, f], "right") for f, e in enumerate(edges)], axis=1)


def coarse_bins(edges: list[np.ndarray], b: np.ndarray) -> np.ndarray:
    """The cells of pair tables that bins belong to, of each feature's own number of bins."""
    bins = np.array([max(len(e) + 1, PAIR_BINS) for e in edges])
    return b * PAIR_BINS // bins


def margins(m: Model, x: np.ndarray) -> np.ndarray:
    """Log-odds of the rows of features ``x``: vectorised additions of table entries."""
    b = binned(m.edges, x)
    out = np.full(len(x), m.start)
    for f in range(x.shape[1]):
        out += m.single[f, b[:, f]]
    coarse = coarse_bins(m.edges, b)
    for k, (f, g) in enumerate(m.pairs):
        out += m.double[k, coarse[:, f], coarse[:, g]]
    return out


def probability(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def _step(grad: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return grad / (weight + 1.0)  # shrunk towards zero where little is known


def _tree(grad: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A shallow tree over ordered bins: the value of each bin.

    The leaf whose best cut gains most is cut until there are enough leaves.
    """
    g, w = np.concatenate([[0], np.cumsum(grad)]), np.concatenate([[0], np.cumsum(weight)])

    def best(lo: int, hi: int) -> tuple[float, int]:
        if hi - lo < 2:
            return 0.0, lo
        cut = np.arange(lo + 1, hi)
        left, right = g[cut] - g[lo], g[hi] - g[cut]
        gain = left**2 / (w[cut] - w[lo] + 1) + right**2 / (w[hi] - w[cut] + 1)
        gain = gain - (g[hi] - g[lo]) ** 2 / (w[hi] - w[lo] + 1)
        k = int(np.argmax(gain))
        return float(gain[k]), int(cut[k])

    leaves = [(0, len(grad))]
    while len(leaves) < LEAVES:
        gains = [best(*leaf) for leaf in leaves]
        k = max(range(len(leaves)), key=lambda i: gains[i][0])
        if gains[k][0] <= 1e-9:
            break
        lo, hi = leaves[k]
        leaves[k : k + 1] = [(lo, gains[k][1]), (gains[k][1], hi)]
    out = np.zeros(len(grad))
    for lo, hi in leaves:
        out[lo:hi] = _step(g[hi] - g[lo], w[hi] - w[lo])
    return out


def _pair_tree(grad: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """One cut on the first feature, then one on the second in each half; and its gain."""
    best, made = 0.0, np.zeros_like(grad)
    whole = grad.sum() ** 2 / (weight.sum() + 1)
    for first, second, turned in ((grad, weight, False), (grad.T, weight.T, True)):
        for cut in range(1, len(first)):
            out, gain = np.zeros_like(first), -whole
            for rows in (slice(0, cut), slice(cut, None)):
                g, w = first[rows].sum(axis=0), second[rows].sum(axis=0)
                gs, ws = np.cumsum(g)[:-1], np.cumsum(w)[:-1]
                score = gs**2 / (ws + 1) + (g.sum() - gs) ** 2 / (w.sum() - ws + 1)
                k = int(np.argmax(score))
                gain += score[k]
                out[rows, : k + 1] = _step(gs[k], ws[k])
                out[rows, k + 1 :] = _step(g.sum() - gs[k], w.sum() - ws[k])
            if gain > best:
                best, made = gain, out.T if turned else out
    return made, best


def train(x: np.ndarray, y: np.ndarray) -> Model:
    """Fit tables to features and labels of 0 and 1; without rows every score is 0.5."""
    n_features = x.shape[1]
    edges = [
        np.unique(np.quantile(x[:, f], np.arange(1, BINS) / BINS)) if len(x) else np.zeros(0)
        for f in range(n_features)
    ]
    rate = (y.sum() + 0.5) / (len(y) + 1)
    start = float(np.log(rate / (1 - rate)))
    single = np.zeros((n_features, BINS))
    pairs: list[tuple[int, int]] = []
    double = np.zeros((0, PAIR_BINS, PAIR_BINS))
    if not len(x):
        return Model(edges, start, single, pairs, double)
    b = binned(edges, x)
    margin = np.full(len(x), start)
    for _ in range(ROUNDS):
        for f in range(n_features):
            p = probability(margin)
            step = RATE * _tree(
                np.bincount(b[:, f], y - p, BINS), np.bincount(b[:, f], p * (1 - p), BINS)
            )
            single[f] += step
            margin += step[b[:, f]]
    coarse = coarse_bins(edges, b)
    size = PAIR_BINS * PAIR_BINS

    def grid(f: int, g: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        p = probability(margin)
        cell = coarse[:, f] * PAIR_BINS + coarse[:, g]
        shape = PAIR_BINS, PAIR_BINS
        return (
            cell, np.bincount(cell, y - p, size).reshape(shape),
            np.bincount(cell, p * (1 - p), size).reshape(shape),
        )

    every = [(f, g) for f in range(n_features) for g in range(f + 1, n_features)]
    gains = {k: _pair_tree(*grid(*k)[1:])[1] for k in every}
    pairs = [k for k in sorted(every, key=lambda k: (-gains[k], k))[:PAIRS] if gains[k] > 1e-9]
    double = np.zeros((len(pairs), PAIR_BINS, PAIR_BINS))
    for _ in range(PAIR_ROUNDS):
        for k, pair in enumerate(pairs):
            cell, grad, weight = grid(*pair)
            step = RATE * _pair_tree(grad, weight)[0]
            double[k] += step
            margin += step.ravel()[cell]
    return Model(edges, start, single, pairs, double)


def _with_features(rows: DataFrame, kept: Sequence[str]) -> DataFrame:
    types = dict(rows.dtypes)

    def work(batches):
        for batch, texts in text_chunks(batches, "_text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in range(len(kept))]
                + [pa.array([features(t) for t in texts], pa.list_(pa.float64()))],
                [*kept, "x"],
            )

    schema = ", ".join([*(f"`{c}` {types[c]}" for c in kept), "x array<double>"])
    return rows.select(*kept, "_text").mapInArrow(released(work), schema)


def fit(
    docs: DataFrame, labels: DataFrame, train_on: Column, doc_id: str = "doc_id",
    text: str = "text", label: str = "quality", sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """Learn from the labelled rows of ``docs`` that ``train_on`` selects.

    Labels other than 0 and 1 and null ids teach nothing; a null text counts as empty.
    Rows labelled several times teach each of their labels.
    """
    known = labels.filter(F.col(label).isin(0, 1)).select(
        F.col(doc_id).alias("_id"), F.col(label).cast("double").alias("_y")
    )
    rows = docs.filter(train_on).select(F.col(doc_id).alias("_of"), F.col(text).alias("_text"))
    rows = rows.join(known, F.col("_of") == F.col("_id")).withColumn("_at", F.xxhash64("_text", "_of"))
    size = rows.count()
    if size > sample_rows:  # by hash, so that only about that many texts are read on
        share = int(sample_rows / size * 1_000_000)
        rows = rows.filter(F.pmod(F.col("_at"), F.lit(1_000_000)) < share)
    # Sorted, as sums of floating numbers depend on their order.
    got = _with_features(rows, ["_y", "_at"]).orderBy("_at", "_y").limit(2 * sample_rows).toArrow()
    x = np.array(got["x"].to_pylist(), dtype=float).reshape(-1, len(FEATURES))
    return train(x, got["_y"].to_numpy())


def score(
    docs: DataFrame, model: Model, text: str = "text", keep: Sequence[str] | None = None
) -> DataFrame:
    """``docs`` (or the columns in ``keep``) with ``score`` and ``predicted``.

    Columns of these names, in any case, are replaced.  One row per row; null and empty texts are
    scored like any other, as texts whose features are all zero.
    """
    names = ["score", "predicted"]
    kept = carried(docs, names, keep)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = beside(docs, kept, text=F.col(text))

    def work(batches):
        for batch, texts in text_chunks(batches, "text"):
            p = probability(margins(shared.value, np.array([features(t) for t in texts])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["row", *names]
            )

    made = rows.mapInArrow(released(work), row_schema(rows, "score double, predicted int"))
    return unpacked(made, kept, *names)
