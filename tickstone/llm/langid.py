"""Language identification with character language models.

One interpolated Kneser-Ney model per language over letters and the gaps between
them.  The models of up to ``BLOCK`` languages share one sorted array of n-gram hashes
per order (four symbols of 16 bits each, so the hash of an n-gram of the basic plane is
the n-gram itself); beside each hash stand the finished log-probabilities in each of them.
The language of lowest cross-entropy per symbol wins.  Each language's own spread
of cross-entropy sets how much worse a text may be before it is rejected.

The models are a classifier fitted on a bounded sample: at most about
``sample_docs`` different labelled texts of each language, chosen by a hash of their
text, and all of a language that has fewer.  Copies of a text count as one.
Scoring reads every whole text.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scratch import materialise
from .common import beside, carried, released, row_schema, text_chunks

ORDER = 4
#: Different labelled texts of each language to learn from, on average at most.
SAMPLE_DOCS = 3000
#: Standard deviations above its language's mean at which a text is rejected.
REJECT_AT = 6.0
#: Nats per symbol above that mean which are always allowed: mixed texts stay.
REJECT_MARGIN = 0.5
#: Symbols after which a text's evidence no longer makes the score surer.
SURE_AFTER = 40
UNKNOWN = "und"
#: Languages whose tables stand side by side.
BLOCK = 32
#: Languages up to which their shares of the sample are broadcast, and beyond which joined.
FEW_LANGS = 100_000

_CHUNK = 1 << 20  # text bytes in hand: each takes some hundred bytes of arrays
_GAP = 0x20
_BASIC = 1 << 16


def _symbol_table() -> np.ndarray:
    """Symbol of each character of the basic plane: a letter in lower case, else a gap."""
    out = np.full(_BASIC, _GAP, dtype=np.uint16)
    for i in range(_BASIC):
        c = chr(i)
        if c.isalpha():
            low = ord(c.lower()[0])
            out[i] = low if low < _BASIC else i
    return out


_SYMBOLS: list[np.ndarray] = []


def symbols(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts' symbols in a row, with the start of each text and its number of
    letters.  Every text begins and ends with a gap, and gaps never repeat."""
    if not _SYMBOLS:
        _SYMBOLS.append(_symbol_table())
    points = np.frombuffer(
        "".join([f" {t.decode('utf-8', 'replace')} " for t in texts]).encode("utf-32-le"), np.uint32
    )
    sizes = np.array([len(t.decode("utf-8", "replace")) + 2 for t in texts], dtype=np.int64)
    high = points >= _BASIC
    row = _SYMBOLS[0][np.where(high, 0, points)]
    if high.any():  # letters beyond the basic plane share its 16 bits by hash
        at = np.flatnonzero(high)
        is_letter = np.array([chr(c).isalpha() for c in points[at]])
        row[at] = np.where(is_letter, 0xE000 + points[at] % 0x1900, _GAP)
    gap = row == _GAP
    kept = ~gap
    kept[1:] |= ~gap[:-1]
    start = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    kept[start] = True
    letters = np.add.reduceat(~gap, start) if len(start) else np.zeros(0, dtype=np.int64)
    before = np.concatenate([[0], np.cumsum(kept)])
    # A text of gaps alone keeps its first gap and, after it, nothing else.
    return row[kept], before[start], letters


def grams(row: np.ndarray, start: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams that end at each symbol but a text's first; symbols
    before the text count as gaps.  Also the text of each."""
    n = len(row)
    of = np.zeros(n, dtype=np.int64)
    of[start[1:]] = 1
    of = np.cumsum(of)
    ends = np.ones(n, dtype=bool)
    ends[start] = False
    place = np.arange(n) - start[of] if n else of
    code = row.astype(np.uint64)
    for back in range(1, order):
        earlier = np.full(n, _GAP, dtype=np.uint64)
        if n > back:
            earlier[back:] = np.where(place[back:] >= back, row[:-back], _GAP)
        code |= earlier << np.uint64(16 * back)
    return code[ends], of[ends]


@dataclass(frozen=True)
class Block:
    """Sorted hashes and log-probabilities of some languages, by order from 1."""

    langs: list[str]
    keys: list[np.ndarray]
    logp: list[np.ndarray]  # (n-grams, languages), natural logarithms
    contexts: list[np.ndarray]  # sorted contexts of each order
    back: list[np.ndarray]  # log of the weight left for the shorter context
    floor: np.ndarray  # of a symbol no language has


@dataclass(frozen=True)
class Models:
    """All languages, in blocks that store only n-grams of their own."""

    blocks: list[Block]
    mean: np.ndarray  # of cross-entropy, by language
    spread: np.ndarray  # between texts
    noise: np.ndarray  # of one symbol

    @property
    def langs(self) -> list[str]:
        return [name for b in self.blocks for name in b.langs]


def _find(keys: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(code), dtype=np.int64), np.zeros(len(code), dtype=bool)
    at = np.minimum(np.searchsorted(keys, code), len(keys) - 1)
    return at, keys[at] == code


def log_probabilities(m: Block, code: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Of each n-gram's last symbol after the others, in every language."""
    if order == 0:
        return np.broadcast_to(m.floor, (len(code), len(m.langs)))
    at, known = _find(m.keys[order - 1], code)
    out = m.logp[order - 1].take(at, axis=0) if len(m.keys[order - 1]) else np.zeros(
        (len(code), len(m.langs)), dtype=np.float32
    )
    if not known.all():
        rest = np.flatnonzero(~known)
        lost = code[rest]
        shorter = log_probabilities(m, lost & _low(order - 1), order - 1)
        here, seen = _find(m.contexts[order - 1], lost >> np.uint64(16))
        weight = np.where(seen[:, None], m.back[order - 1][here], 0.0) if len(
            m.contexts[order - 1]
        ) else 0.0
        out[rest] = shorter + weight
    return out


def _low(n: int) -> np.uint64:
    return np.uint64((1 << (16 * n)) - 1)


def train(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Models:
    """Models from each language's sorted n-grams of the highest order and their counts.

    A block holds ``BLOCK`` languages, so memory grows with the n-grams of the languages
    and not with the product of all n-grams and all languages.
    """
    langs = sorted(counts)
    size = len(np.unique(np.concatenate([np.unique(c & _low(1)) for c, _ in counts.values()])))
    blocks = [
        _trained({name: counts[name] for name in langs[k:k + BLOCK]}, max(size, 1))
        for k in range(0, len(langs), BLOCK)
    ]
    none = np.zeros(len(langs))
    return Models(blocks, none, none, none)


def _trained(counts: dict[str, tuple[np.ndarray, np.ndarray]], size: int) -> Block:
    """One block; ``size`` is the number of different symbols of all languages."""
    langs = sorted(counts)
    tables = []  # by order: (codes, counts by language)
    codes = np.unique(np.concatenate([c for c, _ in counts.values()]))
    count = np.zeros((len(codes), len(langs)))
    for j, lang in enumerate(langs):
        count[np.searchsorted(codes, counts[lang][0]), j] = counts[lang][1]
    tables.append((codes, count))
    for n in range(ORDER - 1, 0, -1):
        # A shorter n-gram counts the different symbols found before it.
        above, seen = tables[-1]
        low, where = np.unique(above & _low(n), return_inverse=True)
        count = np.zeros((len(low), len(langs)))
        np.add.at(count, where, seen > 0)
        tables.append((low, count))
    tables.reverse()
    keys, logp, contexts, back = [], [], [], []
    floor = None
    for n, (codes, count) in enumerate(tables, 1):
        once, twice = (count == 1).sum(axis=0), (count == 2).sum(axis=0)
        discount = np.clip(once / np.maximum(once + 2 * twice, 1), 0.1, 0.9)
        ctx, where = np.unique(codes >> np.uint64(16), return_inverse=True)
        total, kinds = np.zeros((len(ctx), len(langs))), np.zeros((len(ctx), len(langs)))
        np.add.at(total, where, count)
        np.add.at(kinds, where, count > 0)
        left = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
        if n == 1:
            lower = np.full(len(langs), 1.0 / (size + 1))
            floor = np.log(lower)  # what is left for it is weighed in where it is used
        else:
            lower = np.exp(logp[-1][np.searchsorted(keys[-1], codes & _low(n - 1))])
        p = np.maximum(count - discount, 0) / np.maximum(total, 1)[where] + left[where] * lower
        keys.append(codes)
        logp.append(np.log(p).astype(np.float32))
        contexts.append(ctx)
        back.append(np.log(left))
    return Block(langs, keys, logp, contexts, back, floor.astype(np.float32))


def entropies(m: Models, texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cross-entropy per symbol of each text in each language, its symbols, its letters."""
    row, start, letters = symbols(texts)
    code, of = grams(row, start, ORDER)
    n = np.bincount(of, minlength=len(texts))
    total = np.empty((len(texts), len(m.langs)))
    at = 0
    for block in m.blocks:
        logs = log_probabilities(block, code)
        for j in range(len(block.langs)):
            total[:, at + j] = np.bincount(of, logs[:, j], minlength=len(texts))
        at += len(block.langs)
    return -total / np.maximum(n, 1)[:, None], n, letters


def _sampled(labelled: DataFrame, sample_docs: int) -> DataFrame:
    """Different texts of each language, ``sample_docs`` on average of a language that has
    more and else all, with ``_held``: every fifth is held out to calibrate."""
    each = labelled.groupBy("_lang", F.xxhash64("_text").alias("_hash")).agg(F.count(F.lit(1)).alias("_n"))
    share = F.floor(1_000_000 * F.least(F.lit(1.0), F.lit(float(sample_docs)) / F.col("n")))
    shares = materialise(
        each.groupBy(F.col("_lang").alias("_of")).agg(F.count(F.lit(1)).alias("n")).select("_of", share.alias("_share"))
    )
    if shares.count() <= FEW_LANGS:  # a name and a number each
        shares = F.broadcast(shares)
    spot = F.pmod(F.xxhash64("_text"), F.lit(1_000_000))
    drawn = labelled.join(shares, F.col("_lang") == F.col("_of")).filter(spot < F.col("_share"))
    # Copies are cut to one by each task before they are dealt.
    drawn = drawn.groupBy("_lang", F.xxhash64("_text").alias("_hash")).agg(
        F.first("_text").alias("_text")
    )
    held = F.pmod(F.xxhash64(F.reverse(F.col("_text"))), F.lit(5)) == 0
    return materialise(drawn.select("_lang", "_text", held.alias("_held")))


def fit(
    docs: DataFrame, train_on: Column, lang: str = "lang", text: str = "text",
    sample_docs: int = SAMPLE_DOCS,
) -> Models | None:
    """Models of every language that labels a text with a letter; none without any.

    The sample's n-grams are counted in tasks and summed by Spark; what reaches the
    driver is bounded by the sample.  The models learn from the whole sample.  How well
    a language's own texts fit is measured on the texts held out, with models that
    learned without them.
    """
    labelled = docs.filter(train_on & F.col(lang).isNotNull() & F.col(text).isNotNull())
    sample = _sampled(labelled.select(F.col(lang).alias("_lang"), F.col(text).alias("_text")), sample_docs)

    def count(batches):
        for batch, texts in text_chunks(batches, "_text", _CHUNK):
            names = np.array(batch.column(0).to_pylist(), dtype=object)
            out = np.array(batch.column(2).to_pylist())
            for name in set(names):
                row, start, letters = symbols([texts[i] for i in np.flatnonzero(names == name)])
                code, of = grams(row, start, ORDER)
                used = letters[of] > 0
                code, where = np.unique(code[used], return_inverse=True)
                of_rest = ~out[names == name][of[used]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(code), pa.string()), pa.array(code.view(np.int64)),
                     pa.array(np.bincount(where, minlength=len(code)).astype(np.int64)),
                     pa.array(np.bincount(where, of_rest, len(code)).astype(np.int64))],
                    ["lang", "code", "n", "rest"],
                )

    counted = (
        sample.mapInArrow(released(count), "lang string, code bigint, n bigint, rest bigint")
        .groupBy("lang", "code").agg(F.sum("n").alias("n"), F.sum("rest").alias("rest"))
    ).toPandas()
    if not len(counted):
        return None

    def trained(column: str) -> Models | None:
        counts = {}
        for name, part in counted[counted[column] > 0].groupby("lang"):
            code = part["code"].to_numpy().view(np.uint64)
            order = np.argsort(code)
            counts[name] = code[order], part[column].to_numpy()[order]
        return train(counts) if counts else None

    without = trained("rest")
    known = {name: k for k, name in enumerate(without.langs)} if without else {}

    def measure(batches):
        for batch, texts in text_chunks(batches, "_text", _CHUNK):
            h, n, letters = entropies(without, texts)
            names = batch.column(0).to_pylist()
            rows = [
                (name, float(h[i, known[name]]), int(n[i]))
                for i, name in enumerate(names) if name in known and letters[i]
            ]
            lang_of, entropy, size = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang_of, pa.string()), pa.array(entropy, pa.float64()),
                 pa.array(size, pa.int64())], ["lang", "h", "n"],
            )

    own = (
        sample.filter("_held").mapInArrow(released(measure), "lang string, h double, n bigint")
        .groupBy("lang").agg(F.avg("h").alias("mean"), F.stddev_pop("h").alias("spread"))
    ).collect() if without else []
    found = {r["lang"]: r for r in own}
    models = trained("n")
    mean = np.array([found[x]["mean"] if x in found else np.nan for x in models.langs])
    spread = np.array([found[x]["spread"] if x in found else np.nan for x in models.langs])
    # A language too rare to calibrate takes the largest figures of the others.
    worst = np.nanmax(mean) if np.isfinite(mean).any() else np.inf
    mean = np.where(np.isfinite(mean), mean, worst)
    spread = np.where(np.isfinite(spread), spread, 1.0)
    noise = np.full(len(mean), 2.0)  # variance of one symbol's log-probability, at most about 2
    return Models(models.blocks, mean, spread, noise)


def identify(m: Models | None, texts: Sequence[bytes]) -> list[tuple[str, float, bool]]:
    """Language, score from 0 to 1 and rejection of each text.

    ``und`` with score 0, rejected, if a text has no letter or nothing was learned.
    Equal cross-entropies go to the language first in the alphabet.
    """
    if m is None or not texts:
        return [(UNKNOWN, 0.0, True)] * len(texts)
    h, n, letters = entropies(m, texts)
    langs = m.langs
    best = np.argmin(h, axis=1)
    lead = (h - h.min(axis=1, keepdims=True)) * np.minimum(n, SURE_AFTER)[:, None]
    score = 1.0 / np.exp(-lead).sum(axis=1)
    allowed = m.mean + np.maximum(
        REJECT_MARGIN, REJECT_AT * np.sqrt(m.spread**2 + m.noise / np.maximum(n, 1)[:, None])
    )
    least = h[np.arange(len(h)), best]
    rejected = least > allowed[np.arange(len(h)), best]
    return [
        (langs[b], float(s), bool(r)) if k else (UNKNOWN, 0.0, True)
        for b, s, r, k in zip(best, score, rejected, letters, strict=True)
    ]


def predict(
    docs: DataFrame, models: Models | None, text: str = "text", keep: Sequence[str] | None = None
) -> DataFrame:
    """``docs`` (or the columns in ``keep``) with ``lang_pred``, ``score``, ``rejected``.

    Columns of these names, in any case, are replaced.  One row per row: null, empty and
    letterless texts are ``und``, rejected; without any learned language all are.
    """
    names = ["lang_pred", "score", "rejected"]
    kept = carried(docs, names, keep)
    shared = docs.sparkSession.sparkContext.broadcast(models)  # bounded by the sample
    # The text goes to the tasks once, also where it is kept.
    others, whole = [c for c in kept if c != text], text in kept
    rows = beside(docs, others, text=F.col(text))

    def work(batches):
        for batch, texts in text_chunks(batches, "text", _CHUNK):
            lang, score, rejected = zip(*identify(shared.value, texts), strict=True)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:1 + whole], pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)],
                ["row", *["text"] * whole, *names],
            )

    made = "text string, " * whole + "lang_pred string, score double, rejected boolean"
    found = rows.mapInArrow(released(work), row_schema(rows, made))
    return found.select(
        *(F.col("text").alias(c) if c == text else F.col("row")[c].alias(c) for c in kept), *names
    )
