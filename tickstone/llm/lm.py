"""Scores of a log-bilinear neural language model, beside those of a unigram model.

*Counts* of all training tokens are made by Spark.  Words are told apart by a 64-bit
hash.  The most frequent ones (``HEAD`` at most) go to the tasks as sorted arrays of
bounded size; the others meet their counts in a join, so no vocabulary is ever whole in
one place.

*Model.*  The ``OWN`` most frequent words and the end of a text are classes of their
own; every other word belongs to one of a few classes told by its spelling (its last
character, its length, letters beyond ASCII).  A class is predicted from the classes of
the last three tokens: their vectors, each through its place's matrix, add up to a
predicted vector, whose products with the class vectors plus biases are the scores, and
a softmax over all classes normalises them.  Within a spelling class a word has its
smoothed share of the class, with one share left for all unseen words, so the
probabilities of each token's possible outcomes add up to one.

*Training* is noise-contrastive, in numpy, in the tasks.  The training texts, as class
numbers, are dealt by hash into slices of about ``SLICE_TOKENS`` tokens; each slice runs
over its texts, in the order of their hashes, from common parameters, and Spark averages
the results by the number of tokens they saw, for ``ROUNDS`` rounds.  So the parameters
follow from the texts and not from how the table is partitioned, and more data makes
more slices and not thinner ones.  Every training row takes part in each round: texts
that are alike are stored once with their number, and each copy is dealt by itself, so
that the copies of one text spread over all slices.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scratch import materialise
from .common import beside, carried, released, row_schema, text_chunks, unpacked
from .substrings import Words

#: Words whose counts are broadcast at most: 16 bytes each.
HEAD = 400_000
#: Words that are classes of their own.
OWN = 256
SPELLINGS = 40
CONTEXT, SIZE = 3, 16
ROUNDS, NOISE, BATCH, RATE = 2, 64, 1024, 0.05
#: Tokens of a training slice, on average.
SLICE_TOKENS = 4_000_000
_RUN = 300_000  # tokens a trainer takes in hand at once
_CHUNK = 2 << 20
_PIECE = 1 << 19  # text bytes whose words are found at once: their hashes stay in the cache
_BLOCK = 256  # contexts whose class scores stay in the processor's cache
_NORMS = 1_000_000  # contexts whose sums a task keeps: 16 bytes each
_HELD = 1_500_000  # distinct words a task gathers before it hands them on
_END = 0  # class of the end; own words follow, then spellings
CLASSES = 1 + OWN + SPELLINGS
_START = CLASSES  # stands before a text


class Tokens:
    """The words of some texts: hash and spelling class of each."""

    def __init__(self, texts: Sequence[bytes]):
        parts, start, size = [], 0, 0
        for end, t in enumerate(texts, 1):
            size += len(t)
            if size >= _PIECE or end == len(texts):
                h, text, spelling = self._of(texts[start:end])
                parts.append((h, text + start, spelling))
                start, size = end, 0
        self.hash, self.text, self.spelling = (
            (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else self._of([])
        )

    @staticmethod
    def _of(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        words = Words([t.lower() for t in texts])  # bytes: A-Z alone
        data = np.frombuffer(words.raw, np.uint8)
        last = data[words.end - 1] if len(words.end) else np.zeros(0, dtype=np.uint8)
        kind = _KINDS[last]
        # Blanks, which are all that stands between two starts but for a word, are below 128.
        foreign = np.maximum.reduceat(data, words.start) >= 128 if len(last) else last > 0
        size = words.end - words.start
        length = (size > 4).astype(np.int64) + (size > 9)
        return words.each[0], words.text, ((kind * 2 + foreign) * 3 + length) % SPELLINGS


# What a word ends with: a letter, a digit, . , ! or ?, another sign.
_KINDS = np.full(256, 5, dtype=np.int64)
_KINDS[list(range(97, 123)) + list(range(128, 256))] = 0
_KINDS[list(b"0123456789")] = 1
_KINDS[list(b".")], _KINDS[list(b",")], _KINDS[list(b"!?")] = 2, 3, 4


@dataclass(frozen=True)
class Model:
    """Bounded parameters; ``total`` is 0 if there was no training text."""

    total: int  # training tokens N
    distinct: int  # different ones V
    ends: int  # training texts
    head: np.ndarray  # sorted hashes
    head_count: np.ndarray
    own: np.ndarray  # sorted hashes
    spelling_mass: np.ndarray  # of the words without a class of their own: sum of count + 1
    class_count: np.ndarray
    vectors: np.ndarray  # (CLASSES + 1, SIZE): what a class predicts from
    places: np.ndarray  # (CONTEXT, SIZE, SIZE)
    targets: np.ndarray  # (CLASSES, SIZE)
    bias: np.ndarray

    def parameters(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.vectors, self.places, self.targets, self.bias)])

    def with_parameters(self, flat: np.ndarray) -> Model:
        out, at = {}, 0
        for name in ("vectors", "places", "targets", "bias"):
            shape = getattr(self, name).shape
            size = int(np.prod(shape))
            out[name] = flat[at : at + size].reshape(shape)
            at += size
        return replace(self, **out)


def _find(keys: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(h), dtype=np.int64), np.zeros(len(h), dtype=bool)
    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    return at, keys[at] == h


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``np.unique`` returns with ``return_index`` and ``return_inverse``, for 64-bit
    keys without sign that differ in their upper bits, as hashes do."""
    # The places ride in the lower bits, so that plain numbers are sorted.
    bits = np.uint64(len(keys).bit_length())
    packed = keys >> bits << bits
    packed |= np.arange(len(keys), dtype=np.uint64)
    packed.sort()
    packed &= (np.uint64(1) << bits) - np.uint64(1)
    order = packed.view(np.int64)
    found = keys.take(order)
    if (found[1:] < found[:-1]).any():  # some differ in their lower bits alone
        order = keys.argsort(kind="stable")
        found = keys.take(order)
    new = np.ones(len(keys), dtype=bool)
    np.not_equal(found[1:], found[:-1], out=new[1:])
    which = np.empty(len(keys), dtype=np.int64)
    which[order] = np.cumsum(new) - 1
    return found[new], order[new], which


def sequences(own: tuple[np.ndarray, np.ndarray], t: Tokens, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all tokens of ``n`` texts, each with its end; the text of each.  ``own``
    is what :func:`_find` says of the words among those with a class of their own."""
    at, found = own
    size = np.bincount(t.text, minlength=n) + 1
    text = np.repeat(np.arange(n), size)
    classes = np.full(len(text), _END)
    # Words stand in the order of their texts, and before each the ends of those before it.
    classes[np.arange(len(t.text)) + t.text] = np.where(found, 1 + at, 1 + OWN + t.spelling)
    return classes, text


def _before(classes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The classes before each token in its text, last first."""
    before = np.full((CONTEXT, len(classes)), _START)
    for k in range(1, CONTEXT + 1):
        if len(classes) > k:
            same = text[k:] == text[:-k]
            before[k - 1, k:] = np.where(same, classes[:-k], _START)
    return before


def _predicted(tables: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Sum over the places of what the class there adds, a row per token."""
    out = tables[0].take(before[0], axis=0)
    for k in range(1, CONTEXT):
        out += tables[k].take(before[k], axis=0)
    return out


class Norms:
    """The logarithm of the sum over all classes, after contexts met before."""

    def __init__(self):
        self.contexts, self.norm = np.zeros(0, dtype=np.int64), np.zeros(0)

    def add(self, contexts: np.ndarray, norm: np.ndarray) -> None:
        """Further ones, in order; the earlier ones make room when there are too many."""
        if len(self.contexts) + len(contexts) > _NORMS:
            self.__init__()
        at = np.searchsorted(self.contexts, contexts)
        self.contexts, self.norm = np.insert(self.contexts, at, contexts), np.insert(self.norm, at, norm)


def class_log10(m: Model, classes: np.ndarray, before: np.ndarray, met: Norms | None = None) -> np.ndarray:
    """Normalised log10-probability of each class after its context.  ``met`` carries over
    what was computed for earlier tokens."""
    # A score is a sum of what each place adds to it, so its power is a product of three.
    scores = np.stack([m.vectors @ p @ m.targets.T for p in m.places])
    scores[0] += m.bias
    top = scores.max(axis=2)
    powers = np.exp(scores - top[:, :, None]).astype(np.float32)
    # Many tokens share their context, and with it the sum over all classes.
    shape, met = (CLASSES + 1,) * CONTEXT, met or Norms()
    room = np.uint64(64 - ((CLASSES + 1) ** CONTEXT).bit_length())
    kinds, _, of = _distinct(np.ravel_multi_index(tuple(before), shape).astype(np.uint64) << room)
    kinds = (kinds >> room).astype(np.int64)
    at, found = _find(met.contexts, kinds)
    norm = met.norm[at] if len(met.norm) else np.empty(len(kinds))
    fresh = np.flatnonzero(~found)
    space = np.empty((2, _BLOCK, CLASSES), dtype=np.float32)
    for at in range(0, len(fresh), _BLOCK):
        part = fresh[at : at + _BLOCK]
        contexts = np.stack(np.unravel_index(kinds[part], shape))
        product, more = space[:, : len(part)]
        powers[0].take(contexts[0], axis=0, out=product, mode="clip")
        for k in range(1, CONTEXT):
            powers[k].take(contexts[k], axis=0, out=more, mode="clip")
            if k < CONTEXT - 1:
                product *= more
        total = np.einsum("ij,ij->i", product, more).astype(np.float64)
        low = total < 1e-20  # the tops lie apart: too little is left of the product
        total[low] = 1
        norm[part] = np.log(total) + sum(t.take(c) for t, c in zip(top, contexts, strict=True))
        if low.any():
            norm[part[low]] = np.logaddexp.reduce(_predicted(scores, contexts[:, low]), axis=1)
    met.add(kinds[fresh], norm[fresh])
    out = -norm.take(of)
    for k in range(CONTEXT):
        out += scores[k].ravel().take(before[k] * CLASSES + classes)
    return out / np.log(10)


# Where rows of ``SIZE`` are added up, two neighbouring numbers go as one complex number.
_CELLS = np.arange((CLASSES + 1) * CONTEXT * SIZE // 2).reshape(-1, SIZE // 2)


class Trainer:
    """Noise-contrastive steps with a rate per parameter that falls as it moves."""

    def __init__(self, m: Model, seed: int):
        self.flat = m.parameters().astype(np.float32)
        self.m = m.with_parameters(self.flat)  # views: they follow ``flat``
        self.noise = (m.class_count + 1) / (m.class_count + 1).sum()
        self.log_noise = np.log(NOISE * self.noise).astype(np.float32)
        self.rng = np.random.default_rng(seed)
        self.moved = np.full(len(self.flat), 1e-2)
        self.gradient = np.empty(len(self.flat))
        self.g = m.with_parameters(self.gradient)
        # What a step computes is written where the step before had it.
        self.tables = np.empty((CLASSES + 1, CONTEXT * SIZE), dtype=np.float32)
        self.g_tables = np.empty((CLASSES + 1, CONTEXT * SIZE))
        # The bias rides in the products: each prediction ends with a one.
        self.predicted = np.ones((BATCH, SIZE + 1), dtype=np.float32)
        self.space = np.empty(BATCH * NOISE, dtype=np.float32)
        self.places = np.empty((CONTEXT, BATCH, SIZE), dtype=np.float32)
        self.wanted = np.empty((BATCH, SIZE), dtype=np.float32)
        self.exact = np.empty((BATCH, SIZE))
        self.cells = np.empty((BATCH, SIZE // 2), dtype=np.int64)
        self.change = np.empty((2, len(self.flat)))
        self.seen = 0

    def add(self, out: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
        """Add each row of ``values`` to the row of ``out`` that ``rows`` names."""
        at = _CELLS.take(rows, axis=0, out=self.cells[: len(rows)], mode="clip")
        np.add.at(out.ravel().view(np.complex128), at.ravel(), values.ravel().view(np.complex128))

    def step(self, classes: np.ndarray, before: np.ndarray, drawn: np.ndarray, times: np.ndarray) -> None:
        """``before``: rows of the tables; ``drawn``: different classes, each ``times`` times."""
        n, m, g, g_tables = len(classes), self.m, self.g, self.g_tables
        # What a class adds to the prediction: a row for each class and place.
        np.matmul(m.vectors, m.places.transpose(1, 0, 2).reshape(SIZE, -1), out=self.tables)
        places, wanted, exact = self.places[:, :n], self.wanted[:n], self.exact[:n]
        for at, out in zip(before, places, strict=True):
            self.tables.reshape(-1, SIZE).take(at, axis=0, out=out, mode="clip")
        predicted = places[0]
        for out in places[1:]:
            predicted += out
        rows, above = self.predicted[:n], m.bias - self.log_noise
        rows[:, :SIZE] = predicted
        m.targets.take(classes, axis=0, out=wanted, mode="clip")
        up = 1 / (1 + np.exp(np.einsum("bt,bt->b", predicted, wanted) + above.take(classes)))
        # A class drawn more than once is computed once and counts as often as drawn.
        noise = m.targets.take(drawn, axis=0)
        others = -np.vstack([noise.T, above.take(drawn)])
        down = np.matmul(rows, others, out=self.space[: n * len(drawn)].reshape(n, -1))
        np.exp(down, out=down)
        down += 1
        np.divide(-1, down, out=down)
        g_others = (down.T @ rows) * times[:, None].astype(np.float64)
        np.multiply(up[:, None], predicted, out=exact)
        g.targets[:] = 0
        self.add(g.targets, classes, exact)
        g.targets[drawn] += g_others[:, :SIZE]
        g.bias[:] = np.bincount(classes, up, CLASSES)
        g.bias[drawn] += g_others[:, SIZE]
        wanted *= up[:, None]
        g_predicted = np.matmul(down, noise * times[:, None].astype(np.float32), out=places[1])
        np.add(g_predicted, wanted, out=exact)
        # The tables' gradients hold those of vectors and places: both are linear in them.
        g_tables[:] = 0
        for at in before:
            self.add(g_tables, at, exact)
        np.matmul(g_tables, m.places.transpose(0, 2, 1).reshape(-1, SIZE).astype(np.float64), out=g.vectors)
        g_places = m.vectors.T.astype(np.float64) @ g_tables
        g.places[:] = g_places.reshape(SIZE, CONTEXT, SIZE).transpose(1, 0, 2)
        change, root = self.change
        np.divide(self.gradient, n, out=change)
        np.square(change, out=root)
        self.moved += root
        np.sqrt(self.moved, out=root)
        change *= RATE
        change /= root
        self.flat += change
        self.seen += n

    def run(self, classes: np.ndarray, before: np.ndarray) -> None:
        order = self.rng.permutation(len(classes))
        starts = range(0, len(order), BATCH)
        drawn = np.sort(self.rng.choice(CLASSES, (len(starts), NOISE), p=self.noise), axis=1)
        first = np.flatnonzero(np.diff(drawn, axis=1, prepend=-1))
        drawn, times = drawn.ravel()[first], np.diff(first, append=drawn.size)
        ends = np.searchsorted(first, np.arange(len(starts) + 1) * NOISE)
        # Class and table rows side by side: one look-up for each token.
        tokens = np.empty((len(classes), 1 + CONTEXT), dtype=np.uint16)
        tokens[:, 0], tokens[:, 1:] = classes, before.T * CONTEXT + np.arange(CONTEXT)
        with np.errstate(over="ignore"):  # a score too low for exp has a gradient of zero
            for k, at in enumerate(starts):
                part = tokens.take(order[at : at + BATCH], axis=0).T.astype(np.int64, order="C")
                noise = slice(ends[k], ends[k + 1])
                self.step(part[0], part[1:], drawn[noise], times[noise])


def _counted(rows: DataFrame) -> DataFrame:
    """``word`` (hash), ``spelling``, ``n`` over all texts."""

    def work(batches: Iterator[pa.RecordBatch]):
        held: list[tuple] = []
        size = 0

        def merged(parts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            h, s, n = (np.concatenate(c) for c in zip(*parts, strict=True))
            keys, at, where = _distinct(h)
            return keys, s[at], np.bincount(where, n, len(keys)).astype(np.int64)

        def batch_of(h, s, n):
            return pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(s.astype(np.int32)), pa.array(n)],
                ["word", "spelling", "n"],
            )

        for _, texts in text_chunks(batches, "_text", _CHUNK):
            t = Tokens(texts)
            held.append(merged([(t.hash, t.spelling, np.ones(len(t.hash), dtype=np.int64))]))
            size += len(held[-1][0])
            if size > _HELD:
                held = [merged(held)]
                size = len(held[0][0])
                if size > _HELD // 2:  # else most were repeats: go on gathering
                    yield batch_of(*held[0])
                    held, size = [], 0
        if held:
            yield batch_of(*merged(held))

    each = rows.select("_text").mapInArrow(released(work), "word bigint, spelling int, n bigint")
    return each.groupBy("word").agg(F.first("spelling").alias("spelling"), F.sum("n").alias("n"))


def fit(docs: DataFrame, train_on: Column, text: str = "text") -> tuple[Model, DataFrame]:
    """The model, and the table of all training words' counts (``word``, ``n``).

    A null text counts as empty: it has an end and no words.
    """
    rows = docs.filter(train_on).select(F.coalesce(F.col(text), F.lit("")).alias("_text"))
    counts = materialise(_counted(rows))
    ends = rows.count()
    whole = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    total, distinct = (whole[0] or 0) + ends, whole[1] + (ends > 0)
    # The least power step of counts above which at most HEAD words lie.
    step = F.floor(F.log2("n") * 8).cast("int")
    sizes = {r["s"]: r["k"] for r in counts.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("k")).collect()}
    cut, room = 10**9, HEAD
    for s in sorted(sizes, reverse=True):
        if sizes[s] > room:
            break
        room, cut = room - sizes[s], s
    head = counts.filter(step >= cut).select("word", "n").toArrow()
    h, n = head["word"].to_numpy().view(np.uint64), head["n"].to_numpy()
    order = np.argsort(h)
    h, n = h[order], n[order]
    top = counts.orderBy(F.col("n").desc(), "word").limit(OWN).collect()
    own = np.sort(np.array([r["word"] for r in top], dtype=np.int64).view(np.uint64))
    others = counts if not top else counts.filter(~F.col("word").isin([r["word"] for r in top]))
    mass, class_count = np.zeros(SPELLINGS), np.zeros(CLASSES)
    for r in others.groupBy("spelling").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).collect():
        mass[r["spelling"]] = r["n"] + r["k"]
        class_count[1 + OWN + r["spelling"]] = r["n"]
    for r in top:
        class_count[1 + int(np.searchsorted(own, np.uint64(r["word"] & (1 << 64) - 1)))] = r["n"]
    class_count[_END] = ends
    rng = np.random.default_rng(0)
    bias = np.log((class_count + 0.1) / (class_count + 0.1).sum())
    model = Model(
        total, distinct, ends, h, n, own, mass, class_count,
        rng.normal(0, 0.1, (CLASSES + 1, SIZE)), np.stack([np.eye(SIZE)] * CONTEXT),
        rng.normal(0, 0.1, (CLASSES, SIZE)), bias,
    )
    if total:
        texts = materialise(_as_classes(rows, model))
        tokens = texts.agg(F.sum(F.col("times") * F.octet_length("codes"))).first()[0] // 2
        slices = max(-(-tokens // SLICE_TOKENS), 1)
        for turn in range(ROUNDS):
            model = _round(texts, model, turn, slices)
    return model, counts.select("word", "n")


def _as_classes(rows: DataFrame, model: Model) -> DataFrame:
    """``hash`` and ``codes`` (two bytes a token, the end last) of each different text, and
    in ``times`` how many rows have it."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        for batch, texts in text_chunks(batches, "_text", _CHUNK):
            t = Tokens(texts)
            classes, text = sequences(_find(shared.value.own, t.hash), t, len(texts))
            ends = np.searchsorted(text, np.arange(len(texts) + 1)) * 2
            raw = classes.astype("<u2").tobytes()
            codes = [raw[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(codes, pa.binary())], ["hash", "codes"]
            )

    coded = rows.select(F.xxhash64("_text").alias("hash"), "_text").mapInArrow(
        released(work), "hash bigint, codes binary"
    )
    # By the codes too: texts that only share a hash each keep their own.
    return coded.groupBy("hash", "codes").agg(F.count(F.lit(1)).alias("times"))


def _round(texts: DataFrame, model: Model, turn: int, slices: int) -> Model:
    """One pass of every slice over its texts, a text as often as it occurs; parameters
    averaged by tokens seen."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def result(trainer):
        flat = trainer.m.parameters().astype(np.float64)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(flat))), pa.array(flat * trainer.seen),
             pa.array(np.full(len(flat), trainer.seen))], ["at", "value", "seen"],
        )

    def work(batches):
        trainer, now, held, size = None, None, [], 0

        def run():
            if held:
                classes = np.frombuffer(b"".join(held), "<u2").astype(np.int64)
                ended = classes == _END
                trainer.run(classes, _before(classes, np.cumsum(ended) - ended))

        for batch in batches:
            for number, codes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if number != now:
                    run()
                    if trainer is not None:
                        yield result(trainer)
                    trainer, now, held, size = Trainer(shared.value, turn), number, [], 0
                held.append(codes)
                size += len(codes) // 2
                if size >= _RUN:
                    run()
                    held, size = [], 0
        run()
        if trainer is not None:
            yield result(trainer)

    copies = texts.select("hash", "codes", F.explode(F.sequence(F.lit(1).cast("bigint"), "times")).alias("copy"))
    by = F.when(F.col("copy") == 1, F.col("hash")).otherwise(F.xxhash64("hash", "copy"))
    dealt = copies.select("codes", by.alias("by"), F.pmod(by, F.lit(slices)).cast("int").alias("slice"))
    # A slice to each task, whatever its number hashes to.
    dealt = dealt.repartitionById(slices, F.col("slice"))
    dealt = dealt.sortWithinPartitions("slice", "by", "codes").select("slice", "codes")
    got = (
        dealt.mapInArrow(released(work), "at bigint, value double, seen bigint").groupBy("at")
        .agg((F.sum("value") / F.sum("seen")).alias("value")).toArrow()  # a row per parameter
    )
    flat = np.zeros(len(got))
    flat[got["at"].to_numpy()] = got["value"].to_numpy()
    return model.with_parameters(flat)


def score(
    docs: DataFrame, model: Model, counts: DataFrame, text: str = "text",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``docs`` (or the columns in ``keep``) with ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` and ``score``, both log10-probabilities of the text.

    Columns of these names, in any case, are replaced.  One row per row; a null or empty text is one
    token, its end.  If nothing was learned, ``score`` is ``base_score``.
    """
    names = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    kept = carried(docs, names, keep)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    made = ["_n", "_known", "_rare", "_logs", "_score", "_words", "_times"]
    rows = beside(docs, kept, text=F.coalesce(F.col(text), F.lit("")))
    schema = row_schema(
        rows, "_n bigint, _known bigint, _rare bigint, _logs double, _score double, "
        "_words array<bigint>, _times array<bigint>"
    )

    def work(batches):
        m, met = shared.value, Norms()
        for batch, texts in text_chunks(batches, "text", _CHUNK):
            n, t = len(texts), Tokens(texts)
            # Each different word is looked up once.
            words, _, which = _distinct(t.hash)
            at, headed = _find(m.head, words)
            logs = np.where(headed, np.log10((m.head_count[at] if len(m.head) else 0) + 1.0), 0.0).take(which)
            headed = headed.take(which)
            own = tuple(x.take(which) for x in _find(m.own, words))
            size = np.bincount(t.text, minlength=n)
            known = np.bincount(t.text, headed, n).astype(np.int64)
            base = np.bincount(t.text, logs, n)
            inside = np.where(own[1], 0.0, logs - np.log10(m.spelling_mass + 1)[t.spelling])
            likely = np.bincount(t.text, inside, n)
            if m.total:
                classes, of = sequences(own, t, n)
                likely += np.bincount(of, class_log10(m, classes, _before(classes, of), met), n)
            rare = ~headed
            pair, times = np.unique(t.text[rare] * len(words) + which[rare], return_counts=True)
            of, word = np.divmod(pair, max(len(words), 1))
            ends = np.searchsorted(of, np.arange(n + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(size + 1), pa.array(known + (m.ends > 0)), pa.array(size - known),
                    pa.array(base + np.log10(m.ends + 1)), pa.array(likely),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(words[word].view(np.int64))),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(times.astype(np.int64))),
                ], ["row", *made],
            )

    # Written, so that the row numbers drawn here hold for both branches below.
    rows = materialise(
        rows.mapInArrow(released(work), schema).withColumn("_row", F.monotonically_increasing_id())
    )
    rare = rows.filter("_rare > 0").select("_row", F.explode(F.arrays_zip("_words", "_times")).alias("w"))
    rare = rare.select("_row", F.col("w._words").alias("word"), F.col("w._times").alias("times"))
    # Unseen words add nothing to either sum and drop out of the join.
    met = rare.join(counts, "word").groupBy("_row").agg(
        F.sum("times").alias("_met"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("_more")
    )
    more = F.coalesce("_more", F.lit(0.0))
    base = F.col("_logs") + more - F.col("_n") * F.lit(float(np.log10(model.total + model.distinct + 1)))
    likely = F.col("_score") + more if model.total else base
    return unpacked(
        rows.join(met, "_row", "left"), kept, F.col("_n").alias("n_tokens"), (F.col("_known") + F.coalesce("_met", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("bigint").alias("train_tokens"), base.alias("base_score"), likely.alias("score"),
    )
