"""Filter interaction audit: what each filter removes, and what it would have removed
had others not come first.

Every filter is kept as a relation of the ids that fail it, one stored table each.
Whatever survives a prefix of filters depends on the set of its filters alone, so the
left-semi and left-anti joins are not run once for each order: with one filter's table
after the other, the ids are split into those in it (semi) and those not in it (anti),
until ids lie together that fail exactly the same filters.  The survivors of a prefix
are then the relations outside all its tables, the removals of its next filter those
inside that filter's table and outside the earlier ones, the redundant failures those
inside both, and the labels lost those of the removals.  Each id meets each table once,
however many orders are reported.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scratch import materialise
from .common import BLANKS, UPPER, counted_lookup, let, salted_lookup

#: A filter: a condition on the rows that fail, or a function from the identified rows
#: (``doc, part, text_1, text_2`` and the row's own key) to those that fail.
Filter = Column | Callable[[DataFrame], DataFrame]
#: A row is known by two 64-bit hashes over its id, part and text; rows that agree in
#: all three are one row held several times, and no filter can tell them apart.
ROW = ["row_1", "row_2"]


def text_conditions(text: str | Column = "text") -> Column:
    """The letters of the text filters a text fails, as an array.

    A: under 200 words.  B: under half of the words are different.  C: over 2 of 100
    characters are capitals A-Z.  D: holds one of ``#$%&*|``.  Null counts as empty.
    """
    t = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    words = F.array_remove(F.split(t, f"{BLANKS}+"), "")

    def of_counts(c: Column) -> Column:
        return F.concat(
            F.when(c["n"] < 200, F.array(F.lit("A"))).otherwise(F.array().cast("array<string>")),
            F.when(100 * c["different"] < 50 * c["n"], F.array(F.lit("B")))
            .otherwise(F.array().cast("array<string>")),
        )

    counts = let(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n"), F.size(F.array_distinct(w)).cast("long").alias("different")
    ))
    capitals = F.length(F.regexp_replace(t, f"[^{UPPER[0]}-{UPPER[-1]}]+", "")).cast("long")
    none = F.array().cast("array<string>")
    return F.concat(
        let(counts, of_counts),
        F.when(100 * capitals > 2 * F.length(t).cast("long"), F.array(F.lit("C"))).otherwise(none),
        F.when(t.rlike(r"[#$%&*|]"), F.array(F.lit("D"))).otherwise(none),
    )


def later_copies(rows: DataFrame) -> DataFrame:
    """The rows whose text also stands under a smaller id, wherever in the table.

    A null id is not smaller than any other, nor larger.  Only texts held more than
    once are looked up, and a hot text meets many tasks.
    """
    first = rows.groupBy("text_1", "text_2").agg(
        F.count(F.lit(1)).alias("_n"), F.min("doc").alias("_first")
    ).filter("_n > 1")
    met = counted_lookup(rows, first, ["text_1", "text_2"], "_n", F.xxhash64(*ROW))
    return met.filter(F.col("doc") > F.col("_first")).select(*ROW, "doc")


def identified(docs: DataFrame, fails: Column, doc_id: str, text: str, part: str) -> DataFrame:
    """Different rows without their texts: ``doc``, ``part`` (null as empty text), 128-bit
    hashes of the text and of the row, ``fails``, the names of the conditions it fails, and
    ``n``, how often the row is held."""
    t = F.coalesce(F.col(text), F.lit(""))
    doc, where = F.col(doc_id), F.coalesce(F.col(part).cast("string"), F.lit(""))
    rows = docs.select(
        doc.alias("doc"), where.alias("part"), fails.alias("fails"),
        F.xxhash64(t).alias("text_1"), F.xxhash64(F.lit(1), t).alias("text_2"),
    )
    # A null leaves such a hash as it was, so it is told apart by a flag.
    named = [F.col("doc").isNull(), F.col("doc"), F.col("part"), "text_1", "text_2"]
    keyed = rows.withColumns(
        {ROW[0]: F.xxhash64(*named), ROW[1]: F.xxhash64(F.lit(1), *named)}
    )
    same = ("doc", "part", "text_1", "text_2", "fails")
    # All of them follow from the row's hashes; as keys they need no sort.
    return keyed.groupBy(*ROW, *same).agg(F.count(F.lit(1)).alias("n"))


def id_tables(rows: DataFrame, names: Sequence[str], more: dict[str, Callable]) -> dict[str, DataFrame]:
    """One stored table of failing ids (``row_1, row_2, doc``) for each filter."""
    made = {}
    for name in names:
        failing = more[name](rows) if name in more else rows.filter(
            F.array_contains("fails", name)
        ).select(*ROW, "doc")
        made[name] = materialise(failing)
    return made


def split_by_tables(rows: DataFrame, tables: Sequence[DataFrame]) -> DataFrame:
    """Rows with ``fails``, whose k-th bit tells whether the row is in the k-th table."""
    now = rows.withColumn("fails", F.lit(0))
    for k, ids in enumerate(tables):
        # Stored between the tables: both joins read one copy, and the plan stays flat.
        inside = now.join(ids, ROW, "left_semi").withColumn("fails", F.col("fails") + (1 << k))
        now = materialise(inside.unionByName(now.join(ids, ROW, "left_anti")))
    return now


def audit(
    docs: DataFrame, labels: DataFrame, names: Sequence[str] = "ABCDE",
    fails: Column | None = None, more: dict[str, Callable] | None = None,
    doc_id: str = "doc_id", text: str = "text", part: str = "source",
    good: Column | None = None, toxic: Column | None = None,
    orders: Sequence[str] | None = None,
) -> DataFrame:
    """One row per part, order of the filters and step: ``part, filter_order, step, kept,
    removed, redundant, unique_fails, good_lost, toxic_lost, shapley``.

    ``names`` are one-letter filters: ``fails`` gives the array of those a row fails by
    itself, and ``more`` maps each other one to a function from the identified rows to
    the failing ones.  ``orders`` defaults to all permutations; ``shapley`` sums a
    filter's removals over them.

    A null text is an empty one, a null part the empty part.  Rows count one by one,
    also when they repeat; ``labels`` may hold an id several times, and it has a label
    when any of its rows does.  A null id has no label.  No rows give no parts, and so
    no rows.  Other columns play no role.
    """
    fails = text_conditions(text) if fails is None else fails
    more = {"E": later_copies} if more is None else more
    good = F.col("quality") == 1 if good is None else good
    toxic = F.col("toxic") == 1 if toxic is None else toxic
    orders = ["".join(p) for p in permutations(names)] if orders is None else list(orders)

    rows = materialise(identified(docs, fails, doc_id, text, part))
    tables = id_tables(rows, names, more)
    known = labels.groupBy(F.col(doc_id).alias("doc")).agg(
        F.max(F.coalesce(good, F.lit(False)).cast("long")).alias("good"),
        F.max(F.coalesce(toxic, F.lit(False)).cast("long")).alias("toxic"),
    ).filter("doc is not null")
    labelled = salted_lookup(rows, known, ["doc"], F.xxhash64(*ROW)).select(
        *ROW, "part", "n",
        *((F.coalesce(c, F.lit(0)) * F.col("n")).alias(c) for c in ("good", "toxic")),
    )
    cells = split_by_tables(labelled, [tables[x] for x in names]).groupBy("part", "fails").agg(
        *(F.sum(c).alias(c) for c in ("n", "good", "toxic"))
    )
    return reported(cells, names, orders)


def reported(cells: DataFrame, names: Sequence[str], orders: Sequence[str]) -> DataFrame:
    """The report from the counts of rows that fail the same filters: ``cells`` has
    ``part, fails`` (bits), ``n, good, toxic``, so at most 2^filters rows for a part."""
    bit = {x: 1 << k for k, x in enumerate(names)}
    first = {x: [0] * (1 << len(names)) for x in names}
    for order in orders:  # in how many orders a filter comes before all others that fail
        for failing in range(1, 1 << len(names)):
            first[next(x for x in order if bit[x] & failing)][failing] += 1
    steps = [
        (order, k + 1, bit[x], sum(bit[y] for y in order[:k]), names.index(x))
        for order in orders for k, x in enumerate(order)
    ]
    columns = [F.lit(list(c)).alias(c_name) for c_name, c in zip(
        ("filter_order", "step", "own", "before", "of"), zip(*steps, strict=True), strict=True
    )]
    parts = cells.groupBy("part").agg(
        F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("cells")
    )
    each = parts.select("part", "cells", F.inline(F.arrays_zip(*columns)))
    own, before = F.col("own"), F.col("before")
    weights = F.element_at(F.lit([first[x] for x in names]), F.col("of") + 1)

    def total(what: str, condition) -> Column:
        zero = F.lit(0).cast("long")
        return F.aggregate(
            F.filter("cells", lambda c: condition(c["fails"])), zero, lambda a, c: a + c[what]
        )

    def has(f, bits):
        return f.bitwiseAND(bits) != 0

    def removed(f):
        return has(f, own) & ~has(f, before)

    return each.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"),
        total("n", lambda f: ~has(f, own) & ~has(f, before)).alias("kept"),
        total("n", removed).alias("removed"),
        total("n", lambda f: has(f, own) & has(f, before)).alias("redundant"),
        total("n", lambda f: f == own).alias("unique_fails"),
        total("good", removed).alias("good_lost"),
        total("toxic", removed).alias("toxic_lost"),
        F.aggregate(
            "cells", F.lit(0).cast("long"),
            lambda a, c: a + c["n"] * F.element_at(weights, c["fails"] + 1),
        ).alias("shapley"),
    )
