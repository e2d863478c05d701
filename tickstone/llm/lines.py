"""Quality rules: basic text counts, and lines that many documents of a host share.

Lines are normalised (A-Z lowered, white space collapsed, digits made 0) and hashed.
A line is boilerplate of its host when the number of distinct documents that hold it
reaches both limits, an absolute one and a share of the host's distinct documents.  A
document is an id: copies under different ids count each, rows without an id not at all.
Removing the boilerplate may deplete a document, which is then rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scratch import materialise
from .common import BLANKS, let, lower_ascii, salted_lookup

#: Distinct documents of a host that share a line before it counts as boilerplate.
MIN_DOCS = 20
#: And the share of the host's documents.
MIN_SHARE = 0.001
#: A document is depleted when less than this share of its words is left ...
KEPT_SHARE = 0.5
#: ... or fewer words than this.
KEPT_WORDS = 10
WINDOW = 5
SYMBOLS = "#*$%&|<>"


def words_of(text: Column) -> Column:
    """The words of a non-null text."""
    return F.filter(F.split(text, f"{BLANKS}+"), lambda w: w != "")


def _covered(places: Column) -> Column:
    """Words covered by windows that start at these places, given in order."""
    return F.coalesce(F.aggregate(
        places, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).cast("int").alias("end")),
        lambda a, p: F.struct(
            (a["n"] + (p + WINDOW) - F.greatest(p, a["end"])).alias("n"), (p + WINDOW).alias("end")
        ),
        lambda a: a["n"],
    ), F.lit(0).cast("long"))


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of five words found twice or more in the text.

    Windows are compared by 64-bit hash.  Only a text that has a repeat sorts them.
    """

    def of_hashes(h: Column) -> Column:
        def window(i):
            return F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)])

        at = F.sequence(F.lit(0), F.size(h) - WINDOW)

        def of_windows(w: Column) -> Column:
            def of_sorted(s: Column) -> Column:
                def again(x, i):
                    same_before = F.get(s, i - 1)["h"] == x["h"]
                    same_after = F.get(s, i + 1)["h"] == x["h"]
                    return F.coalesce(same_before, F.lit(False)) | F.coalesce(same_after, F.lit(False))

                return _covered(F.array_sort(F.transform(F.filter(s, again), lambda x: x["i"])))

            placed = F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
            return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(
                let(F.array_sort(placed), of_sorted)
            )

        return F.when(F.size(h) < WINDOW, F.lit(0).cast("long")).otherwise(
            let(F.transform(at, window), of_windows)
        )

    return let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)


def base_counts(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source"
) -> DataFrame:
    """``doc_id, text_hash, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``."""
    t = F.coalesce(F.col(text), F.lit(""))
    with_word = F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{BLANKS[1:-1]}]"))

    def counts(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"), repeated_words(words).alias("n_repeat_words")
        )

    return docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"),
        F.col(host).alias("host"), let(words_of(t), counts).alias("c"),
        F.length(F.regexp_replace(t, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(with_word, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    ).select("doc_id", "text_hash", "host", "c.*", "word_chars", "n_symbols", "n_dup_lines")


def normalised(line: Column) -> Column:
    """A line as it is compared."""
    plain = F.trim(F.regexp_replace(lower_ascii(line), f"{BLANKS}+", " "))
    return F.translate(plain, "123456789", "000000000")


def line_rows(docs: DataFrame, doc_id: str, text: str, host: str) -> DataFrame:
    """One row per document and line with a word:
    ``doc_id, text_hash, host, place, line, words``."""
    lines = F.filter(F.split(F.col(text), "\n"), lambda x: x.rlike(f"[^{BLANKS[1:-1]}]"))

    def one(x):
        return let(normalised(x), lambda n: F.struct(
            F.xxhash64(n).alias("line"),
            (F.length(n) - F.length(F.translate(n, " ", "")) + 1).cast("long").alias("words"),
        ))

    return docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"),
        F.col(host).alias("host"), F.posexplode(F.transform(lines, one)).alias("place", "l"),
    ).select("doc_id", "text_hash", "host", "place", "l.line", "l.words")


def frequent_lines(
    lines: DataFrame, docs: DataFrame, host: str, doc_id: str,
    min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE,
) -> DataFrame:
    """``host, line`` of every line above both limits."""
    # Two steps: repeats of a line in one document are reduced first, so that a line in a
    # third of all documents is counted from partial sums and not from its rows.
    each = lines.filter("doc_id is not null").select("host", "line", "doc_id").distinct()
    counted = each.groupBy("host", "line").agg(F.count(F.lit(1)).alias("docs")).filter(
        F.col("docs") >= min_docs
    )
    held = docs.filter(F.col(doc_id).isNotNull()).select(F.col(host).alias("_host"), doc_id).distinct()
    sizes = held.groupBy("_host").agg(F.count(F.lit(1)).alias("of"))
    return counted.join(sizes, F.col("host").eqNullSafe(F.col("_host"))).filter(
        F.col("docs") >= F.lit(min_share) * F.col("of")
    ).select("host", "line")


def judge(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
    min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE,
) -> DataFrame:
    """One row per row: the base counts, ``base_failed``, ``n_removed``, ``kept``.

    ``base_failed``: fewer than 10 words, or more than 20 of 100 words repeat within
    the text.  ``n_removed``: words on boilerplate lines.  A null text has no words
    and fails; null hosts form one host; repeated rows are judged alike.  Rows without an
    id count for no line, and lose the lines that are boilerplate of their host.
    """
    base = base_counts(docs, doc_id, text, host)
    lines = materialise(line_rows(docs, doc_id, text, host))  # both branches below read them
    frequent = frequent_lines(lines, docs, host, doc_id, min_docs, min_share).withColumn("hit", F.lit(True))
    # By the row: copies of a text, and of an id read by several tasks, are dealt out too.
    salt = F.xxhash64("doc_id", "place", F.spark_partition_id())
    hits = salted_lookup(lines, frequent, ["host", "line"], salt, 32).filter("hit")
    # Repeated rows show each of their lines several times; one counts.
    removed = hits.select("doc_id", "text_hash", "host", "place", "words").distinct().groupBy(
        F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t"), F.col("host").alias("_h")
    ).agg(F.sum("words").alias("n_removed"))
    same = (
        F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("text_hash").eqNullSafe(F.col("_t"))
        & F.col("host").eqNullSafe(F.col("_h"))
    )
    n, gone = F.col("n_words"), F.coalesce("n_removed", F.lit(0))
    failed = (n < 10) | (100 * F.col("n_repeat_words") > 20 * n)
    depleted = (n - gone < KEPT_WORDS) | (n - gone < F.lit(KEPT_SHARE) * n)
    return base.join(removed, same, "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), gone.alias("n_removed"), (~failed & ~depleted).alias("kept"),
    )
