"""The training-text pipeline: five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept;
all but the last return the columns of ``documents``.  ``run`` writes what each stage
returns as Parquet in the shared folder and reads it again as the next one's input, so
that a lost executor never costs more than the stage at work.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickstone.functions.scratch import materialise
from tickstone.llm import bpe, decontaminate, langid, simhash, substrings
from tickstone.llm.common import fold, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that language identification rejects.

    Null, empty and letterless texts are rejected.  Rows are judged one by one, so repeats
    and ties stay or go together; other columns, whatever their names, come back unchanged.
    """
    models = langid.fit(docs, fold("doc_id", 5) != 0)
    others = [c for c in docs.columns if c != "text"]
    judged = docs.select(F.struct(*others).alias("other"), "text")  # their names meet no made one
    kept = langid.predict(judged, models).filter(~F.col("rejected"))
    return kept.select(*("text" if c == "text" else F.col("other")[c].alias(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies, that of the smallest id.

    Texts without words form one group.  Rows without an id come after all that have one;
    of rows that share an id the first by the hash of its text stays, a null text last.
    Near copies are what lies within two bits; that is no word similarity, and near copies
    that differ more are left.
    """
    return simhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take passages that occur more than once out of the texts.

    All rows stay, those without words too; a text may be left empty.  Rows that repeat are
    copies of each other and lose all windows.  ``n_chars`` follows where a text changes.
    """
    left = substrings.remove_repeats(docs)
    changed = F.col("n_removed") > 0
    return left.withColumn(
        "n_chars", F.when(changed, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    ).select(*docs.columns)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold benchmark items.

    Null and empty texts hold none and stay; each row is judged by itself.
    """
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digest of what they decode to.

    One row per row.  A null or empty text has no tokens and decodes to empty text.
    """
    vocabulary = bpe.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    coded = bpe.encode_texts(docs, vocabulary, keep=["doc_id", "lang", "source"])
    return coded.select(
        "doc_id", "lang", "source", "token_ids", F.size("token_ids").cast("bigint").alias("n_tokens"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("tokens", tokens),
]

#: Language models and fingerprints are beyond SQL; tests walk through the stages on rows
#: whose outcome is known (``tests/llm/test_columns.py``).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
