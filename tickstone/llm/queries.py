"""The operators applied to the shared tables, one query each."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    audit,
    bpe,
    decontaminate,
    langid,
    lines,
    lm,
    quality,
    sharding,
    simhash,
    substrings,
    topk,
    trie,
    urlfilter,
)
from .common import BLANKS, fold, table
from .oracle import OP3_SQL, OP4_SQL
from .oracle_sets import OP11_SQL, OP12_SQL, OP13_SQL
from .registry import QUERIES, SQL, query

__all__ = ["QUERIES", "SQL"]


@query()
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every text's token ids and of what they decode to."""
    vocabulary = bpe.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_digests(docs, vocabulary, keep=["doc_id"])


@query()
def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text, learned where crc32(doc_id) mod 5 is not 0."""
    docs = table(spark, sf_dir, "documents")
    models = langid.fit(docs, fold("doc_id", 5) != 0)
    named = docs.select("doc_id", "text", (fold("doc_id", 5) == 0).alias("held_out"))
    return langid.predict(named, models, keep=["doc_id", "held_out"])


@query()
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query(OP4_SQL)
def op4_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, fitting rule and verdict of every page."""
    found = urlfilter.filter_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))
    return found.drop("bound")


@query()
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sixteen shards of nearly equal bytes, equal texts together."""
    return sharding.shard(table(spark, sf_dir, "documents"))


@query(OP3_SQL)
def op3_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text counts of every document, and whether the lines of its host leave it enough."""
    return lines.judge(table(spark, sf_dir, "documents")).drop("n_removed")


@query()
def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of every document repeats elsewhere, and a digest of what is left."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    left = substrings.remove_repeats(docs)
    words = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), f"{BLANKS}+", " "))
    return left.select("doc_id", "n_words", "n_removed", F.sha2(words, 256).alias("kept_sha256"))


@query()
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a document and a benchmark item that leaked into it."""
    return decontaminate.find_leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


@query()
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every text, learned where crc32(doc_id) mod 3 is not 1."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)
    named = docs.select("doc_id", "text", (fold("doc_id", 3) == 1).alias("held_out"))
    return quality.score(named, model, keep=["doc_id", "held_out"])


@query()
def op5_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and log-bilinear scores of every text, learned where crc32(doc_id) mod 7
    is not 2."""
    docs = table(spark, sf_dir, "documents")
    model, counts = lm.fit(docs, fold("doc_id", 7) != 2)
    named = docs.select("doc_id", "text", (fold("doc_id", 7) == 2).alias("held_out"))
    return lm.score(named, model, counts, keep=["doc_id", "held_out"])


@query(OP11_SQL)
def op11_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in each of their orders, for every source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return audit.audit(docs, table(spark, sf_dir, "labels"))


@query(OP12_SQL)
def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every vector whose id is divisible by 50."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query(OP13_SQL)
def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))
