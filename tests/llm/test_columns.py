"""A table's own columns and ids come back from every operator and pipeline stage."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tickstone.llm import bpe, decontaminate, langid, lm, quality, simhash, substrings

SF = "/root/testdata/sf0.001"
ODD = ["_id", "_hash", "_text", "_doc", "_salt", "row", "at", "nth", "none"]
WORDS = " ".join(f"word{k}" for k in range(60))


@pytest.fixture(scope="module")
def docs(spark):
    """Documents with text ids and columns named as operators might name theirs."""
    rows = [
        ("a-1", "The quick brown fox jumps over the lazy dog again and again.", "en"),
        ("a-2", "The quick brown fox jumps over the lazy dog again and again.", "en"),
        ("b-1", f"{WORDS} and an end of its own", "en"), ("b-2", f"another start {WORDS}", "en"),
        ("c-1", None, None), ("c-2", "", "xx"), ("c-3", " \t\n ", None), (None, "no id here at all", "en"),
        ("d-1", "#$ 12", None), ("d-1", "one id for two texts", "en"), ("e-1", "z" * 300_000, "en"),
    ]
    df = spark.createDataFrame([(*r, "s", 7) for r in rows], "doc_id string, text string, lang string, source string, n_chars bigint")
    odd = {c: F.concat(F.lit(f"{c}:"), F.coalesce("doc_id", F.lit("-")), F.length("text").cast("string")) for c in ODD}
    odd["Score"] = F.lit("mine")
    return df.withColumns(odd).repartition(3)


def kept(df, but=()):
    """Rows of the odd columns and the id, in order."""
    names = [c for c in ("doc_id", *ODD, "Score", "source") if c not in but]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


def test_operators_that_add_columns(spark, docs):
    plain = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(plain, labels, F.lit(True))
    scored = quality.score(docs, model)
    assert kept(scored, ("Score",)) == kept(docs, ("Score",))
    assert scored.columns.count("score") == 1 and "Score" not in scored.columns
    models = langid.fit(docs, F.lit(True))
    assert kept(langid.predict(docs, models), ("Score",)) == kept(docs, ("Score",))
    assert langid.predict(docs, models, keep=[]).columns == ["lang_pred", "score", "rejected"]
    vocabulary = bpe.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    assert kept(bpe.encode_texts(docs, vocabulary)) == kept(docs)
    scorer, counts = lm.fit(docs, F.lit(True))
    assert kept(lm.score(docs, scorer, counts), ("Score",)) == kept(docs, ("Score",))
    left = substrings.remove_repeats(docs)
    assert kept(left) == kept(docs) and left.columns == [*docs.columns, "n_words", "n_removed"]
    assert {r["doc_id"] for r in left.filter("n_removed > 0").collect()} == {"b-1", "b-2"}


def test_operators_that_choose_rows(spark, docs):
    one = simhash.keep_one(docs)
    assert one.columns == docs.columns
    assert set(kept(one)) <= set(kept(docs))
    ids = [r["doc_id"] for r in one.collect()]
    assert ("a-1" in ids) != ("a-2" in ids) and "a-1" in ids
    found = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert found["a-2"] == "a-1" and found["c-3"] == "c-1"
    items = spark.createDataFrame([("i", WORDS)], "item_id string, text string")
    clean = decontaminate.without_leaks(docs, items)
    assert clean.columns == docs.columns and set(kept(clean)) <= set(kept(docs))
    assert not {"b-1", "b-2"} & {r["doc_id"] for r in clean.collect()}


def test_every_stage_of_the_pipeline(spark, docs):
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, now, SF)
        assert left.columns == now.columns, name
        assert set(kept(left)) <= set(kept(now)), name
        now = left
    last = corpus_pipeline.STAGES[-1][1](spark, now, SF)
    assert last.count() == now.count()
    for name, stage in corpus_pipeline.STAGES:
        if name != "near_duplicates":  # its empty table is tested beside it
            assert stage(spark, now.limit(0), SF).count() == 0, name
    ids = {r["doc_id"] for r in last.collect()}
    assert "a-1" in ids and "a-2" not in ids  # one of two copies
    assert not {"c-1", "c-2", "c-3"} & ids  # no language without a letter
    texts = {r["doc_id"]: r["text"] for r in now.collect()}
    assert texts["b-1"] == "and an end of its own" and texts["b-2"] == "another start"
