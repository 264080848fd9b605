"""Samples of tables whose ids and texts repeat, and a pipeline that keeps its documents."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marketlake.llm import language_id, quality_model
from marketlake.llm.samples import sampled


@pytest.mark.parametrize("seed", range(6))
def test_few_ids_of_many_rows(spark, seed):
    """40 ids of 1,000 rows, one id with a third of all rows, null ids: never empty, never above the bound, no text twice."""
    rows = spark.range(60_000).selectExpr(
        "case when id < 40000 then id % 40 when id < 59000 then 7 end as doc_id", "cast(id % 5000 as string) as text", "if(id % 3 = 0, 'a', 'b') as lang"
    )
    for per_group in (1, 100, 1000):
        got = sampled(rows, "lang", per_group, seed, ["doc_id", "text"]).collect()
        for lang in "ab":
            own = [(r["doc_id"], r["text"]) for r in got if r["lang"] == lang]
            assert len(own) == len(set(own)) == per_group


def test_copies_and_small_groups(spark):
    rows = spark.range(30_000).selectExpr("1L as doc_id", "if(id < 29990, 'same', concat('t', id)) as text", "'x' as lang")
    rows = rows.union(spark.sql("select null, null, 'y'")).union(spark.sql("select 2L, '', 'z'"))
    got = {(r["lang"], r["text"]) for r in sampled(rows, "lang", 100, 3, ["doc_id", "text"]).collect()}
    assert got == {("x", "same"), ("y", None), ("z", ""), *[("x", f"t{k}") for k in range(29_990, 30_000)]}


def test_models_learn_from_few_ids(spark):
    """Languages and labels of documents that repeat thousands of times under few ids."""
    words = {"en": "the weather of this house was good and the people were glad", "de": "das wetter an diesem haus war gut und die leute waren froh"}
    rows = [(k % 4, f"{words[lang]} {k % 3}", lang) for k in range(3000) for lang in words]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = language_id.identify(docs, language_id.train(docs), ["doc_id", "lang"])
    assert got.where("lang = lang_pred and not rejected").count() == len(rows)
    texts = spark.createDataFrame([(k % 2, "good fine text" if k % 2 else "spam spam") for k in range(4000)], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 0), (1, 1)], "doc_id long, quality int")
    scored = quality_model.score(texts, quality_model.train(texts, labels), ["doc_id"])
    assert scored.where("(score > 0.5) <> (doc_id = 1)").count() == 0


@pytest.mark.parametrize("lang", ["en", None])
def test_the_first_stage_keeps_documents_that_repeat(spark, lang):
    """A dozen ordinary documents, copied very often under few ids, with and without a known language."""
    text = "This is an ordinary English text about the weather in town number {}, and it goes on for a while without any trouble."
    docs = spark.range(24_000).select(
        (F.col("id") % 12).alias("doc_id"), F.format_string(text.replace("{}", "%d"), F.col("id") % 12).alias("text"),
        F.lit(lang).cast("string").alias("lang"), F.lit("web").alias("source"), F.lit(1).cast("long").alias("n_chars"),
    )
    assert corpus_pipeline.known_language(spark, docs, "").count() == 24_000
