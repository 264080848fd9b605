"""The operators' queries over the driver's tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import language_id, quality_model, secrets
from marketlake.llm.decontaminate import contamination
from marketlake.llm.jaccard_join import similar_documents
from marketlake.llm.lexical_search import search
from marketlake.llm.license_scan import license_labels
from marketlake.llm.lm_score import score_texts
from marketlake.llm.packing import pack_documents
from marketlake.llm.prefix_trie import prefix_trie
from marketlake.llm.quality_rules import clean_lines
from marketlake.llm.scratch import documents, id_remainder
from marketlake.llm.sharding import shard_rows
from marketlake.llm.tool_calls import CONVERSATION_SCHEMAS, conversation_calls, link_calls, schema_table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = secrets.scan(docs, secrets.train(docs), ["doc_id"])
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_crf")


def tokenizer() -> tuple[str, str]:
    """The vocabulary file and the pattern that cuts a text for it."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), *tokenizer())


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(documents(spark, sf_dir), shards=24)


def op4_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = conversation_calls(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return link_calls(calls, results, schema_table(spark, CONVERSATION_SCHEMAS))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = id_remainder(4) == 2
    model = quality_model.train(docs.where(~held_out), labels.where(~held_out))
    return quality_model.score(docs, model, ["doc_id"]).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(documents(spark, sf_dir))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = documents(spark, sf_dir), id_remainder(5) == 0
    model = language_id.train(docs.where(~held_out))
    return language_id.identify(docs, model, ["doc_id"]).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("text_key")


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = id_remainder(10) == 0
    scored = score_texts(documents(spark, sf_dir).select("doc_id", (~held_out).alias("learned"), "text"))
    return scored.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return clean_lines(documents(spark, sf_dir)).select(*asked, "n_lines", "kept_lines", "kept_chars")


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_labels(documents(spark, sf_dir))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), "item_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
