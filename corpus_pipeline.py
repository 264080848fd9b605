"""From raw documents to packed training sequences, one written table a stage.

Cases, of every stage: a null in any column is carried; an empty table gives an empty table; texts are read whole; columns
beyond those of `documents` are dropped, whatever their names. Rows that repeat are judged row by row but where a stage says
otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import language_id, secrets
from marketlake.llm.decontaminate import drop_contaminated
from marketlake.llm.jaccard_join import one_of_each
from marketlake.llm.packing import pack_documents
from marketlake.llm.queries import tokenizer
from marketlake.llm.scratch import documents, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model, learned from the labelled ones, does not reject.

    A null text, or one without letters, is rejected. Without any labelled document nothing is.
    """
    return language_id.identify(docs, language_id.train(docs), COLUMNS).where("not rejected").select(*COLUMNS)


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: of the rows that repeat too.

    It is the one of the smallest doc_id. Documents without words are near duplicates of nothing and stay.
    """
    return one_of_each(docs.select(*COLUMNS))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item; those without words stay."""
    return drop_contaminated(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def masked_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their texts and the length put right; other rows keep their n_chars."""
    found = secrets.scan(docs, secrets.train(docs), COLUMNS, mask=True)
    masked = F.coalesce("masked", "text")
    length = F.when(F.col("masked").isNotNull(), F.length("masked").cast("long")).otherwise(F.col("n_chars"))
    return found.select("doc_id", masked.alias("text"), "lang", "source", length.alias("n_chars"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences; a null text is the end id alone."""
    return pack_documents(docs, *tokenizer())


STAGES = [
    ("language_id", known_language),
    ("jaccard_join", one_of_similar),
    ("decontamination", without_benchmark),
    ("secret_scan", masked_secrets),
    ("packing", packed),
]
#: Models, tokenizers and the packing plan have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
