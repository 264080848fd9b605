"""Distinct products of a keyword over any range of days, from one state per keyword and day.

``record_products`` runs after the facts of its days are published, and may be run again. Products are numbered in
``<root>/product_numbers``, which only grows; one run at a time may write it.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.operators.distinct_states import distinct_states, merged_counts, numbered, with_places
from marketlake.sources.files import child_names, scratch_dir
from marketlake.sources.tables import publish_days, read_days

GROUP = ["keyword", "marketplace"]
NUMBERS = "asin string, number bigint"
STATES = "keyword string, marketplace string, bucket bigint, products binary, ingested_at date"


def product_numbers(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root}/product_numbers"
    return spark.read.schema(NUMBERS).parquet(path) if child_names(spark, path) else spark.createDataFrame([], NUMBERS)


def record_products(spark: SparkSession, fact: DataFrame, root: str, start: str, end: str) -> int:
    """Replaces the states of the days ``start``..``end`` by those of the fact's rows of these days; returns rows written."""
    days = F.col("ingested_at").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    rows = fact.filter(days).select(*GROUP, "asin", "ingested_at").dropna(subset=["asin"])
    known = product_numbers(spark, root)
    new = rows.select("asin").distinct().join(known, "asin", "left_anti")
    path = scratch_dir(spark, "new-products")
    with_places(new).write.parquet(path)
    placed = spark.read.schema("asin string, place bigint").parquet(path)
    if not placed.isEmpty():
        highest = known.agg(F.max("number")).first()[0]
        numbers = numbered(placed, 0 if highest is None else highest + 1)
        numbers.select(*schemas.column_names(NUMBERS)).write.mode("append").parquet(f"{root}/product_numbers")
    found = rows.join(product_numbers(spark, root), "asin")
    states = distinct_states(found, [*GROUP, "ingested_at"], "number", "products")
    covered = [str(r[0]) for r in rows.select("ingested_at").distinct().collect()]
    return publish_days(states, f"{root}/keyword_products", STATES, start, end, start < end, covered)


def keyword_products(spark: SparkSession, root: str, start: str, end: str) -> DataFrame:
    """Distinct products of each keyword and marketplace on the days ``start``..``end``; the facts are not read."""
    return merged_counts(read_days(spark, f"{root}/keyword_products", STATES, start, end), GROUP, "products", "total_products")
