"""The product dimension, built from typed product pages."""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.functions.keys import sha_key
from marketlake.operators.scd2 import as_new_versions, as_open_versions, day_literal, scd2_history, scd2_merge

KEYS = ["asin", "marketplace"]

# A change in one of these starts a new version; the others are noise of the scraped pages.
TRACKED = ["title", "brand", "category_path", "category_leaf", "category_depth", "is_fba", "variation_count"]

# Columns made of a version's other columns.
HASHED = ["product_sk", "_attr_hash"]


def dim_incoming(details: DataFrame, day: str | date | None = None) -> DataFrame:
    """Each product page as a new open version starting on ``day``, or on the page's own day."""
    start = F.col("ingested_at") if day is None else day_literal(day)
    return _with_sk(as_new_versions(_pages(details), TRACKED, start))


def dim_history(details: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """All days of product pages folded into versions, on top of the versions current before the first day.

    Hashes and surrogate keys are made of the versions that remain, after the shuffle.
    """
    plain = [c for c in schemas.column_names(schemas.DIM_PRODUCT) if c not in HASHED]
    versions = as_open_versions(_pages(details), F.col("ingested_at")).select(*plain)
    if current is not None:
        versions = current.select(*plain).unionByName(versions)
    return _with_sk(scd2_history(versions, KEYS, TRACKED))


def _pages(details: DataFrame) -> DataFrame:
    category = F.get("best_seller_ranks", F.lit(0))["category"]
    return details.withColumns({"bsr_primary_category": category, "gold_processed_at": F.current_timestamp()})


def _with_sk(versions: DataFrame) -> DataFrame:
    return versions.withColumn("product_sk", sha_key(*KEYS, "effective_date")).select(*schemas.column_names(schemas.DIM_PRODUCT))


def dim_update(dim: DataFrame, details: DataFrame, start: str, end: str) -> DataFrame:
    """What the days ``start``..``end`` make of the current versions: newly closed and current ones."""
    current = dim.filter("is_current")
    if start == end:
        return scd2_merge(current, dim_incoming(details, end), end, KEYS)
    return dim_history(details, current)
