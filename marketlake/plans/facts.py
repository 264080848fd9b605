"""The three facts. Each is a plain function of the typed rows and the product dimension.

The declared schema of a fact picks and orders its columns; the surrogate key is looked up last.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.functions.keys import sha_key
from marketlake.functions.numbers import settled
from marketlake.operators.lookup import resolve_sk
from marketlake.operators.scd2 import alone, starts_version
from marketlake.plans.dimension import KEYS, TRACKED

PRICE_KEYS = ["asin", "marketplace", "ingested_at"]

# Business names of card columns.
RANKING_NAMES = {"rating": "rating_value", "monthly_sales": "monthly_sales_min", "coupon": "coupon_discount_pct"}


def search_ranking(search: DataFrame) -> DataFrame:
    """Search cards under their business names, before the product key is looked up."""
    return search.withColumnsRenamed(RANKING_NAMES).select(*_measures(schemas.FACT_SEARCH_RANKING))


def price_snapshot(search: DataFrame, unique_grain: bool = False) -> DataFrame:
    """Prices of a product's cards on one day: range, average and the newest one, in a single aggregation.

    The newest values ride along as ``max_by`` instead of a second scan joined back, and everything combines
    before the shuffle, so a product shown under very many keywords is no hot group. ``unique_grain`` says that
    a keyword occurs once per product, marketplace and day, as in the typed tables: counting keywords then needs
    no distinct and no second shuffle. Rows without a key drop out.
    """
    price = F.col("price_amount")
    keywords = F.count("keyword") if unique_grain else F.count_distinct("keyword")
    latest = F.struct(
        price.alias("latest_price"),
        F.col("original_price_amount").alias("original_price_latest"),
        F.col("discount_pct").alias("discount_pct_latest"),
        F.col("coupon").alias("coupon_discount_pct_latest"),
    )
    # A row without a time must lose, whatever its other values: it is the smallest, as NULL sorts first here.
    order = F.struct("source_extracted_at", "keyword", latest)
    figures = {
        "min_price": F.round(F.min(price), 2),
        "max_price": F.round(F.max(price), 2),
        "avg_price": settled(F.avg(price), 2),
        "latest": F.max_by(latest, order),
        "has_coupon": F.bool_or("has_coupon"),
        "keyword_appearance_count": keywords.cast("int"),
    }
    snapshot = search.dropna(subset=PRICE_KEYS).groupBy(*PRICE_KEYS).agg(*[c.alias(n) for n, c in figures.items()])
    return snapshot.select("*", "latest.*").select(*_measures(schemas.FACT_PRICE_SNAPSHOT))


def product_performance(details: DataFrame) -> DataFrame:
    """Product pages with their first two best-seller ranks side by side, before the key is looked up."""
    return details.withColumns(_places()).select(*_measures(schemas.FACT_PRODUCT_PERFORMANCE))


def fact_search_ranking(search: DataFrame, dim: DataFrame, mode: str = "current") -> DataFrame:
    """One row per product, keyword, marketplace and day."""
    return _keyed(search_ranking(search), dim, mode)


def fact_price_snapshot(
    search: DataFrame, dim: DataFrame, mode: str = "current", unique_grain: bool = False
) -> DataFrame:
    """One row per product, marketplace and day."""
    return _keyed(price_snapshot(search, unique_grain), dim, mode, unique_days=True)


def fact_product_performance(details: DataFrame, dim: DataFrame, mode: str = "current") -> DataFrame:
    """One row per product, marketplace and day."""
    return _keyed(product_performance(details), dim, mode, unique_days=True)


def performance_with_versions(details: DataFrame) -> DataFrame:
    """The fact over a whole history, with the brand and leaf category of each row's version beside it.

    Equal to ``fact_product_performance(details, dim_history(details), "asof")`` joined to that dimension, for
    pages unique per product and day: one window per product finds where versions start and carries the start
    forward, so keys, versions and fact come from one shuffle. Brand and leaf category are tracked, so within a
    version each page has the version's own.
    """
    by_day = Window.partitionBy(*KEYS, "_alone").orderBy("ingested_at")
    starts = F.when(starts_version(TRACKED, by_day), F.col("ingested_at"))
    paged = details.withColumn("_alone", alone(KEYS)).withColumn("_starts", starts)
    newest = F.last("_starts", ignorenulls=True).over(by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    paged = paged.withColumn("effective_date", newest)
    known = F.col(KEYS[0]).isNotNull() & F.col(KEYS[1]).isNotNull()
    places = _places() | {"product_sk": F.when(known, sha_key(*KEYS, "effective_date"))}
    measures = [c for c in schemas.column_names(schemas.FACT_PRODUCT_PERFORMANCE) if c != "gold_processed_at"]
    return paged.withColumns(places).select(*measures, "brand", "category_leaf").withColumn("gold_processed_at", F.current_timestamp())


def _places() -> dict[str, Column]:
    return {
        f"bsr_{name}_{part}": F.get("best_seller_ranks", F.lit(position))[part]
        for position, name in enumerate(("primary", "secondary"))
        for part in ("rank", "category")
    }


def _measures(schema: str) -> list[str]:
    """A fact's columns but for its surrogate key and audit stamp."""
    return [c for c in schemas.column_names(schema) if c not in ("product_sk", "gold_processed_at")]


def _keyed(rows: DataFrame, dim: DataFrame, mode: str, unique_days: bool = False) -> DataFrame:
    return resolve_sk(rows, dim, KEYS, mode, unique_days=unique_days).withColumn("gold_processed_at", F.current_timestamp())
