"""Serving: the gold tables as SQL views, queried with bound parameters (``spark.sql(text, args=...)``)."""

from pyspark.sql import DataFrame, SparkSession

from marketlake.plans.daily_run import tables
from marketlake.sources.dim_store import read_dim
from marketlake.sources.files import exists
from marketlake.sources.tables import read_days

VIEWS = {
    "dim_product": "Current products: one row per product and marketplace, without the change hash.",
    "fact_search_ranking": "One row per product, keyword, marketplace and day: the search card as shown.",
    "fact_price_snapshot": "One row per product, marketplace and day: price range, newest price, coupon.",
    "fact_product_performance": "One row per product, marketplace and day: ranks, rating shares, stock.",
    "mart_keyword_daily": "One row per keyword, marketplace and day: counts, shares and prices.",
    "mart_brand_competitive": "One row per brand, category, marketplace and day: ranks, stock, breadth.",
}


def register_views(spark: SparkSession, lake: str) -> list[str]:
    """Creates or replaces all views and returns their names; a table that was never built is an error."""
    missing = [name for name in VIEWS if not exists(spark, tables(lake)[name].path)]
    if missing:
        raise FileNotFoundError(f"not built yet: {', '.join(missing)}")
    for name in VIEWS:
        _view(spark, lake, name).createOrReplaceTempView(name)
    return list(VIEWS)


def list_views(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables() if t.name in VIEWS)


def current_products(dim: DataFrame) -> DataFrame:
    return dim.filter("is_current").drop("_attr_hash")


def _view(spark: SparkSession, lake: str, name: str) -> DataFrame:
    table = tables(lake)[name]
    if name == "dim_product":
        return current_products(read_dim(spark, table.path))
    return read_days(spark, table.path, table.schema)
