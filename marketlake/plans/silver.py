"""Typed tables: the latest card per (product, keyword, day) and the latest page per (product, day).

Each names only the columns it derives; the declared schema of the table picks and orders all of them.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.functions import card_text as card
from marketlake.functions import page_text as page
from marketlake.operators.dedup import dedup_latest, newest_first

# The marketplace is part of the key: the same product may be sold in two marketplaces on one day.
SEARCH_KEYS = ["asin", "keyword", "marketplace", "ingested_at"]
DETAILS_KEYS = ["asin", "marketplace", "ingested_at"]

# Pages are dealt by product, as their history is.
PAGES_DEALT_BY = ["asin", "marketplace"]

# Large page fields that no later table holds.
RAW_ONLY = ["description", "variations"]


def clean_search(bronze: DataFrame, keys: list[str] = SEARCH_KEYS) -> DataFrame:
    """Search cards, typed. Duplicates go first, so only the kept rows are parsed."""
    price = card.price_columns(F.col("price"))
    original = card.price_columns(F.col("original_price"))["amount"]
    derived = {
        "title": F.trim("title"),
        **{f"price_{part}": column for part, column in price.items()},
        "original_price_amount": original,
        "discount_pct": card.discount_pct(original, price["amount"]),
        "rating": card.leading_number(F.col("rating")),
        "ratings_count": card.magnitude_number(F.col("ratings_count"), parens=True),
        "monthly_sales": card.magnitude_number(F.col("monthly_sales"), parens=False),
        **card.coupon_columns(F.col("coupon")),
    }
    return _typed(_latest_rows(bronze, keys), derived, schemas.SILVER_SEARCH)


def clean_products(bronze: DataFrame, keys: list[str] = DETAILS_KEYS) -> DataFrame:
    """Product pages, typed."""
    derived = {
        "title": F.trim("title"),
        "brand": page.brand_name(F.col("brand")),
        "category_path": F.col("category"),
        "best_seller_ranks": page.seller_ranks(F.col("best_seller_rank")),
        "dimensions_raw": F.col("dimensions"),
        **page.dimension_columns(F.col("dimensions")),
        **page.weight_columns(F.col("weight")),
        "date_first_available": page.listing_date(F.col("date_first_available")),
        "main_image_url": F.get("images", F.lit(0)),
        "all_image_urls": F.col("images"),
        "image_count": F.array_size("images"),
        **page.rating_columns(F.col("rating_overview")),
        "in_stock": page.is_in_stock(F.col("stock_status")),
    }
    return _typed(_latest_rows(_without_lists(bronze), keys, PAGES_DEALT_BY), derived, schemas.SILVER_DETAILS)


def _without_lists(bronze: DataFrame) -> DataFrame:
    """Product pages with counts and the last name in the place of nested lists, which no later table holds: they would
    be a good part of what the shuffle carries. Texts are parsed after it, in the kept rows only."""
    options = F.col("available_dimensions")
    small = {
        "category_depth": F.array_size("categories"),
        "category_leaf": page.last_name(F.col("categories")),
        "size_count": F.array_size(options["size_name"]),
        "color_count": F.array_size(options["color_name"]),
    }
    return bronze.withColumns(small).drop(*RAW_ONLY, "categories", "available_dimensions")


def _latest_rows(bronze: DataFrame, keys: list[str], dealt_by: list[str] | None = None) -> DataFrame:
    dated = bronze.withColumns(
        {
            "source_extracted_at": F.try_to_timestamp("source_extracted_at"),
            "ingested_at": F.col("ingested_at").try_cast("date"),
        }
    )
    # a product's file and place in it are unique, so that no other column takes part in the sort and its shuffle
    newest = newest_first("source_extracted_at", ["source_file", "source_position"])
    return dedup_latest(dated, keys, newest, dealt_by)


def _typed(latest: DataFrame, derived: dict, schema: str) -> DataFrame:
    return latest.withColumns(derived | {"silver_processed_at": F.current_timestamp()}).select(
        *schemas.column_names(schema)
    )
