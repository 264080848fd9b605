"""Declared schemas of every table, as Spark DDL.

Reads never infer: inference costs a second pass over files that cannot be split and drifts from day to day.
"""

from pyspark.sql.types import StructType

_SEARCH_RECORD = """
    asin string, title string, price string, original_price string, rating string, ratings_count string,
    monthly_sales string, is_sponsored boolean, is_prime boolean, is_best_seller boolean,
    is_amazons_choice boolean, coupon string, delivery string, url string, image_url string
"""

_DETAILS_RECORD = """
    asin string, title string, brand string, category string, description string,
    best_seller_rank array<string>, dimensions string, weight string, date_first_available string,
    parent_asin string, variation_count int,
    available_dimensions struct<size_name: array<string>, color_name: array<string>>,
    variations array<struct<asin: string, combination_key: string>>,
    images array<string>,
    rating_overview struct<`5`: int, `4`: int, `3`: int, `2`: int, `1`: int>,
    stock_status string, buybox_seller string, is_fba boolean,
    categories array<struct<name: string, url: string, level: int>>
"""

SEARCH_ENVELOPE = f"""
    metadata struct<keyword: string, marketplace: string, extracted_at: string>,
    products array<struct<{_SEARCH_RECORD}>>,
    _corrupt_record string
"""

DETAILS_ENVELOPE = f"""
    metadata struct<type: string, marketplace: string, total_products: int, extracted_at: string>,
    products array<struct<{_DETAILS_RECORD}>>,
    _corrupt_record string
"""

BRONZE_SEARCH = f"""
    {_SEARCH_RECORD}, keyword string, marketplace string, source_extracted_at string,
    source_file string, source_position int, ingested_at string
"""

BRONZE_DETAILS = f"""
    {_DETAILS_RECORD}, marketplace string, source_extracted_at string, source_file string, source_position int,
    ingested_at string
"""

QUARANTINE = "source_file string, reason string, raw string, ingested_at string"

SILVER_SEARCH = """
    asin string, title string, price_raw string, price_currency string, price_amount double,
    original_price_amount double, discount_pct double, rating double, ratings_count bigint,
    monthly_sales bigint, is_sponsored boolean, is_prime boolean, is_best_seller boolean,
    is_amazons_choice boolean, has_coupon boolean, coupon double, delivery string, url string,
    image_url string, keyword string, marketplace string, source_extracted_at timestamp,
    ingested_at date, silver_processed_at timestamp
"""

SILVER_DETAILS = """
    asin string, parent_asin string, title string, brand string, category_path string, category_depth int,
    category_leaf string, best_seller_ranks array<struct<rank: int, category: string>>,
    dimensions_raw string, dimension_length double, dimension_width double, dimension_height double,
    dimension_unit string, weight_value double, weight_unit string, date_first_available date,
    variation_count int, size_count int, color_count int, main_image_url string,
    all_image_urls array<string>, image_count int, rating_pct_5 double, rating_pct_4 double,
    rating_pct_3 double, rating_pct_2 double, rating_pct_1 double, rating_weighted_avg double,
    in_stock boolean, buybox_seller string, is_fba boolean, marketplace string,
    source_extracted_at timestamp, ingested_at date, silver_processed_at timestamp
"""

DIM_PRODUCT = """
    product_sk string, asin string, marketplace string, title string, brand string, category_path string,
    category_leaf string, category_depth int, bsr_primary_category string, date_first_available date,
    variation_count int, size_count int, color_count int, main_image_url string, is_fba boolean,
    effective_date date, expiry_date date, is_current boolean, _attr_hash string,
    gold_processed_at timestamp
"""

FACT_SEARCH_RANKING = """
    product_sk string, asin string, keyword string, marketplace string, ingested_at date,
    price_amount double, original_price_amount double, discount_pct double, rating_value double,
    ratings_count bigint, monthly_sales_min bigint, is_sponsored boolean, is_prime boolean,
    is_best_seller boolean, is_amazons_choice boolean, has_coupon boolean, coupon_discount_pct double,
    source_extracted_at timestamp, gold_processed_at timestamp
"""

FACT_PRICE_SNAPSHOT = """
    product_sk string, asin string, marketplace string, ingested_at date, min_price double,
    max_price double, avg_price double, latest_price double, original_price_latest double,
    discount_pct_latest double, has_coupon boolean, coupon_discount_pct_latest double,
    keyword_appearance_count int, gold_processed_at timestamp
"""

FACT_PRODUCT_PERFORMANCE = """
    product_sk string, asin string, marketplace string, ingested_at date, bsr_primary_rank int,
    bsr_primary_category string, bsr_secondary_rank int, bsr_secondary_category string,
    rating_weighted_avg double, rating_pct_5 double, rating_pct_4 double, rating_pct_3 double,
    rating_pct_2 double, rating_pct_1 double, in_stock boolean, buybox_seller string, is_fba boolean,
    variation_count int, size_count int, color_count int, image_count int, gold_processed_at timestamp
"""

MART_KEYWORD_DAILY = """
    keyword string, marketplace string, ingested_at date, total_products bigint, sponsored_count bigint,
    prime_count bigint, best_seller_count bigint, amazons_choice_count bigint, coupon_count bigint,
    avg_price double, median_price double, min_price double, max_price double, avg_rating_value double,
    avg_ratings_count bigint, total_monthly_sales_min bigint, sponsored_pct double,
    gold_processed_at timestamp
"""

MART_BRAND_COMPETITIVE = """
    brand string, category_leaf string, marketplace string, ingested_at date, asin_count bigint,
    avg_bsr_primary bigint, min_bsr_primary int, avg_rating_weighted double, in_stock_rate double,
    fba_count bigint, avg_variation_count double, avg_color_count double, avg_size_count double,
    fba_pct double, gold_processed_at timestamp
"""


def parse(ddl: str) -> StructType:
    """The StructType of a DDL text (needs a running session)."""
    return StructType.fromDDL(ddl)


def column_names(ddl: str) -> list[str]:
    return parse(ddl).names
