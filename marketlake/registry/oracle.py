"""The SQL each registered query is checked against.

Expected values come from the driver's tables by plain arithmetic: no text is put together and parsed again.
"""

from marketlake.registry.queries import CUT_DAY, DAY, DRIFT_EDGES, MARKETPLACE, SYNONYM_PERCENT, TREND_END, WEEK_START


def _row_round(x: str, places: int) -> str:
    """Half-up on the shortest decimal form of a double."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {places}) AS DOUBLE)"


def _settled(x: str, places: int) -> str:
    """Half-up after ten decimal places: averages of doubles depend on the order of summation beyond that."""
    return f"CAST(round(CAST({x} AS DECIMAL(38,10)), {places}) AS DOUBLE)"


def _columns(columns: dict[str, str]) -> str:
    return ",\n    ".join(f"{expression} AS {name}" for name, expression in columns.items())


TIME_FORMAT = "'%Y-%m-%d %H:%M:%S.%f'"

# --- cards, from events ---------------------------------------------------------------------------------------

EVENTS = """ev AS (
  SELECT event_id, user_id, event_type, ts, CAST(ts AS DATE) AS ingested_at,
    CAST(floor(value * 100 + 0.5) AS BIGINT) AS cents,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
    'P' || (user_id * 17) AS asin,
    CASE WHEN user_id % 2 = 0 THEN 'US' ELSE 'DE' END AS marketplace,
    event_type || CASE user_id % 4 WHEN 0 THEN ' kit' WHEN 1 THEN ' kits' WHEN 2 THEN ' set'
      ELSE '  SETS' END AS keyword
  FROM events)"""

CARDS = f"""latest_ev AS (
  SELECT *,
    CASE WHEN k % 11 = 0 OR k % 13 = 0 THEN NULL WHEN k % 3 = 0 THEN CAST(cents * 10 AS DOUBLE)
      ELSE cents / 100 END AS price_amount,
    CASE WHEN k % 4 <> 0 THEN (cents + k * 7) / 100 END AS original_price_amount
  FROM ev
  QUALIFY row_number() OVER (PARTITION BY asin, keyword, marketplace, ingested_at
                             ORDER BY ts DESC, event_id DESC) = 1),
cards AS (
  SELECT asin, 'Card ' || event_id AS title,
    CASE WHEN k % 11 = 0 THEN NULL WHEN k % 13 = 0 THEN 'N/A'
      WHEN k % 3 = 0 THEN 'VND ' || format('{{:,}}', cents * 10)
      ELSE '$' || (cents // 100) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') END AS price_raw,
    CASE WHEN k % 11 = 0 THEN NULL WHEN k % 13 = 0 THEN 'N/A' WHEN k % 3 = 0 THEN 'VND' ELSE '$' END
      AS price_currency,
    price_amount, original_price_amount,
    CASE WHEN original_price_amount > 0 THEN
      {_row_round("(original_price_amount - price_amount) / original_price_amount * 100", 2)} END AS discount_pct,
    CASE WHEN k % 10 <> 0 THEN ((k % 4 + 1) * 10 + k % 10) / 10 END AS rating,
    CASE WHEN k % 9 = 0 THEN NULL WHEN k % 3 = 0 THEN CAST(trunc((k * 10 + event_id % 10) / 10 * 1000) AS BIGINT)
      WHEN k % 7 = 0 THEN CAST(1000 + k AS BIGINT) ELSE event_id % 1000 END AS ratings_count,
    CASE WHEN k % 5 = 0 THEN NULL WHEN k % 2 = 0 THEN CAST((k % 9 + 1) * 1000 AS BIGINT)
      WHEN k % 3 = 0 THEN CAST(1000 + k AS BIGINT) ELSE CAST(k * 10 + 50 AS BIGINT) END AS monthly_sales,
    CASE WHEN k % 17 <> 0 THEN k % 4 = 0 END AS is_sponsored,
    k % 3 = 0 AS is_prime, k % 23 = 0 AS is_best_seller, k % 19 = 0 AS is_amazons_choice,
    k % 6 IN (0, 1) AS has_coupon,
    CASE WHEN k % 6 = 0 THEN CAST(5 + k % 20 AS DOUBLE) END AS coupon,
    'FREE delivery in ' || (k % 7) || ' days' AS delivery,
    '/dp/' || asin AS url, '/img/' || asin || '.jpg' AS image_url,
    keyword, marketplace, strftime(ts, {TIME_FORMAT}) AS source_extracted_at, ingested_at, ts, event_id
  FROM latest_ev)"""

CARD_COLUMNS = "* EXCLUDE (ts, event_id)"

# --- product pages, from lineitem and part --------------------------------------------------------------------

PAGE_KEYS = {
    "asin": "'P' || l_partkey",
    "marketplace": "CASE WHEN l_linestatus = 'O' THEN 'US' ELSE 'DE' END",
    "ingested_at": "CAST(l_shipdate AS DATE)",
}
SOURCE_FILE = """lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || '_' ||
      lpad(CAST(CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS VARCHAR), 12, '0')
      || '_' || l_suppkey || '_' || q || '_' || l_returnflag"""
BRAND = {
    "brand": """CASE WHEN p_size = 13 THEN NULL WHEN p_size = 14 THEN 'Visit the ' || p_brand || ' Store'
      WHEN p_size = 15 THEN 'Brand: ' || p_brand ELSE p_brand END"""
}
SIZES = {
    "dimension_length": """CASE WHEN p_size % 6 = 2 THEN NULL WHEN p_size % 3 = 0 THEN q + CAST(0.5 AS DOUBLE)
      WHEN p_size % 3 = 1 THEN CAST(q AS DOUBLE) END""",
    "dimension_width": "CASE WHEN p_size % 6 <> 2 AND p_size % 3 IN (0, 1) THEN CAST(p_size AS DOUBLE) END",
    "dimension_height": "CASE WHEN p_size % 6 <> 2 AND p_size % 3 = 0 THEN CAST(3.25 AS DOUBLE) END",
    "dimension_unit": """CASE WHEN p_size % 6 = 2 THEN NULL WHEN p_size % 3 = 0 THEN 'inches'
      WHEN p_size % 3 = 1 THEN 'cm' ELSE '' END""",
    "weight_value": """CASE WHEN p_size = 20 OR l_linenumber % 3 = 0 THEN NULL
      WHEN l_linenumber % 3 = 1 THEN q + CAST(0.25 AS DOUBLE) ELSE CAST(q AS DOUBLE) END""",
    "weight_unit": """CASE WHEN p_size = 20 THEN NULL WHEN l_linenumber % 3 = 0 THEN ''
      WHEN l_linenumber % 3 = 1 THEN 'ounces' ELSE 'Fluid ounces' END""",
}
_RATED = "p_size % 9 <> 0 AND p_size % 10 <> 0"
RATINGS = {
    "rating_pct_5": f"CASE WHEN {_RATED} THEN CAST(p_size AS DOUBLE) ELSE 0 END",
    "rating_pct_4": f"CASE WHEN {_RATED} THEN CAST(q AS DOUBLE) ELSE 0 END",
    "rating_pct_3": f"CASE WHEN {_RATED} THEN CAST(l_linenumber AS DOUBLE) ELSE 0 END",
    "rating_pct_2": "CAST(0 AS DOUBLE)",
    "rating_pct_1": "CAST(0 AS DOUBLE)",
    "rating_weighted_avg": f"""CASE WHEN {_RATED} THEN
      {_row_round("(5 * p_size + 4 * q + 3 * l_linenumber) / (p_size + q + l_linenumber)", 2)} END""",
}
DATES = {"date_first_available": "CASE WHEN l_linenumber % 4 <> 3 THEN CAST(l_shipdate AS DATE) END"}
NESTED = {
    "category_depth": """CAST(CASE WHEN p_size = 17 THEN NULL WHEN p_size = 18 THEN 0 WHEN p_size % 2 = 0 THEN 3
      ELSE 2 END AS INTEGER)""",
    "category_leaf": """CASE WHEN p_size IN (17, 18) THEN NULL WHEN p_size % 2 = 0 THEN p_name ELSE p_type END""",
    "size_count": "CASE WHEN p_size % 7 <> 0 THEN p_size % 5 END",
    "color_count": "CASE WHEN p_size % 7 <> 0 THEN l_linenumber END",
    "main_image_url": "CASE WHEN p_size % 4 > 1 THEN '/img/' || l_partkey || '.jpg' END",
    "image_count": "CASE WHEN p_size % 4 <> 0 THEN p_size % 4 - 1 END",
    "in_stock": "CASE l_linenumber % 3 WHEN 1 THEN true WHEN 2 THEN false END",
}
RANKS = {
    "rank_0": "CASE p_size % 4 WHEN 2 THEN q WHEN 3 THEN 1000 + q END",
    "category_0": "CASE WHEN p_size % 4 IN (2, 3) THEN p_type END",
    "rank_1": "CASE p_size % 4 WHEN 3 THEN q END",
    "category_1": "CASE p_size % 4 WHEN 3 THEN p_name END",
    "rank_2": "CAST(NULL AS INTEGER)",
    "category_2": "CASE p_size % 4 WHEN 3 THEN '' END",
}

LINES = """pg AS (
  SELECT *, CAST(l_quantity AS INTEGER) AS q FROM lineitem JOIN part ON l_partkey = p_partkey)"""

PAGES = f"""pages_typed AS (
  SELECT
    {_columns(PAGE_KEYS | BRAND | SIZES | RATINGS | DATES | NESTED | RANKS)},
    {SOURCE_FILE} AS source_file,
    trim(p_name) AS title, 'All > ' || p_type AS category_path, 'G' || l_suppkey AS parent_asin,
    CASE WHEN p_size % 6 = 2 THEN NULL WHEN p_size % 3 = 0 THEN q || '.5 x ' || p_size || ' x 3.25 inches'
      WHEN p_size % 3 = 1 THEN q || ' x ' || p_size || ' cm' ELSE 'round' END AS dimensions_raw,
    CASE p_size % 4 WHEN 1 THEN '' WHEN 2 THEN q || '|' || p_type
      WHEN 3 THEN (1000 + q) || '|' || p_type || ';' || q || '|' || p_name || ';' END AS best_seller_ranks,
    CASE p_size % 4 WHEN 1 THEN '' WHEN 2 THEN '/img/' || l_partkey || '.jpg'
      WHEN 3 THEN '/img/' || l_partkey || '.jpg;/img/' || l_partkey || '.jpg' END AS all_image_urls,
    l_linenumber AS variation_count, 'S' || l_suppkey AS buybox_seller, l_returnflag = 'N' AS is_fba,
    l_shipdate + (l_linenumber + 7) * INTERVAL 1 HOUR AS ts
  FROM pg),
pages_latest AS (
  SELECT * FROM pages_typed
  QUALIFY row_number() OVER (PARTITION BY asin, marketplace, ingested_at ORDER BY ts DESC, source_file DESC) = 1)"""

PAGE_HISTORY = """page_versions AS (
  SELECT *, sha256(concat_ws('~', coalesce(title, ''), coalesce(brand, ''), coalesce(category_path, ''),
      coalesce(category_leaf, ''), coalesce(CAST(category_depth AS VARCHAR), ''), CAST(is_fba AS VARCHAR),
      CAST(variation_count AS VARCHAR))) AS attr_hash
  FROM pages_latest),
page_starts AS (
  SELECT *, lag(attr_hash) OVER (PARTITION BY asin, marketplace ORDER BY ingested_at) AS hash_before
  FROM page_versions),
products AS (
  SELECT sha256(concat_ws('~', asin, marketplace, CAST(ingested_at AS VARCHAR))) AS product_sk, asin, marketplace,
    title, brand, category_path, category_leaf, category_depth, category_0 AS bsr_primary_category,
    date_first_available, variation_count, size_count, color_count, main_image_url, is_fba,
    ingested_at AS effective_date,
    CAST(lead(ingested_at) OVER (PARTITION BY asin, marketplace ORDER BY ingested_at) - 1 AS DATE) AS expiry_date,
    lead(ingested_at) OVER (PARTITION BY asin, marketplace ORDER BY ingested_at) IS NULL AS is_current, attr_hash
  FROM page_starts WHERE hash_before IS DISTINCT FROM attr_hash)"""

# --- customers, from orders -----------------------------------------------------------------------------------

CUSTOMERS = """customer_days AS (
  SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS day, o_orderstatus, o_orderpriority,
    sha256(concat_ws('~', coalesce(o_orderstatus, ''), coalesce(o_orderpriority, ''))) AS attr_hash
  FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) = 1)"""


def _history(days: str) -> str:
    return f"""starts AS (
  SELECT *, lag(attr_hash) OVER (PARTITION BY o_custkey ORDER BY day) AS hash_before FROM {days}),
history AS (
  SELECT o_custkey, o_orderkey, o_orderstatus, o_orderpriority, day AS effective_date,
    CAST(lead(day) OVER (PARTITION BY o_custkey ORDER BY day) - 1 AS DATE) AS expiry_date,
    lead(day) OVER (PARTITION BY o_custkey ORDER BY day) IS NULL AS is_current, attr_hash,
    sha256(concat_ws('~', CAST(o_custkey AS VARCHAR), CAST(day AS VARCHAR))) AS version_sk
  FROM starts WHERE hash_before IS DISTINCT FROM attr_hash)"""


# --- facts and marts ------------------------------------------------------------------------------------------

RANKING_COLUMNS = """c.asin, c.keyword, c.marketplace, c.ingested_at, price_amount, original_price_amount, discount_pct,
    rating AS rating_value, ratings_count, monthly_sales AS monthly_sales_min, is_sponsored, is_prime,
    is_best_seller, is_amazons_choice, has_coupon, coupon AS coupon_discount_pct, source_extracted_at"""

CURRENT_PRODUCTS = "current_products AS (SELECT * FROM products WHERE is_current)"

PRICES = f"""prices AS (
  SELECT asin, marketplace, ingested_at,
    {_row_round("min(price_amount)", 2)} AS min_price, {_row_round("max(price_amount)", 2)} AS max_price,
    {_settled("avg(price_amount)", 2)} AS avg_price,
    arg_max({{'p': price_amount}}, (ts, event_id)).p AS latest_price,
    arg_max({{'p': original_price_amount}}, (ts, event_id)).p AS original_price_latest,
    arg_max({{'p': discount_pct}}, (ts, event_id)).p AS discount_pct_latest,
    bool_or(has_coupon) AS has_coupon,
    arg_max({{'p': coupon}}, (ts, event_id)).p AS coupon_discount_pct_latest,
    CAST(count(DISTINCT keyword) AS INTEGER) AS keyword_appearance_count
  FROM cards GROUP BY asin, marketplace, ingested_at)"""

KEYWORD_MART = f"""keyword_mart AS (
  SELECT *, CASE WHEN total_products > 0 THEN {_row_round("sponsored_count / total_products * 100", 2)} END
      AS sponsored_pct
  FROM (
    SELECT keyword, marketplace, ingested_at, count(DISTINCT asin) AS total_products,
      CAST(sum(CAST(is_sponsored AS INTEGER)) AS BIGINT) AS sponsored_count,
      CAST(sum(CAST(is_prime AS INTEGER)) AS BIGINT) AS prime_count,
      CAST(sum(CAST(is_best_seller AS INTEGER)) AS BIGINT) AS best_seller_count,
      CAST(sum(CAST(is_amazons_choice AS INTEGER)) AS BIGINT) AS amazons_choice_count,
      CAST(sum(CAST(has_coupon AS INTEGER)) AS BIGINT) AS coupon_count,
      {_settled("avg(price_amount)", 2)} AS avg_price,
      {_row_round("quantile_disc(price_amount, 0.5)", 2)} AS median_price,
      {_row_round("min(price_amount)", 2)} AS min_price, {_row_round("max(price_amount)", 2)} AS max_price,
      {_settled("avg(rating)", 2)} AS avg_rating_value,
      CAST({_row_round("avg(ratings_count)", 0)} AS BIGINT) AS avg_ratings_count,
      CAST(sum(monthly_sales) AS BIGINT) AS total_monthly_sales_min
    FROM cards GROUP BY keyword, marketplace, ingested_at))"""

PERFORMANCE = """performance AS (
  SELECT v.product_sk, l.asin, l.marketplace, l.ingested_at, rank_0 AS bsr_primary_rank,
    category_0 AS bsr_primary_category, rank_1 AS bsr_secondary_rank, category_1 AS bsr_secondary_category,
    rating_weighted_avg, rating_pct_5, rating_pct_4, rating_pct_3, rating_pct_2, rating_pct_1, in_stock,
    buybox_seller, l.is_fba, l.variation_count, l.size_count, l.color_count, image_count
  FROM pages_latest l LEFT JOIN products v ON l.asin = v.asin AND l.marketplace = v.marketplace
    AND l.ingested_at >= v.effective_date AND (v.expiry_date IS NULL OR l.ingested_at <= v.expiry_date))"""


def _brand_mart(fact: str, dim: str) -> str:
    return f"""
SELECT *, CASE WHEN asin_count > 0 THEN {_row_round("fba_count / asin_count * 100", 2)} END AS fba_pct
FROM (
  SELECT d.brand, d.category_leaf, f.marketplace, f.ingested_at, count(DISTINCT f.asin) AS asin_count,
    CAST({_row_round("avg(bsr_primary_rank)", 0)} AS BIGINT) AS avg_bsr_primary,
    min(bsr_primary_rank) AS min_bsr_primary, {_settled("avg(rating_weighted_avg)", 2)} AS avg_rating_weighted,
    {_settled("avg(CAST(in_stock AS INTEGER)) * 100", 2)} AS in_stock_rate,
    CAST(sum(CAST(f.is_fba AS INTEGER)) AS BIGINT) AS fba_count,
    {_settled("avg(f.variation_count)", 1)} AS avg_variation_count,
    {_settled("avg(f.color_count)", 1)} AS avg_color_count, {_settled("avg(f.size_count)", 1)} AS avg_size_count
  FROM {fact} f JOIN {dim} d ON f.product_sk = d.product_sk
  WHERE d.brand IS NOT NULL
  GROUP BY d.brand, d.category_leaf, f.marketplace, f.ingested_at)"""


# --- the lake built by a backfill over the events' days -------------------------------------------------------

EVENT_PRODUCTS = """event_pages AS (
  SELECT *, 'Product ' || user_id AS title, 'B' || (user_id % 7) AS brand, k % 3 + 1 AS variation_count,
    k % 2 = 0 AS is_fba
  FROM ev QUALIFY row_number() OVER (PARTITION BY asin, marketplace, ingested_at ORDER BY ts DESC) = 1),
event_hashes AS (
  SELECT *, concat_ws('~', CAST(is_fba AS VARCHAR), CAST(variation_count AS VARCHAR)) AS state,
    lag(state) OVER (PARTITION BY asin, marketplace ORDER BY ingested_at) AS state_before
  FROM event_pages),
event_products AS (
  SELECT sha256(concat_ws('~', asin, marketplace, CAST(ingested_at AS VARCHAR))) AS product_sk, asin, marketplace,
    title, brand, 'All > Things' AS category_path, 'Things' AS category_leaf, 1 AS category_depth,
    'Things' AS bsr_primary_category, CAST(NULL AS DATE) AS date_first_available, variation_count,
    CAST(NULL AS INTEGER) AS size_count, CAST(NULL AS INTEGER) AS color_count,
    CAST(NULL AS VARCHAR) AS main_image_url, is_fba, ingested_at AS effective_date,
    CAST(lead(ingested_at) OVER (PARTITION BY asin, marketplace ORDER BY ingested_at) - 1 AS DATE) AS expiry_date,
    lead(ingested_at) OVER (PARTITION BY asin, marketplace ORDER BY ingested_at) IS NULL AS is_current
  FROM event_hashes WHERE state_before IS DISTINCT FROM state)"""

EVENT_PERFORMANCE = """event_performance AS (
  SELECT v.product_sk, p.asin, p.marketplace, p.ingested_at, k + 1 AS bsr_primary_rank,
    CAST(NULL AS DOUBLE) AS rating_weighted_avg, CAST(NULL AS BOOLEAN) AS in_stock, p.is_fba, p.variation_count,
    v.color_count, v.size_count
  FROM event_pages p JOIN event_products v ON p.asin = v.asin AND p.marketplace = v.marketplace
    AND p.ingested_at >= v.effective_date AND (v.expiry_date IS NULL OR p.ingested_at <= v.expiry_date))"""


# --- queries --------------------------------------------------------------------------------------------------


def _with(*parts: str) -> str:
    *ctes, final = parts
    return "WITH " + ",\n".join(ctes) + "\n" + final


def _page_query(columns: dict[str, str]) -> str:
    keys = PAGE_KEYS | {"ingested_at": "CAST(CAST(l_shipdate AS DATE) AS VARCHAR)"}
    return _with(
        LINES,
        f"SELECT {_columns(keys | {'source_file': SOURCE_FILE, 'variation_count': 'l_linenumber'} | columns)} FROM pg",
    )


def _line_query(columns: dict[str, str]) -> str:
    return f"""
WITH raw AS (
  SELECT l_orderkey, l_linenumber, l_partkey, CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS cents,
    CAST(l_quantity AS INTEGER) AS q, CAST(floor(l_discount * 100 + 0.5) AS INTEGER) AS d
  FROM lineitem),
parsed AS (
  SELECT *,
    CASE WHEN q IN (7, 11) THEN NULL WHEN l_linenumber = 1 THEN CAST(cents AS DOUBLE) ELSE cents / 100 END AS price,
    CASE WHEN d = 0 THEN NULL WHEN d = 10 THEN CAST(0 AS DOUBLE)
      ELSE cents // (100 - d) + CAST(0.5 AS DOUBLE) END AS original
  FROM raw)
SELECT l_orderkey, l_linenumber, l_partkey, cents, {_columns(columns)} FROM parsed"""


def _percent_rank(metric: str) -> str:
    return f"""percent_rank() OVER (PARTITION BY marketplace, ingested_at
      ORDER BY coalesce({metric}, 0))"""


def _opportunity(final: str) -> str:
    score = f"""0.5 * {_percent_rank("total_monthly_sales_min")} - 0.3 * {_percent_rank("sponsored_pct")}
      - 0.2 * {_percent_rank("avg_ratings_count")}"""
    return _with(
        EVENTS,
        CARDS,
        KEYWORD_MART,
        f"""scored AS (
  SELECT keyword, marketplace, ingested_at, total_monthly_sales_min, sponsored_pct, avg_ratings_count,
    best_seller_count, {_settled(score, 6)} AS opportunity_score,
    coalesce(sponsored_pct < 30 AND avg_ratings_count < 500, false) AS is_target
  FROM keyword_mart)""",
        final,
    )


def _profile() -> str:
    """Null and range counts of every column of the typed cards."""
    ranges = {"rating": (0, 5), "price_amount": (0, 100), "discount_pct": (0, 100)}
    names = """asin title price_raw price_currency price_amount original_price_amount discount_pct rating
        ratings_count monthly_sales is_sponsored is_prime is_best_seller is_amazons_choice has_coupon coupon
        delivery url image_url keyword marketplace source_extracted_at ingested_at""".split()
    rows = []
    for name in names:
        outside = "CAST(NULL AS BIGINT)"
        if name in ranges:
            low, high = ranges[name]
            outside = f"count(*) FILTER (WHERE {name} NOT BETWEEN {low} AND {high})"
        nulls = f"count(*) FILTER (WHERE {name} IS NULL)"
        rows.append(
            f"SELECT count(*) AS total_rows, '{name}' AS column_name, {nulls} AS null_rows, "
            f"{outside} AS out_of_range_rows, {_row_round(f'{nulls} / count(*)', 4)} AS null_rate FROM cards"
        )
    return _with(EVENTS, CARDS, "\nUNION ALL ".join(rows))


def _customer_step() -> str:
    """History up to the cut day, and one step with the newest later rows; the step taken again changes nothing."""
    return _with(
        CUSTOMERS,
        f"earlier AS (SELECT * FROM customer_days WHERE day < DATE '{CUT_DAY}')",
        _history("earlier"),
        f"""incoming AS (
  SELECT * FROM customer_days WHERE day >= DATE '{CUT_DAY}'
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY day DESC) = 1)""",
        f"""SELECT h.o_custkey, h.o_orderkey, h.o_orderstatus, h.o_orderpriority, h.effective_date,
  CASE WHEN h.is_current AND i.attr_hash <> h.attr_hash THEN CAST(DATE '{CUT_DAY}' - 1 AS DATE)
    ELSE h.expiry_date END AS expiry_date,
  h.is_current AND coalesce(i.attr_hash = h.attr_hash, true) AS is_current, h.version_sk, h.attr_hash
FROM history h LEFT JOIN incoming i ON h.o_custkey = i.o_custkey
UNION ALL
SELECT i.o_custkey, i.o_orderkey, i.o_orderstatus, i.o_orderpriority, DATE '{CUT_DAY}', CAST(NULL AS DATE), true,
  sha256(concat_ws('~', CAST(i.o_custkey AS VARCHAR), '{CUT_DAY}')), i.attr_hash
FROM incoming i LEFT JOIN history h ON h.o_custkey = i.o_custkey AND h.is_current
WHERE h.attr_hash IS DISTINCT FROM i.attr_hash""",
    )


HOT_EVENTS = EVENTS.replace("event_type || CASE", "CASE WHEN event_id % 3 = 0 THEN 'everything' ELSE event_type || CASE").replace(
    "ELSE '  SETS' END AS keyword", "ELSE '  SETS' END END AS keyword"
)


HASHED_PRODUCTS = """SELECT *, sha256(concat_ws('~', title, brand, category_path, category_leaf, CAST(category_depth AS VARCHAR),
  CAST(is_fba AS VARCHAR), CAST(variation_count AS VARCHAR))) AS attr_hash FROM event_products"""
FIRST_EVENTS = EVENTS.replace("FROM events)", "FROM events WHERE CAST(ts AS DATE) <= (SELECT min(CAST(ts AS DATE)) + 2 FROM events))")
_VALID = """LEFT JOIN event_products v ON c.asin = v.asin AND c.marketplace = v.marketplace
  AND c.ingested_at >= v.effective_date AND (v.expiry_date IS NULL OR c.ingested_at <= v.expiry_date)"""
MONTHLY_PAGES = (
    PAGES.replace("CAST(l_shipdate AS DATE) AS ingested_at", "CAST(date_trunc('month', l_shipdate) AS DATE) AS ingested_at")
    .replace(NESTED["category_leaf"], "'L' || (l_linenumber % 2)")
    .replace(NESTED["category_depth"], "1")
)


def _event_ranking() -> str:
    """Cards with the version of their product that was valid on their day."""
    return _with(EVENTS, CARDS, EVENT_PRODUCTS, f"SELECT v.product_sk, {RANKING_COLUMNS} FROM cards c {_VALID}")


def _event_prices(events: str) -> str:
    return _with(events, CARDS, EVENT_PRODUCTS, PRICES, f"SELECT v.product_sk, c.* FROM prices c {_VALID}")


VANISHING = f"""vanishing AS (
  SELECT * FROM keyword_mart WHERE NOT (keyword LIKE 'click%' AND ingested_at >= DATE '{DAY}')
    AND NOT (keyword LIKE 'view%' AND day(ingested_at) % 3 = 0)),
spans AS (
  SELECT keyword, marketplace, min(ingested_at) AS first_day, max(ingested_at) AS last_seen FROM vanishing GROUP BY keyword, marketplace),
calendar AS (
  SELECT keyword, marketplace, first_day, last_seen, CAST(unnest(generate_series(first_day, DATE '{TREND_END}', INTERVAL 1 DAY)) AS DATE) AS ingested_at
  FROM spans),
filled AS (
  SELECT c.*, v.keyword IS NOT NULL AS seen, CAST(coalesce(v.total_monthly_sales_min, 0) AS DOUBLE) AS y,
    CAST(c.ingested_at - c.first_day AS DOUBLE) AS x
  FROM calendar c LEFT JOIN vanishing v USING (keyword, marketplace, ingested_at))"""


def _synonyms() -> str:
    """All pairs of keywords that share a product, and what can be reached from each."""
    return _with(
        f"""named AS (
  SELECT event_type || ' g' || (user_id % 40) AS keyword, user_id, user_id % 40 AS g FROM events),
shown AS (
  SELECT DISTINCT keyword, user_id FROM named UNION SELECT DISTINCT 'all ' || keyword, user_id FROM named WHERE g < 10),
weighed AS (SELECT keyword, user_id, 1000000 // count(*) OVER (PARTITION BY user_id) AS weight FROM shown),
totals AS (SELECT keyword, sum(weight) AS total FROM weighed GROUP BY keyword),
shared AS (
  SELECT a.keyword AS a, b.keyword AS b, sum(a.weight) AS in_both
  FROM weighed a JOIN weighed b ON a.user_id = b.user_id AND a.keyword <> b.keyword GROUP BY a.keyword, b.keyword),
links AS (
  SELECT a, b FROM shared JOIN totals x ON x.keyword = a JOIN totals y ON y.keyword = b
  WHERE 100 * in_both >= {SYNONYM_PERCENT} * (x.total + y.total - in_both)),
reach(a, b) AS (SELECT keyword, keyword FROM totals UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)""".replace(
            "named AS", "RECURSIVE named AS", 1
        ),
        "SELECT a AS keyword, a AS keyword_normal, min(b) AS keyword_group FROM reach GROUP BY a",
    )


def _day_drift() -> str:
    """Histograms of neighbouring days compared bin by bin."""
    counted = []
    for name, edges in DRIFT_EDGES.items():
        bins = [f"{name} < {edges[0]}", *[f"{name} >= {a} AND {name} < {b}" for a, b in zip(edges, edges[1:], strict=False)], f"{name} >= {edges[-1]}", f"{name} IS NULL"]
        listed = ", ".join(f"count(*) FILTER (WHERE {b})" for b in bins)
        counted.append(f"SELECT ingested_at, '{name}' AS column_name, count(*) AS n_rows, [{listed}] AS bins FROM shifted GROUP BY ingested_at")
    return _with(
        EVENTS,
        CARDS,
        f"""shifted AS (
  SELECT ingested_at, discount_pct, CASE WHEN ingested_at >= DATE '{DAY}' THEN price_amount * 3 ELSE price_amount END AS price_amount,
    CASE WHEN ingested_at <> DATE '{WEEK_START}' THEN rating END AS rating FROM cards)""",
        "counted AS (" + " UNION ALL ".join(counted) + ")",
        """paired AS (
  SELECT *, lag(bins) OVER w AS before, lag(n_rows) OVER w AS n_before, lag(ingested_at) OVER w AS previous_day
  FROM counted WINDOW w AS (PARTITION BY column_name ORDER BY ingested_at)),
binned AS (
  SELECT column_name, ingested_at, previous_day, n_rows, (bins[i] + 0.5::DOUBLE) / (n_rows + len(bins) * 0.5::DOUBLE) AS p,
    (before[i] + 0.5::DOUBLE) / (n_before + len(bins) * 0.5::DOUBLE) AS q,
    abs(list_sum(bins[1:i]) / n_rows - list_sum(before[1:i]) / n_before) AS gap
  FROM paired, unnest(range(1, len(bins) + 1)) AS u(i)),
drift AS (
  SELECT column_name, ingested_at, previous_day, n_rows, sum((p - q) * ln(p / q)) AS psi, max(gap) AS gap
  FROM binned GROUP BY column_name, ingested_at, previous_day, n_rows)""",
        f"""SELECT column_name, ingested_at, previous_day, n_rows, {_settled("psi", 6)} AS stability_index,
  {_settled("gap", 6)} AS largest_gap, coalesce({_settled("psi", 6)} > 0.2 OR {_settled("gap", 6)} > 0.1, false) AS drifted FROM drift""",
    )


def _products_between() -> str:
    """Distinct products counted from the cards of each range of days."""
    first, last, day, week = "min(ingested_at)", "max(ingested_at)", f"DATE '{DAY}'", f"DATE '{WEEK_START}'"
    ranges = ((first, last), (first, day), (week, day), (day, day))
    spans = "\n  UNION ALL ".join(f"SELECT {a} AS first_day, {b} AS last_day FROM ev" for a, b in ranges)
    return _with(
        HOT_EVENTS,
        f"spans AS (SELECT DISTINCT * FROM ({spans}) s)",
        """SELECT keyword, marketplace, count(DISTINCT asin)::BIGINT AS total_products, first_day, last_day
FROM ev JOIN spans ON ingested_at BETWEEN first_day AND last_day GROUP BY keyword, marketplace, first_day, last_day""",
    )


#: Cards of two products each, as they are sent.
CARDS_SENT = f"""SELECT CASE side WHEN 0 THEN asin ELSE 'C' || asin END AS asin, '  Card ' || event_id || ' ' AS title,
  CASE WHEN k % 11 = 0 THEN NULL WHEN k % 13 = 0 THEN 'N/A'
    WHEN k % 3 = 0 THEN 'VND ' || format('{{:,}}', cents * 10)
    ELSE '$' || (cents // 100) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') END AS price,
  CASE WHEN k % 4 <> 0 THEN '$' || ((cents + k * 7) // 100) || '.' ||
    lpad(CAST((cents + k * 7) % 100 AS VARCHAR), 2, '0') END AS original_price,
  CASE WHEN k % 10 <> 0 THEN (k % 4 + 1) || '.' || (k % 10) || ' out of 5 stars' END AS rating,
  CASE WHEN k % 9 = 0 THEN NULL WHEN k % 3 = 0 THEN '(' || k || '.' || (event_id % 10) || 'K)'
    WHEN k % 7 = 0 THEN '(1,' || lpad(CAST(k AS VARCHAR), 3, '0') || ')'
    ELSE '(' || (event_id % 1000) || ')' END AS ratings_count,
  CASE WHEN k % 5 = 0 THEN NULL WHEN k % 2 = 0 THEN (k % 9 + 1) || 'K+ bought in past month'
    WHEN k % 3 = 0 THEN '1,' || lpad(CAST(k AS VARCHAR), 3, '0') || '+ bought in past month'
    ELSE (k * 10 + 50) || '+ bought in past month' END AS monthly_sales,
  CASE WHEN k % 17 <> 0 THEN k % 4 = 0 END AS is_sponsored, k % 3 = 0 AS is_prime,
  k % 23 = 0 AS is_best_seller, k % 19 = 0 AS is_amazons_choice,
  CASE k % 6 WHEN 0 THEN 'Save ' || (5 + k % 20) || '%with coupon (some sizes/colors)'
    WHEN 1 THEN 'Save $' || k || ' with coupon' END AS coupon,
  'FREE delivery in ' || (k % 7) || ' days' AS delivery, '/dp/' || asin AS url,
  '/img/' || asin || '.jpg' AS image_url, keyword, marketplace,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS source_extracted_at, CAST(ingested_at AS VARCHAR) AS ingested_at
FROM ev CROSS JOIN (VALUES (0), (1)) sides(side)"""


def oracle_sql() -> dict[str, str]:
    cards = f"SELECT {CARD_COLUMNS} FROM cards"
    day = f"ingested_at = DATE '{DAY}'"
    most_products = "ORDER BY total_products DESC, keyword, marketplace"
    pages = [LINES, PAGES, PAGE_HISTORY]
    event_dim = [EVENTS, EVENT_PRODUCTS]
    return {
        "clean_price": _line_query(
            {
                "price_raw": """CASE WHEN q = 7 THEN NULL WHEN q = 11 THEN 'N/A'
      WHEN l_linenumber = 1 THEN 'VND ' || format('{:,}', cents)
      WHEN l_linenumber = 2 THEN '$' || format('{:,}', cents // 100) || '.' ||
        lpad(CAST(cents % 100 AS VARCHAR), 2, '0') || ' - $' || q || '.99'
      ELSE '$' || (cents // 100) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') END""",
                "price_currency": """CASE WHEN q = 7 THEN NULL WHEN q = 11 THEN 'N/A' WHEN l_linenumber = 1 THEN 'VND'
      ELSE '$' END""",
                "price_amount": "price",
                "original_price_amount": "original",
                "discount_pct": f"""CASE WHEN original > 0 THEN
      {_row_round("(original - price) / original * 100", 2)} END""",
            }
        ),
        "clean_rating_counts": _line_query(
            {
                "rating": "CASE WHEN q % 10 <> 0 THEN (q % 5 * 10 + d % 10) / 10 END",
                "ratings_count": """CASE l_linenumber WHEN 1 THEN CAST(trunc((q * 10 + d % 10) / 10 * 1000) AS BIGINT)
      WHEN 2 THEN CAST(q AS BIGINT) * 1000000 WHEN 3 THEN cents WHEN 4 THEN NULL WHEN 5 THEN NULL
      ELSE l_partkey END""",
                "monthly_sales": """CASE l_linenumber WHEN 1 THEN CAST(q AS BIGINT) * 1000 WHEN 2 THEN cents
      WHEN 3 THEN NULL WHEN 4 THEN NULL ELSE l_partkey END""",
            }
        ),
        "clean_coupon": _line_query(
            {
                "has_coupon": "l_linenumber < 5",
                "coupon": """CASE l_linenumber WHEN 1 THEN CAST(q AS DOUBLE)
      WHEN 3 THEN q + CAST(0.5 AS DOUBLE) END""",
            }
        ),
        "clean_search": _with(EVENTS, CARDS, cards),
        "dedup_latest_cards": _with(
            EVENTS,
            """latest AS (
  SELECT *, row_number() OVER (PARTITION BY asin, keyword, ingested_at ORDER BY ts DESC, event_id DESC) AS position
  FROM ev)""",
            """SELECT asin, keyword, CAST(ingested_at AS VARCHAR) AS ingested_at,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS source_extracted_at,
  'page_' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS source_file
FROM latest WHERE position = 1""",
        ),
        "clean_brand": _page_query(BRAND),
        "clean_bsr": _page_query(RANKS),
        "clean_dimensions_weight": _page_query(SIZES),
        "rating_weighted": _page_query(RATINGS),
        "clean_dates": _page_query(DATES),
        "nested_counts": _page_query(NESTED),
        "clean_products": _with(
            LINES,
            PAGES,
            f"""SELECT * EXCLUDE (rank_0, rank_1, rank_2, category_0, category_1, category_2, source_file, ts),
  strftime(ts, {TIME_FORMAT}) AS source_extracted_at FROM pages_latest""",
        ),
        "ingest_explode": _with(EVENTS, CARDS_SENT),
        "ingest_split": _with(
            EVENTS,
            f"""SELECT * REPLACE (title || '"{{[}}\\" ' AS title, 'all' AS keyword, 'US' AS marketplace,
  ingested_at AS source_extracted_at)
FROM ({CARDS_SENT} WHERE side = 0)""",
        ),
        "feed_drift": _with(
            EVENTS,
            f"""seen AS (
  SELECT ingested_at, unnest([
    CASE WHEN (k + 1) % 3 = 0 THEN {{'f': 'badge', 'd': NULL, 'o': 'STRING'}} END,
    CASE WHEN (k + 1) % 4 = 0 THEN {{'f': 'rating_overview.0', 'd': NULL, 'o': 'BIGINT'}} END,
    CASE WHEN (k + 1) % 5 = 0 THEN {{'f': 'categories[].score', 'd': NULL, 'o': 'DECIMAL'}} END,
    CASE WHEN ingested_at >= DATE '{DAY}' THEN {{'f': 'variation_count', 'd': 'int', 'o': 'STRING'}} END]) AS x
  FROM ev)""",
            """SELECT 'product_details' AS feed, ingested_at, x.f AS field,
  CASE WHEN x.d IS NULL THEN 'new' ELSE 'retyped' END AS change, x.d AS declared, x.o AS observed, count(*) AS seen
FROM seen WHERE x IS NOT NULL GROUP BY ingested_at, x""",
        ),
        "publish_day_roundtrip": _with(
            EVENTS,
            CARDS,
            f"""SELECT {CARD_COLUMNS} REPLACE (CASE WHEN {day} THEN upper(title) ELSE title END AS title)
FROM cards""",
        ),
        "append_then_clean": _with(EVENTS, CARDS, cards),
        "scd2_history": _with(CUSTOMERS, _history("customer_days"), "SELECT * FROM history"),
        "scd2_current": _with(
            CUSTOMERS,
            _history("customer_days"),
            """SELECT o_custkey, o_orderstatus, o_orderpriority, effective_date, version_sk
FROM history WHERE is_current""",
        ),
        "scd2_one_step": _customer_step(),
        "scd2_rerun_day": _customer_step(),
        "scd2_late_day": _with(
            CUSTOMERS.replace("CAST(o_orderdate AS DATE)", "CAST(date_trunc('quarter', o_orderdate) AS DATE)"),
            _history("customer_days"),
            "SELECT * FROM history",
        ),
        "asof_sk_lookup": _with(
            CUSTOMERS,
            _history("customer_days"),
            """asked AS (
  SELECT o_custkey, o_orderkey, CAST(CAST(o_orderdate AS DATE) + shift AS DATE) AS asked_day
  FROM orders CROSS JOIN (VALUES (10), (-10)) shifts(shift))""",
            """SELECT version_sk, a.o_custkey, a.o_orderkey, a.asked_day
FROM asked a LEFT JOIN history h ON a.o_custkey = h.o_custkey AND a.asked_day >= h.effective_date
  AND (h.expiry_date IS NULL OR a.asked_day <= h.expiry_date)""",
        ),
        "dim_product": _with(*pages, "SELECT * FROM products"),
        "fact_search_ranking": _with(
            EVENTS,
            CARDS,
            *pages,
            CURRENT_PRODUCTS,
            f"""SELECT p.product_sk, {RANKING_COLUMNS}
FROM cards c LEFT JOIN current_products p ON c.asin = p.asin AND c.marketplace = p.marketplace""",
        ),
        "fact_price_snapshot": _with(
            EVENTS,
            CARDS,
            *pages,
            CURRENT_PRODUCTS,
            PRICES,
            """SELECT p.product_sk, c.* FROM prices c
LEFT JOIN current_products p ON c.asin = p.asin AND c.marketplace = p.marketplace""",
        ),
        "fact_product_performance": _with(*pages, PERFORMANCE, "SELECT * FROM performance"),
        "mart_keyword_daily": _with(EVENTS, CARDS, KEYWORD_MART, "SELECT * FROM keyword_mart"),
        "mart_brand_competitive": _with(*pages, PERFORMANCE, _brand_mart("performance", "products")),
        "fact_performance_lookup": _with(*pages, PERFORMANCE, "SELECT * FROM performance"),
        "mart_brand_monthly": _with(LINES, MONTHLY_PAGES, PAGE_HISTORY, PERFORMANCE, _brand_mart("performance", "products")),
        "keyword_products_over_days": _products_between(),
        "mart_keyword_exact": _with(HOT_EVENTS, CARDS, KEYWORD_MART, "SELECT * FROM keyword_mart"),
        "keyword_median_exact": """
WITH lines AS (
  SELECT CASE WHEN l_linenumber <= 4 THEN 'lamp' ELSE 'desk' END AS keyword, l_linenumber, CAST(l_quantity AS INTEGER) AS q,
    CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS cents FROM lineitem)
SELECT keyword, quantile_disc(CASE WHEN q IN (7, 11) THEN NULL WHEN l_linenumber = 1 THEN CAST(cents AS DOUBLE) ELSE cents / 100 END, 0.5)
  AS median_price
FROM lines GROUP BY keyword""",
        "backfill_dim_product": _with(*event_dim, HASHED_PRODUCTS),
        "rerun_day_dim_product": _with(*event_dim, HASHED_PRODUCTS),
        "backfill_keyword_mart": _with(EVENTS, CARDS, KEYWORD_MART, "SELECT * FROM keyword_mart"),
        "backfill_brand_mart": _with(*event_dim, EVENT_PERFORMANCE, _brand_mart("event_performance", "event_products")),
        "rerun_day_shrinks": _with(
            *event_dim,
            EVENT_PERFORMANCE,
            f"""SELECT * FROM ({_brand_mart("event_performance", "event_products")}) m
WHERE ingested_at < (SELECT max(CAST(ts AS DATE)) FROM events)""",
        ),
        "late_day_dim_product": _with(*event_dim, HASHED_PRODUCTS),
        "late_day_search_ranking": _event_ranking(),
        "backfill_search_ranking": _event_ranking(),
        "backfill_price_snapshot": _event_prices(EVENTS),
        "daily_runs_dim_product": _with(FIRST_EVENTS, EVENT_PRODUCTS, HASHED_PRODUCTS),
        "daily_runs_price_snapshot": _event_prices(FIRST_EVENTS),
        "late_day_performance": _with(
            *event_dim,
            """SELECT v.product_sk, p.asin, p.marketplace, p.ingested_at, k + 1 AS bsr_primary_rank,
  'Things' AS bsr_primary_category, CAST(NULL AS INTEGER) AS bsr_secondary_rank,
  CAST(NULL AS VARCHAR) AS bsr_secondary_category, CAST(NULL AS DOUBLE) AS rating_weighted_avg,
  CAST(0 AS DOUBLE) AS rating_pct_5, CAST(0 AS DOUBLE) AS rating_pct_4, CAST(0 AS DOUBLE) AS rating_pct_3,
  CAST(0 AS DOUBLE) AS rating_pct_2, CAST(0 AS DOUBLE) AS rating_pct_1, CAST(NULL AS BOOLEAN) AS in_stock,
  CAST(NULL AS VARCHAR) AS buybox_seller, p.is_fba, p.variation_count, CAST(NULL AS INTEGER) AS size_count,
  CAST(NULL AS INTEGER) AS color_count, CAST(NULL AS INTEGER) AS image_count
FROM event_pages p JOIN event_products v ON p.asin = v.asin AND p.marketplace = v.marketplace
  AND p.ingested_at >= v.effective_date AND (v.expiry_date IS NULL OR p.ingested_at <= v.expiry_date)""",
        ),
        "serving_views": _with(
            EVENTS,
            CARDS,
            EVENT_PRODUCTS,
            f"""SELECT c.keyword, p.brand, p.category_leaf, count(*) AS cards, min(c.price_amount) AS lowest_price
FROM cards c JOIN event_products p ON c.asin = p.asin AND c.marketplace = p.marketplace AND p.is_current
WHERE c.marketplace = '{MARKETPLACE}' AND c.ingested_at >= DATE '{DAY}'
GROUP BY c.keyword, p.brand, p.category_leaf""",
        ),
        "keyword_list": _with(EVENTS, CARDS, KEYWORD_MART, f"SELECT * FROM keyword_mart WHERE {day} {most_products}"),
        "keyword_topk": _with(
            EVENTS, CARDS, KEYWORD_MART, f"SELECT * FROM keyword_mart WHERE {day} {most_products} LIMIT 10"
        ),
        "price_slice": _with(
            EVENTS,
            CARDS,
            *pages,
            CURRENT_PRODUCTS,
            PRICES,
            f"""SELECT p.product_sk, c.*, p.brand FROM prices c
LEFT JOIN current_products p ON c.asin = p.asin AND c.marketplace = p.marketplace
WHERE c.{day} AND c.marketplace = '{MARKETPLACE}'""",
        ),
        "opportunity_score": _opportunity("SELECT * FROM scored"),
        "opportunity_shortlist": _opportunity(
            """SELECT *, CAST(row_number() OVER (PARTITION BY marketplace, ingested_at
    ORDER BY opportunity_score DESC, keyword) AS INTEGER) AS position
FROM scored WHERE is_target QUALIFY position <= 3"""
        ),
        "margin_screen": _with(
            EVENTS,
            CARDS,
            KEYWORD_MART,
            PRICES,
            f"""pressure AS (
  SELECT c.keyword, c.marketplace, c.ingested_at, {_settled("avg(p.discount_pct_latest)", 2)} AS avg_discount_pct
  FROM cards c JOIN prices p USING (asin, marketplace, ingested_at)
  GROUP BY c.keyword, c.marketplace, c.ingested_at)""",
            f"""SELECT keyword, marketplace, ingested_at, median_price, min_price, max_price, avg_discount_pct,
  {_settled("coupon_count / total_products * 100", 2)} AS coupon_share_pct,
  {_settled("median_price * (CAST(1 AS DOUBLE) - 0.3 - 0.15) - 1", 2)} AS estimated_margin,
  coalesce(median_price > 20 AND coalesce(avg_discount_pct, 0) <= 30
    AND {_settled("coupon_count / total_products * 100", 2)} <= 50, false) AS passes
FROM keyword_mart LEFT JOIN pressure USING (keyword, marketplace, ingested_at)""",
        ),
        "demand_stability": _with(
            EVENTS,
            CARDS,
            KEYWORD_MART,
            f"""SELECT keyword, marketplace, count(total_monthly_sales_min) AS days,
  {_settled("avg(total_monthly_sales_min)", 2)} AS avg_demand,
  {_settled("stddev_samp(total_monthly_sales_min)", 2)} AS stddev_demand,
  {_settled("avg(total_monthly_sales_min) / nullif(stddev_samp(total_monthly_sales_min), 0)", 4)}
    AS stability_score
FROM keyword_mart GROUP BY keyword, marketplace""",
        ),
        "ad_saturation": _with(
            EVENTS,
            CARDS,
            KEYWORD_MART,
            """SELECT keyword, marketplace, ingested_at, sponsored_pct, best_seller_count,
  CASE WHEN sponsored_pct < 30 THEN 'healthy' WHEN sponsored_pct <= 50 THEN 'competitive'
    WHEN sponsored_pct > 50 THEN 'red_flag' END AS ad_band
FROM keyword_mart""",
        ),
        "fragmentation": _with(
            EVENTS,
            CARDS,
            KEYWORD_MART,
            f"""SELECT keyword, marketplace, ingested_at, best_seller_count, avg_ratings_count,
  {_settled(_percent_rank("best_seller_count"), 6)} AS best_seller_rank,
  {_settled(_percent_rank("avg_ratings_count"), 6)} AS ratings_rank,
  {_percent_rank("best_seller_count")} <= 0.5 AND {_percent_rank("avg_ratings_count")} <= 0.5 AS is_fragmented
FROM keyword_mart""",
        ),
        "rank_history": _with(
            LINES,
            PAGES,
            """SELECT asin, marketplace, ingested_at, rank_0 AS bsr_primary_rank,
  lag(rank_0) OVER (PARTITION BY asin, marketplace ORDER BY ingested_at) AS previous_rank,
  rank_0 - lag(rank_0) OVER (PARTITION BY asin, marketplace ORDER BY ingested_at) AS rank_change
FROM pages_latest""",
        ),
        "keyword_groups": _with(
            EVENTS,
            """SELECT DISTINCT keyword,
  event_type || CASE WHEN user_id % 4 < 2 THEN ' kit' ELSE ' set' END AS keyword_normal,
  CASE event_type WHEN 'error' THEN 'view' ELSE event_type END
    || CASE WHEN user_id % 4 < 2 THEN ' kit' ELSE ' set' END AS keyword_group
FROM ev""",
        ),
        "keyword_synonyms": _synonyms(),
        "demand_trend": _with(
            EVENTS,
            CARDS,
            KEYWORD_MART,
            VANISHING,
            f"""SELECT keyword, marketplace, first_day, last_seen, count(*) AS calendar_days, count(*) FILTER (WHERE NOT seen) AS absent_days,
  {_settled("avg(y)", 2)} AS avg_demand, {_settled("stddev_samp(y)", 2)} AS stddev_demand,
  {_settled("regr_slope(y, x)", 4)} AS slope_per_day,
  {_settled("avg(y) / nullif(round(stddev_samp(y), 6), 0)", 4)} AS stability_score
FROM filled GROUP BY keyword, marketplace, first_day, last_seen""",
        ),
        "demand_absent_days": _with(EVENTS, CARDS, KEYWORD_MART, VANISHING, "SELECT keyword, marketplace, ingested_at FROM filled WHERE NOT seen"),
        "quality_profile": _profile(),
        "profile_drift": _day_drift(),
        "current_uniqueness": _with(
            *pages,
            """SELECT asin, marketplace, count(*) AS current_rows
FROM (FROM products UNION ALL SELECT * FROM products WHERE asin LIKE '%7') p WHERE is_current
GROUP BY asin, marketplace HAVING count(*) > 1""",
        ),
        "null_keys": _with(
            EVENTS,
            CARDS,
            *pages,
            CURRENT_PRODUCTS,
            """ranking AS (
  SELECT p.product_sk, c.* FROM cards c
  LEFT JOIN current_products p ON c.asin = p.asin AND c.marketplace = p.marketplace)""",
            "\nUNION ALL ".join(
                f"SELECT '{key}' AS key_column, count(*) FILTER (WHERE {key} IS NULL) AS null_rows FROM ranking"
                for key in ("product_sk", "asin", "keyword", "marketplace", "ingested_at")
            ),
        ),
        "dim_totals": _with(
            *pages,
            "SELECT count(*) AS total_rows, count(*) FILTER (WHERE is_current) AS current_rows FROM products",
        ),
    }
