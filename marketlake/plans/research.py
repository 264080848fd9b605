"""Market research questions asked of the marts and facts."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions.numbers import settled
from marketlake.operators.ranks import percent_ranks
from marketlake.plans.marts import KEYWORD_GRAIN

MARKET_DAY = ["marketplace", "ingested_at"]

# Weights and thresholds of the research questions.
DEMAND_WEIGHT, COMPETITION_WEIGHT, BARRIER_WEIGHT = 0.5, 0.3, 0.2
TARGET_SPONSORED_PCT, TARGET_RATINGS = 30, 500
HEALTHY_BELOW_PCT, RED_FLAG_ABOVE_PCT = 30, 50
FEE_RATE, ADS_RATE, TARGET_MEDIAN_PRICE = 0.30, 0.15, 20


def on_day(df: DataFrame, day: str, marketplace: str | None = None) -> DataFrame:
    """One day's rows, optionally of one marketplace; both reach the scan as filters."""
    rows = df.filter(F.col("ingested_at") == F.lit(day).cast("date"))
    return rows if marketplace is None else rows.filter(F.col("marketplace") == marketplace)


def keyword_list(mart: DataFrame, day: str) -> DataFrame:
    """A day's keywords, most products first."""
    return on_day(mart, day).orderBy(*_most_products())


def keyword_topk(mart: DataFrame, day: str, k: int = 50) -> DataFrame:
    """The k keywords with most products; each task keeps only its own k."""
    return on_day(mart, day).orderBy(*_most_products()).limit(k)


def price_slice(prices: DataFrame, dim: DataFrame, day: str, marketplace: str) -> DataFrame:
    """Prices of one day and marketplace with the product's brand."""
    brands = dim.select("product_sk", "brand")
    return on_day(prices, day, marketplace).join(brands, "product_sk", "left")


def opportunity_score(mart: DataFrame) -> DataFrame:
    """Demand against paid competition and review barrier, each as its percent rank in the marketplace's day."""
    ranked = percent_ranks(mart, MARKET_DAY, ["total_monthly_sales_min", "sponsored_pct", "avg_ratings_count"])
    score = (
        DEMAND_WEIGHT * F.col("total_monthly_sales_min_rank")
        - COMPETITION_WEIGHT * F.col("sponsored_pct_rank")
        - BARRIER_WEIGHT * F.col("avg_ratings_count_rank")
    )
    target = (F.col("sponsored_pct") < TARGET_SPONSORED_PCT) & (F.col("avg_ratings_count") < TARGET_RATINGS)
    return ranked.select(
        *KEYWORD_GRAIN,
        "total_monthly_sales_min",
        "sponsored_pct",
        "avg_ratings_count",
        "best_seller_count",
        settled(score, 6).alias("opportunity_score"),
        F.coalesce(target, F.lit(False)).alias("is_target"),
    )


def opportunity_shortlist(scored: DataFrame, k: int = 20) -> DataFrame:
    """The k best target keywords of each marketplace and day; every task sends at most k rows per group."""
    best = Window.partitionBy(*MARKET_DAY).orderBy(F.col("opportunity_score").desc(), F.col("keyword"))
    return scored.filter("is_target").withColumn("position", F.row_number().over(best)).filter(F.col("position") <= k)


def margin_screen(
    mart: DataFrame,
    ranking: DataFrame,
    prices: DataFrame,
    unit_cost: float = 0.0,
    fee_rate: float = FEE_RATE,
    ads_rate: float = ADS_RATE,
    max_discount_pct: float = 30.0,
    max_coupon_share_pct: float = 50.0,
) -> DataFrame:
    """Margin left at a keyword's median price, and whether discounts and coupons leave it standing."""
    product_day = ["asin", "marketplace", "ingested_at"]
    pressure = (
        ranking.select(*KEYWORD_GRAIN, "asin")
        .join(prices.select(*product_day, "discount_pct_latest"), product_day)
        .groupBy(*KEYWORD_GRAIN)
        .agg(settled(F.avg("discount_pct_latest"), 2).alias("avg_discount_pct"))
    )
    margin = F.col("median_price") * (1 - fee_rate - ads_rate) - unit_cost
    coupon_share = F.when(F.col("total_products") > 0, F.col("coupon_count") / F.col("total_products") * 100)
    passes = (
        (F.col("median_price") > TARGET_MEDIAN_PRICE)
        & (F.coalesce("avg_discount_pct", F.lit(0.0)) <= max_discount_pct)
        & (F.coalesce("coupon_share_pct", F.lit(0.0)) <= max_coupon_share_pct)
    )
    return (
        mart.join(pressure, KEYWORD_GRAIN, "left")
        .withColumn("estimated_margin", settled(margin, 2))
        .withColumn("coupon_share_pct", settled(coupon_share, 2))
        .withColumn("passes", F.coalesce(passes, F.lit(False)))
        .select(
            *KEYWORD_GRAIN,
            "median_price",
            "min_price",
            "max_price",
            "avg_discount_pct",
            "coupon_share_pct",
            "estimated_margin",
            "passes",
        )
    )


def demand_stability(mart: DataFrame) -> DataFrame:
    """Average demand over its spread across days; NULL with a single day or no spread."""
    demand = F.col("total_monthly_sales_min")
    return (
        mart.groupBy("keyword", "marketplace")
        .agg(
            F.count(demand).alias("days"),
            F.avg(demand).alias("mean"),
            F.stddev_samp(demand).alias("spread"),
        )
        .select(
            "keyword",
            "marketplace",
            "days",
            settled(F.col("mean"), 2).alias("avg_demand"),
            settled(F.col("spread"), 2).alias("stddev_demand"),
            settled(F.try_divide("mean", "spread"), 4).alias("stability_score"),
        )
    )


def absent_ranges(mart: DataFrame, last_day: Column) -> DataFrame:
    """Runs of days without a row, of each keyword and marketplace from its first day to ``last_day``.

    A run is one row, however long; ``absent_days`` spreads it. A window holds one row per day of a keyword.
    """
    by_day = Window.partitionBy("keyword", "marketplace").orderBy("ingested_at")
    following = F.coalesce(F.lead("ingested_at").over(by_day), F.date_add(last_day, 1))
    ranges = mart.select("keyword", "marketplace", F.date_add("ingested_at", 1).alias("first_absent"), F.date_sub(following, 1).alias("last_absent"))
    return ranges.filter("first_absent <= last_absent")


def absent_days(ranges: DataFrame) -> DataFrame:
    """One row per keyword, marketplace and day without a row."""
    return ranges.select("keyword", "marketplace", F.explode(F.sequence("first_absent", "last_absent")).alias("ingested_at"))


def demand_trend(mart: DataFrame, last_day: Column) -> DataFrame:
    """Demand over all days from a keyword's first to ``last_day``, a day without a row counting as no demand.

    The line is fitted by least squares in one aggregation: days without demand add nothing to the sums over demand, and
    the sums over days follow from their number, so no calendar is built. The slope is demand per day; spread and mean
    are over all days too, so that a spike followed by nothing is not stable.
    """
    key = ["keyword", "marketplace"]
    first = F.min("ingested_at").over(Window.partitionBy(*key))
    y = F.coalesce(F.col("total_monthly_sales_min"), F.lit(0)).cast("double")
    rows = mart.select(*key, "ingested_at", y.alias("y"), first.alias("first_day"))
    x = F.datediff("ingested_at", "first_day").cast("double")
    sums = rows.groupBy(*key, "first_day").agg(
        F.count(F.lit(1)).alias("seen_days"), F.max("ingested_at").alias("last_seen"), F.sum("y").alias("sy"), F.sum(x * F.col("y")).alias("sxy"), F.sum(F.col("y") * F.col("y")).alias("syy")
    )
    n = (F.datediff(last_day, "first_day") + 1).cast("double")
    sums = sums.withColumn("n", n)
    sums = sums.withColumns({"sx": F.col("n") * (F.col("n") - 1) / 2, "sxx": (F.col("n") - 1) * F.col("n") * (2 * F.col("n") - 1) / 6})
    slope = F.try_divide(F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy"), F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx"))
    mean = F.col("sy") / F.col("n")
    spread = F.sqrt(F.try_divide(F.greatest(F.col("syy") - F.col("sy") * mean, F.lit(0.0)), F.col("n") - 1))
    return sums.select(
        *key,
        "first_day",
        "last_seen",
        F.col("n").cast("bigint").alias("calendar_days"),
        (F.col("n") - F.col("seen_days")).cast("bigint").alias("absent_days"),
        settled(mean, 2).alias("avg_demand"),
        settled(spread, 2).alias("stddev_demand"),
        settled(slope, 4).alias("slope_per_day"),
        settled(F.try_divide(mean, F.round(spread, 6)), 4).alias("stability_score"),
    )


def ad_saturation(mart: DataFrame) -> DataFrame:
    """How much of a keyword is paid placement, in three bands."""
    pct = F.col("sponsored_pct")
    band = (
        F.when(pct < HEALTHY_BELOW_PCT, "healthy")
        .when(pct <= RED_FLAG_ABOVE_PCT, "competitive")
        .when(pct > RED_FLAG_ABOVE_PCT, "red_flag")
    )
    return mart.select(*KEYWORD_GRAIN, "sponsored_pct", "best_seller_count", band.alias("ad_band"))


def fragmentation(mart: DataFrame, at_most: float = 0.5) -> DataFrame:
    """Keywords in the lower part of their marketplace's day by best sellers and by reviews: open markets."""
    ranked = percent_ranks(mart, MARKET_DAY, ["best_seller_count", "avg_ratings_count"])
    low = (F.col("best_seller_count_rank") <= at_most) & (F.col("avg_ratings_count_rank") <= at_most)
    return ranked.select(
        *KEYWORD_GRAIN,
        "best_seller_count",
        "avg_ratings_count",
        settled(F.col("best_seller_count_rank"), 6).alias("best_seller_rank"),
        settled(F.col("avg_ratings_count_rank"), 6).alias("ratings_rank"),
        low.alias("is_fragmented"),
    )


def rank_history(performance: DataFrame) -> DataFrame:
    """Best-seller rank per product and day with its change since the product's day before.

    A product has one row per day, so its window is bounded by the number of days.
    """
    by_day = Window.partitionBy("asin", "marketplace").orderBy("ingested_at")
    before = F.lag("bsr_primary_rank").over(by_day)
    return performance.select(
        "asin",
        "marketplace",
        "ingested_at",
        "bsr_primary_rank",
        before.alias("previous_rank"),
        (F.col("bsr_primary_rank") - before).alias("rank_change"),
    )


def normal_keyword(keyword: Column) -> Column:
    """Lower case, single spaces, and words of four letters or more without a plural s."""
    words = F.regexp_replace(F.lower(F.trim(keyword)), r"\s+", " ")
    return F.regexp_replace(words, r"(\w{2,}[^\Ws])s\b", "$1")


def dim_keyword(keywords: DataFrame, synonyms: DataFrame | None = None) -> DataFrame:
    """One row per keyword with the group it belongs to; ``synonyms`` maps a normal keyword to its group."""
    distinct = keywords.select("keyword").dropna().distinct()
    normal = distinct.withColumn("keyword_normal", normal_keyword(F.col("keyword")))
    if synonyms is None:
        return normal.withColumn("keyword_group", F.col("keyword_normal"))
    return normal.join(synonyms.select("keyword_normal", "keyword_group"), "keyword_normal", "left").select(
        "keyword", "keyword_normal", F.coalesce("keyword_group", "keyword_normal").alias("keyword_group")
    )


def _most_products() -> list[Column]:
    return [F.col("total_products").desc(), F.col("keyword"), F.col("marketplace")]
