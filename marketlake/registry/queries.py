"""One query per operator, over whole tables. Audit stamps are left out: they differ on every run."""

import functools
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.functions import card_text as card
from marketlake.functions import page_text as page
from marketlake.functions.keys import sha_key
from marketlake.operators import medians, quality, scd2
from marketlake.operators.dedup import dedup_latest
from marketlake.operators.lookup import resolve_sk
from marketlake.plans import daily_run, dimension, distinct_days, facts, marts, research, silver, synonyms, views
from marketlake.registry import inputs
from marketlake.sources import dim_store, drift, feeds, split_json, tables
from marketlake.sources.files import TABLE_CODEC, child_names, delete, scratch_dir

Query = Callable[[SparkSession, str], DataFrame]

DAY, MARKETPLACE = "2024-01-15", "US"
WEEK_START = "2024-01-09"
TREND_END = "2024-02-15"
SYNONYM_PERCENT = 50
DRIFT_EDGES = {"price_amount": [10.0, 50.0, 100.0, 200.0, 500.0, 1000.0], "rating": [1.5, 2.5, 3.5, 4.5], "discount_pct": [0.0, 1.0, 5.0, 50.0]}
CUT_DAY = "1998-08-02"
LATE_DAY, WRONG_DAY = "1995-04-01", "1996-01-01"
CUSTOMER = ["o_custkey"]
STATUS = ["o_orderstatus", "o_orderpriority"]
TIME_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _shown(df: DataFrame) -> DataFrame:
    """Without audit stamps, and with times as text, so that no engine's time zone matters."""
    df = df.drop("silver_processed_at", "gold_processed_at")
    if "source_extracted_at" in df.columns:
        df = df.withColumn("source_extracted_at", F.date_format("source_extracted_at", TIME_TEXT))
    return df


def _stored(df: DataFrame) -> DataFrame:
    """Written to the shared folder and read back, for a table that a query reads more than once."""
    path = scratch_dir(df.sparkSession, "stored")
    df.write.parquet(path, compression=TABLE_CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --- typed tables ---------------------------------------------------------------------------------------------


def _search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean_search(inputs.raw_cards(spark, sf_dir))


def _details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean_products(inputs.raw_pages(spark, sf_dir))


def clean_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_search(spark, sf_dir))


def clean_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = F.transform("best_seller_ranks", lambda r: F.concat_ws("|", r["rank"].cast("string"), r["category"]))
    return (
        _shown(_details(spark, sf_dir))
        .withColumn("best_seller_ranks", F.array_join(ranks, ";"))
        .withColumn("all_image_urls", F.array_join("all_image_urls", ";"))
    )


def dedup_latest_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    cards = inputs.raw_cards(spark, sf_dir).select("asin", "keyword", "ingested_at", "source_extracted_at", "source_file")
    newest = [F.col("source_extracted_at").desc(), F.col("source_file").desc()]
    return dedup_latest(cards, ["asin", "keyword", "ingested_at"], newest)


def _line_columns(columns: Callable[[], list]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return inputs.line_texts(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", "cents", *columns())

    return query


def _price_columns():
    price, original = card.price_columns(F.col("price")), card.price_columns(F.col("original_price"))
    return [
        price["raw"].alias("price_raw"),
        price["currency"].alias("price_currency"),
        price["amount"].alias("price_amount"),
        original["amount"].alias("original_price_amount"),
        card.discount_pct(original["amount"], price["amount"]).alias("discount_pct"),
    ]


def _count_columns():
    return [
        card.leading_number(F.col("rating")).alias("rating"),
        card.magnitude_number(F.col("ratings_count"), parens=True).alias("ratings_count"),
        card.magnitude_number(F.col("monthly_sales"), parens=False).alias("monthly_sales"),
    ]


def _coupon_columns():
    return [c.alias(name) for name, c in card.coupon_columns(F.col("coupon")).items()]


def _page_columns(columns: Callable[[], dict]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        keys = ["asin", "marketplace", "ingested_at", "source_file", "variation_count"]
        return inputs.raw_pages(spark, sf_dir).select(*keys, *[c.alias(n) for n, c in columns().items()])

    return query


def _rank_columns():
    ranks = page.seller_ranks(F.col("best_seller_rank"))
    return {
        f"{part}_{n}": F.get(ranks, F.lit(n))[part] for n in range(3) for part in ("rank", "category")
    }


def _nested_columns():
    sizes = F.col("available_dimensions")
    return {
        "category_depth": F.array_size("categories"),
        "category_leaf": page.last_name(F.col("categories")),
        "size_count": F.array_size(sizes["size_name"]),
        "color_count": F.array_size(sizes["color_name"]),
        "main_image_url": F.get("images", F.lit(0)),
        "image_count": F.array_size("images"),
        "in_stock": page.is_in_stock(F.col("stock_status")),
    }


# --- raw feed and storage -------------------------------------------------------------------------------------


def _write_feed(rows: DataFrame, root: str, feed: feeds.Feed, with_companion: bool = False, mode: str = "error") -> None:
    """The rows as JSON envelopes, one per line and row, in one folder per day."""
    fields = [c for c in rows.columns if c not in {*feed.metadata, "source_file", "source_position", "ingested_at"}]
    products = [F.struct(*fields)]
    if with_companion:
        products.append(products[0].withField("asin", F.concat(F.lit("C"), "asin")))
    metadata = F.struct(*[F.col(name).alias(field) for name, field in feed.metadata.items()])
    (
        rows.select(metadata.alias("metadata"), F.array(*products).alias("products"), F.col("ingested_at").alias("day"))
        .hint("rebalance", F.col("day"))
        .write.mode(mode)
        .partitionBy("day")
        .json(f"{root}/{feed.folder}", compression="gzip")
    )


def ingest_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards written as JSON envelopes of two products each, then scanned, stamped and flattened again."""
    root = scratch_dir(spark, "feed")
    rows = inputs.raw_cards(spark, sf_dir)
    _write_feed(rows, root, feeds.SEARCH, with_companion=True)
    days = [name.rpartition("=")[2] for name in child_names(spark, f"{root}/{feeds.SEARCH.folder}")]
    envelopes = feeds.read_envelopes(spark, root, feeds.SEARCH, days, multi_line=False)
    return feeds.flatten(envelopes, feeds.SEARCH).drop("source_file", "source_position")


def ingest_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day's cards as one envelope, with quotes and braces in their titles, read in byte ranges."""
    root = scratch_dir(spark, "split")
    cards = inputs.raw_cards(spark, sf_dir).withColumn("title", F.concat("title", F.lit('"{[}\\" ')))
    fields = [c for c in cards.columns if c not in {*feeds.SEARCH.metadata, "source_file", "source_position", "ingested_at"}]
    first = F.row_number().over(Window.partitionBy("ingested_at").orderBy("title")) == 1
    comma = F.when(first, "").otherwise(",")
    lines = cards.select(F.col("ingested_at").alias("day"), F.lit(1).alias("part"), "title", F.concat(comma, F.to_json(F.struct(*fields))).alias("value"))
    days = cards.select(F.col("ingested_at").alias("day")).distinct()
    metadata = F.to_json(F.struct(F.lit("all").alias("keyword"), F.lit("US").alias("marketplace"), F.col("day").alias("extracted_at")))
    begin = days.select("day", F.lit(0), F.lit(""), F.concat(F.lit('{"metadata": '), metadata, F.lit(', "products": [')))
    end = days.select("day", F.lit(2), F.lit(""), F.lit("]}"))
    lines = lines.union(begin).union(end).repartition("day").sortWithinPartitions("day", "part", "title")
    lines.select("day", "value").write.partitionBy("day").text(f"{root}/{feeds.SEARCH.folder}")
    names = [name.rpartition("=")[2] for name in child_names(spark, f"{root}/{feeds.SEARCH.folder}")]
    rows, _ = split_json.read_split(spark, root, feeds.SEARCH, names, pattern="*.txt")
    return rows.drop("source_file", "source_position")


def feed_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of product pages that are new or of another type from some day on, kept by a run and reported by day."""
    root = scratch_dir(spark, "drift")
    pages = inputs.raw_event_pages(spark, sf_dir).withColumn("k", F.regexp_extract(F.get("best_seller_rank", F.lit(0)), r"\d+", 0).cast("int"))
    stars = F.when(F.col("k") % 4 == 0, F.struct(F.col("k").alias("5"), F.lit(1).alias("0")))
    scored = F.transform("categories", lambda c: c.withField("score", F.when(F.col("k") % 5 == 0, F.lit(0.5))))
    badge = F.when(F.col("k") % 3 == 0, F.lit("new"))
    pages = pages.withColumns({"rating_overview": stars, "categories": scored, "badge": badge}).drop("k")
    earlier = F.col("ingested_at") < DAY
    _write_feed(pages.filter(earlier), root, feeds.DETAILS)
    later = pages.filter(~earlier).withColumn("variation_count", F.col("variation_count").cast("string"))
    _write_feed(later, root, feeds.DETAILS, mode="append")
    span = inputs.raw_event_pages(spark, sf_dir).agg(F.min("ingested_at"), F.max("ingested_at")).first()
    daily_run.record_drift(spark, root, f"{root}/lake", span[0], span[1], multi_line=False)
    table = daily_run.drift_tables(f"{root}/lake")[f"drift_{feeds.DETAILS.name}"]
    report = drift.drift_report(tables.read_days(spark, table.path, table.schema), feeds.DETAILS)
    return report.withColumn("ingested_at", F.col("ingested_at").cast("date"))


def publish_day_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed cards of all days published, one day published again, and everything read back."""
    path = f"{scratch_dir(spark, 'publish')}/silver"
    rows = _search(spark, sf_dir)
    first, last = inputs.raw_cards(spark, sf_dir).agg(F.min("ingested_at"), F.max("ingested_at")).first()
    tables.publish_days(rows, path, schemas.SILVER_SEARCH, first, last, rebalance=True)
    again = tables.read_day(spark, path, schemas.SILVER_SEARCH, DAY).withColumn("title", F.upper("title"))
    copy = f"{path}_copy"
    tables.publish_day(again, copy, schemas.SILVER_SEARCH, DAY)
    tables.publish_day(tables.read_day(spark, copy, schemas.SILVER_SEARCH, DAY), path, schemas.SILVER_SEARCH, DAY)
    return _shown(tables.read_days(spark, path, schemas.SILVER_SEARCH))


def append_then_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw cards appended twice, as by a run repeated in append mode: typing them keeps each card once."""
    path = scratch_dir(spark, "append")
    for _ in range(2):
        tables.append_day(inputs.raw_cards(spark, sf_dir), path, schemas.BRONZE_SEARCH)
    return _shown(silver.clean_search(tables.read_days(spark, path, schemas.BRONZE_SEARCH)))


_LAKES: dict[tuple[str, str], str] = {}


def _lake(spark: SparkSession, sf_dir: str) -> str:
    """A lake built once per session and input, and never changed after that."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LAKES:
        _LAKES[key] = _build_lake(spark, sf_dir)
    return _LAKES[key]


def _build_lake(spark: SparkSession, sf_dir: str, late: str = "") -> str:
    """A new lake, by a backfill over all days of the events. The feeds of a ``late`` day come after it."""
    root = scratch_dir(spark, "lake")
    cards, pages = inputs.raw_cards(spark, sf_dir), inputs.raw_event_pages(spark, sf_dir)
    _write_feed(cards.filter(F.col("ingested_at") != late), f"{root}/feeds", feeds.SEARCH)
    _write_feed(pages.filter(F.col("ingested_at") != late), f"{root}/feeds", feeds.DETAILS)
    span = cards.agg(F.min("ingested_at"), F.max("ingested_at")).first()
    daily_run.backfill(spark, f"{root}/feeds", f"{root}/lake", span[0], span[1], multi_line=False)
    if late:
        _write_feed(cards.filter(F.col("ingested_at") == late), f"{root}/feeds", feeds.SEARCH, mode="append")
        _write_feed(pages.filter(F.col("ingested_at") == late), f"{root}/feeds", feeds.DETAILS, mode="append")
    return f"{root}/lake"


_LATE_LAKES: dict[tuple[str, str], str] = {}


def _late_lake(spark: SparkSession, sf_dir: str) -> str:
    """A lake into which one day in the middle of its history was put after all others."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LATE_LAKES:
        lake = _build_lake(spark, sf_dir, late=DAY)
        daily_run.run_late_day(spark, f"{lake.rpartition('/')[0]}/feeds", lake, DAY, multi_line=False)
        _LATE_LAKES[key] = lake
    return _LATE_LAKES[key]


_DAILY_LAKES: dict[tuple[str, str], str] = {}


def _daily_lake(spark: SparkSession, sf_dir: str) -> str:
    """A lake of the first three days of the events, each built by a run of its own."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _DAILY_LAKES:
        root = scratch_dir(spark, "daily")
        cards, pages = inputs.raw_cards(spark, sf_dir), inputs.raw_event_pages(spark, sf_dir)
        first = cards.agg(F.min("ingested_at").cast("date").alias("day")).first().day
        days = [str(first + timedelta(days=n)) for n in range(3)]
        _write_feed(cards.filter(F.col("ingested_at").isin(days)), f"{root}/feeds", feeds.SEARCH)
        _write_feed(pages.filter(F.col("ingested_at").isin(days)), f"{root}/feeds", feeds.DETAILS)
        for day in days:
            daily_run.run_day(spark, f"{root}/feeds", f"{root}/lake", day, multi_line=False)
        _DAILY_LAKES[key] = f"{root}/lake"
    return _DAILY_LAKES[key]


def daily_runs_dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product history after three plain daily runs, of which the later two append."""
    dim = dim_store.read_dim(spark, daily_run.tables(_daily_lake(spark, sf_dir))["dim_product"].path)
    return _shown(dim).withColumnRenamed("_attr_hash", "attr_hash")


def late_day_dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = dim_store.read_dim(spark, daily_run.tables(_late_lake(spark, sf_dir))["dim_product"].path)
    return _shown(dim).withColumnRenamed("_attr_hash", "attr_hash")


def _lake_table(name: str, lake: Callable[[SparkSession, str], str] = _lake) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        table = daily_run.tables(lake(spark, sf_dir))[name]
        return _shown(tables.read_days(spark, table.path, table.schema))

    return query


def backfill_dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = dim_store.read_dim(spark, daily_run.tables(_lake(spark, sf_dir))["dim_product"].path)
    return _shown(dim).withColumnRenamed("_attr_hash", "attr_hash")


def rerun_day_dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest day of a lake of its own run once more: its versions are taken back and built again."""
    lake = _build_lake(spark, sf_dir)
    newest = dim_store.newest_day(spark, daily_run.tables(lake)["dim_product"].path)
    daily_run.run_day(spark, f"{lake.rpartition('/')[0]}/feeds", lake, newest, multi_line=False)
    dim = dim_store.read_dim(spark, daily_run.tables(lake)["dim_product"].path)
    return _shown(dim).withColumnRenamed("_attr_hash", "attr_hash")


def rerun_day_shrinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brand figures after the newest day is run again with no brand known: that day has none left."""
    lake = _build_lake(spark, sf_dir)
    root, dim = lake.rpartition("/")[0], daily_run.tables(lake)["dim_product"].path
    newest = dim_store.newest_day(spark, dim)
    delete(spark, f"{root}/feeds/{feeds.DETAILS.folder}/day={newest}")
    pages = inputs.raw_event_pages(spark, sf_dir).filter(F.col("ingested_at") == newest)
    _write_feed(pages.withColumn("brand", F.lit(None).cast("string")), f"{root}/feeds", feeds.DETAILS, mode="append")
    daily_run.run_day(spark, f"{root}/feeds", lake, newest, multi_line=False)
    table = daily_run.tables(lake)["mart_brand_competitive"]
    return _shown(tables.read_days(spark, table.path, table.schema))


def serving_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The views registered over a built lake, asked in SQL with bound parameters."""
    views.register_views(spark, _lake(spark, sf_dir))
    return spark.sql(
        """
        SELECT f.keyword, d.brand, d.category_leaf, count(*) AS cards, min(f.price_amount) AS lowest_price
        FROM fact_search_ranking f JOIN dim_product d ON f.asin = d.asin AND f.marketplace = d.marketplace
        WHERE f.marketplace = :marketplace AND f.ingested_at >= :day
        GROUP BY f.keyword, d.brand, d.category_leaf
        """,
        args={"marketplace": MARKETPLACE, "day": DAY},
    )


# --- product history ------------------------------------------------------------------------------------------


def _customer_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = [F.col("o_orderkey").desc()]
    return dedup_latest(inputs.order_snapshots(spark, sf_dir), [*CUSTOMER, "day"], newest)


def _customer_history(days: DataFrame) -> DataFrame:
    versions = scd2.as_new_versions(days, STATUS, F.col("day")).drop("day")
    keyed = versions.withColumn("version_sk", sha_key(*CUSTOMER, "effective_date"))
    return scd2.scd2_history(keyed, CUSTOMER)


def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customer_history(_customer_days(spark, sf_dir)).withColumnRenamed("_attr_hash", "attr_hash")


def scd2_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = _customer_history(_customer_days(spark, sf_dir))
    return views.current_products(history).select(*CUSTOMER, *STATUS, "effective_date", "version_sk")


def _customer_step(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The history after one step from the cut day, and the rows of that step."""
    days = _customer_days(spark, sf_dir)
    cut = scd2.day_literal(CUT_DAY)
    dim = _customer_history(days.filter(F.col("day") < cut))
    newest = dedup_latest(days.filter(F.col("day") >= cut), CUSTOMER, [F.col("day").desc()])
    incoming = scd2.as_new_versions(newest, STATUS, cut).drop("day")
    incoming = incoming.withColumn("version_sk", sha_key(*CUSTOMER, "effective_date"))
    return scd2.scd2_step(_stored(dim), incoming, CUT_DAY, CUSTOMER), incoming


def scd2_one_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History up to a day, then one step with each customer's newest later snapshot."""
    return _customer_step(spark, sf_dir)[0].withColumnRenamed("_attr_hash", "attr_hash")


def scd2_rerun_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with the step taken twice."""
    stepped, incoming = _customer_step(spark, sf_dir)
    return scd2.scd2_step(_stored(stepped), incoming, CUT_DAY, CUSTOMER).withColumnRenamed("_attr_hash", "attr_hash")


def scd2_late_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History by quarter without one quarter, and with wrong rows of another, into which the right rows are spliced."""
    days = inputs.order_snapshots(spark, sf_dir).withColumn("day", F.trunc("day", "quarter"))
    days = _stored(dedup_latest(days, [*CUSTOMER, "day"], [F.col("o_orderkey").desc()]))
    late, wrong = F.col("day") == scd2.day_literal(LATE_DAY), F.col("day") == scd2.day_literal(WRONG_DAY)
    others = days.filter(wrong).withColumn("o_custkey", F.col("o_custkey") + F.col("o_custkey") % 3 - 1)
    others = others.withColumn("o_orderstatus", F.lit("?")).dropDuplicates(CUSTOMER)
    dim = _customer_history(days.filter(~late & ~wrong).unionByName(others))
    snapshots = scd2.as_new_versions(days, STATUS, F.col("day")).drop("day")
    snapshots = snapshots.withColumn("version_sk", sha_key(*CUSTOMER, "effective_date"))
    for day in (LATE_DAY, WRONG_DAY):
        dim = _stored(dim)
        incoming = snapshots.filter(F.col("effective_date") == scd2.day_literal(day))
        seen = snapshots if day == WRONG_DAY else snapshots.filter(F.col("effective_date") != scd2.day_literal(WRONG_DAY))
        if day == LATE_DAY:
            wrong_versions = scd2.as_new_versions(others, STATUS, F.col("day")).drop("day")
            seen = seen.unionByName(wrong_versions.withColumn("version_sk", sha_key(*CUSTOMER, "effective_date")))
        following = scd2.first_after(seen, day, CUSTOMER, scd2.splice_keys(dim, incoming, day, CUSTOMER))
        dim = scd2.scd2_splice(dim, incoming, following, day, CUSTOMER)
    return dim.withColumnRenamed("_attr_hash", "attr_hash")


def asof_sk_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The version valid ten days after each order, and none for ten days before the first."""
    orders = inputs.order_snapshots(spark, sf_dir).select(
        "o_custkey", "o_orderkey", F.explode(F.array(F.date_add("day", 10), F.date_sub("day", 10))).alias("asked_day")
    )
    dim = _customer_history(_customer_days(spark, sf_dir))
    return resolve_sk(orders, dim, CUSTOMER, "asof", day="asked_day", sk="version_sk")


def _product_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimension.dim_history(_details(spark, sf_dir))


def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_product_history(spark, sf_dir)).withColumnRenamed("_attr_hash", "attr_hash")


# --- facts and marts ------------------------------------------------------------------------------------------


def _ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fact_search_ranking(_search(spark, sf_dir), _product_history(spark, sf_dir))


def _prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fact_price_snapshot(_search(spark, sf_dir), _product_history(spark, sf_dir), unique_grain=True)


def _keyword_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart reads no product key, so the cards need no dimension here."""
    return marts.mart_keyword_daily(facts.search_ranking(_search(spark, sf_dir)), unique_grain=True)


def fact_search_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_ranking(spark, sf_dir))


def fact_price_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_prices(spark, sf_dir))


def fact_product_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(facts.performance_with_versions(_details(spark, sf_dir))).drop("brand", "category_leaf")


def _stored_history(details: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pages and their dimension, stored by product; of the pages the columns that the dimension or the fact is made of."""
    read = {*dimension.KEYS, "best_seller_ranks", *schemas.column_names(schemas.DIM_PRODUCT), *schemas.column_names(schemas.FACT_PRODUCT_PERFORMANCE)}
    spark = details.sparkSession
    pages = tables.stored_by(details.select(*[c for c in details.columns if c in read]), scratch_dir(spark, "pages"), dimension.KEYS)
    return pages, tables.stored_by(dimension.dim_history(pages), scratch_dir(spark, "dim"), dimension.KEYS)


def fact_performance_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page fact as the runs write it: surrogate keys looked up in the stored dimension as of each page's day."""
    details, dim = _stored_history(_details(spark, sf_dir))
    return _shown(facts.fact_product_performance(details, dim, "asof"))


def mart_brand_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The brand mart as the runs write it, over one page a month and product: most brands have several products."""
    leaf = F.concat(F.lit("L"), (F.col("variation_count") % 2).cast("string"))
    month = F.trunc(F.col("ingested_at").cast("date"), "month").cast("string")
    category = F.array(F.struct(leaf.alias("name"), F.lit("/l").alias("url"), F.lit(1).alias("level")))
    pages = inputs.raw_pages(spark, sf_dir).withColumns({"ingested_at": month, "categories": category})
    details, dim = _stored_history(silver.clean_products(pages))
    performance = facts.fact_product_performance(details, dim, "asof")
    return _shown(marts.mart_brand_competitive(performance, dim, unique_grain=True))


def mart_keyword_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_keyword_mart(spark, sf_dir))


def mart_brand_competitive(spark: SparkSession, sf_dir: str) -> DataFrame:
    performance = facts.performance_with_versions(_details(spark, sf_dir))
    return _shown(marts.brand_figures(performance, unique_grain=True))


def _hot_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search cards as facts, a third of them under one keyword."""
    cards = inputs.raw_cards(spark, sf_dir)
    hot = F.regexp_extract("title", r"\d+", 0).cast("bigint") % 3 == 0
    cards = cards.withColumn("keyword", F.when(hot, F.lit("everything")).otherwise(F.col("keyword")))
    return facts.search_ranking(silver.clean_search(cards))


def keyword_products_over_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct products of keywords over ranges of days, from states written in two runs, of which one is repeated."""
    root, fact = scratch_dir(spark, "states"), _stored(_hot_ranking(spark, sf_dir))
    first, last = (str(d) for d in fact.agg(F.min("ingested_at"), F.max("ingested_at")).first())
    for start, end in ((DAY, last), (first, DAY), (DAY, last)):
        distinct_days.record_products(spark, fact, root, start, end)
    asked = [
        distinct_days.keyword_products(spark, root, start, end).withColumns({"first_day": scd2.day_literal(start), "last_day": scd2.day_literal(end)})
        for start, end in ((first, last), (first, DAY), (WEEK_START, DAY), (DAY, DAY))
    ]
    return functools.reduce(DataFrame.unionByName, asked)


def keyword_median_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians of two keywords over the prices of all order lines, cleaned from their texts."""
    lines = inputs.line_texts(spark, sf_dir)
    keyword = F.when(F.col("l_linenumber") <= 4, F.lit("lamp")).otherwise(F.lit("desk")).alias("keyword")
    prices = _stored(lines.select(keyword, card.price_columns(F.col("price"))["amount"].alias("price_amount")))
    return medians.exact_medians(prices, ["keyword"], "price_amount", "median_price")


def mart_keyword_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyword mart with exact medians, over facts with one keyword in a third of the rows."""
    fact = _stored(_hot_ranking(spark, sf_dir))
    return _shown(marts.mart_keyword_daily(fact, unique_grain=True, exact_median=True))


# --- research questions ---------------------------------------------------------------------------------------


def keyword_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(research.keyword_list(_keyword_mart(spark, sf_dir), DAY))


def keyword_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(research.keyword_topk(_keyword_mart(spark, sf_dir), DAY, 10))


def price_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = _product_history(spark, sf_dir).filter("is_current")
    prices = facts.fact_price_snapshot(_search(spark, sf_dir), dim, unique_grain=True)
    return _shown(research.price_slice(prices, dim, DAY, MARKETPLACE))


def _on_mart(question: Callable[[DataFrame], DataFrame], read_often: bool = False) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        mart = _keyword_mart(spark, sf_dir)
        return question(_stored(mart) if read_often else mart)

    return query


def margin_screen(spark: SparkSession, sf_dir: str) -> DataFrame:
    search = _stored(_search(spark, sf_dir))
    ranking, prices = facts.search_ranking(search), facts.price_snapshot(search, unique_grain=True)
    mart = marts.mart_keyword_daily(ranking, unique_grain=True)
    return research.margin_screen(mart, ranking, prices, unit_cost=1.0)


def rank_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return research.rank_history(facts.product_performance(_details(spark, sf_dir)))


def keyword_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Synonyms derived from the events: errors are a kind of view."""
    cards = inputs.raw_cards(spark, sf_dir)
    normal = cards.select(research.normal_keyword(F.col("keyword")).alias("keyword_normal")).distinct()
    errors = normal.filter(F.col("keyword_normal").startswith("error"))
    synonyms = errors.withColumn("keyword_group", F.replace("keyword_normal", F.lit("error"), F.lit("view")))
    return research.dim_keyword(cards, synonyms)


def keyword_synonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keywords by kind of event and group of products, a part of them under a second name too, put into groups."""
    cards = inputs.raw_cards(spark, sf_dir)
    user = (F.substring("asin", 2, 20).cast("bigint") / 17).cast("bigint")
    name = F.concat(F.regexp_extract("keyword", "^[a-z]+", 0), F.lit(" g"), (user % 40).cast("string"))
    second = F.when(user % 40 < 10, F.array(name, F.concat(F.lit("all "), name))).otherwise(F.array(name))
    cards = cards.select(F.explode(second).alias("keyword"), "marketplace", "asin")
    return research.dim_keyword(cards, synonyms.keyword_synonyms(cards, SYNONYM_PERCENT))


def _vanishing_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyword mart without some keywords from a day on, and without others every third day of a month."""
    day = F.col("ingested_at")
    gone = F.col("keyword").startswith("click") & (day >= scd2.day_literal(DAY))
    missing = F.col("keyword").startswith("view") & (F.dayofmonth(day) % 3 == 0)
    return _keyword_mart(spark, sf_dir).filter(~gone & ~missing)


def demand_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return research.demand_trend(_vanishing_mart(spark, sf_dir), scd2.day_literal(TREND_END))


def demand_absent_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges = research.absent_ranges(_vanishing_mart(spark, sf_dir), scd2.day_literal(TREND_END))
    return research.absent_days(ranges)


# --- checks ---------------------------------------------------------------------------------------------------


def quality_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    cards = _shown(_search(spark, sf_dir))
    return quality.quality_profile(cards, {"rating": (0, 5), "price_amount": (0, 100), "discount_pct": (0, 100)})


def profile_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between days of the typed cards, with prices tripled from one day on and ratings lost on another."""
    cards, day = _search(spark, sf_dir), F.col("ingested_at")
    shifted = F.when(day >= scd2.day_literal(DAY), F.col("price_amount") * 3).otherwise(F.col("price_amount"))
    lost = F.when(day != scd2.day_literal(WEEK_START), F.col("rating"))
    cards = cards.withColumns({"price_amount": shifted, "rating": lost})
    return quality.day_drift(quality.day_histograms(cards, "ingested_at", DRIFT_EDGES), "ingested_at")


def current_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys current more than once, in a history of which a part is repeated."""
    history = _product_history(spark, sf_dir)
    return quality.current_duplicates(history.unionByName(history.filter(F.col("asin").endswith("7"))), dimension.KEYS)


def null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_keys(_ranking(spark, sf_dir), ["product_sk", "asin", "keyword", "marketplace", "ingested_at"])


def dim_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dim_totals(_product_history(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {
        "clean_price": _line_columns(_price_columns),
        "clean_rating_counts": _line_columns(_count_columns),
        "clean_coupon": _line_columns(_coupon_columns),
        "clean_search": clean_search,
        "dedup_latest_cards": dedup_latest_cards,
        "clean_brand": _page_columns(lambda: {"brand": page.brand_name(F.col("brand"))}),
        "clean_bsr": _page_columns(_rank_columns),
        "clean_dimensions_weight": _page_columns(
            lambda: page.dimension_columns(F.col("dimensions")) | page.weight_columns(F.col("weight"))
        ),
        "rating_weighted": _page_columns(lambda: page.rating_columns(F.col("rating_overview"))),
        "clean_dates": _page_columns(
            lambda: {"date_first_available": page.listing_date(F.col("date_first_available"))}
        ),
        "nested_counts": _page_columns(_nested_columns),
        "clean_products": clean_products,
        "ingest_explode": ingest_explode,
        "ingest_split": ingest_split,
        "feed_drift": feed_drift,
        "publish_day_roundtrip": publish_day_roundtrip,
        "append_then_clean": append_then_clean,
        "scd2_history": scd2_history,
        "scd2_current": scd2_current,
        "scd2_one_step": scd2_one_step,
        "scd2_rerun_day": scd2_rerun_day,
        "scd2_late_day": scd2_late_day,
        "asof_sk_lookup": asof_sk_lookup,
        "dim_product": dim_product,
        "fact_search_ranking": fact_search_ranking,
        "fact_price_snapshot": fact_price_snapshot,
        "fact_product_performance": fact_product_performance,
        "fact_performance_lookup": fact_performance_lookup,
        "mart_brand_monthly": mart_brand_monthly,
        "mart_keyword_daily": mart_keyword_daily,
        "mart_brand_competitive": mart_brand_competitive,
        "keyword_products_over_days": keyword_products_over_days,
        "keyword_median_exact": keyword_median_exact,
        "mart_keyword_exact": mart_keyword_exact,
        "backfill_dim_product": backfill_dim_product,
        "backfill_keyword_mart": _lake_table("mart_keyword_daily"),
        "backfill_brand_mart": _lake_table("mart_brand_competitive"),
        "rerun_day_dim_product": rerun_day_dim_product,
        "rerun_day_shrinks": rerun_day_shrinks,
        "late_day_dim_product": late_day_dim_product,
        "late_day_performance": _lake_table("fact_product_performance", _late_lake),
        "late_day_search_ranking": _lake_table("fact_search_ranking", _late_lake),
        "daily_runs_dim_product": daily_runs_dim_product,
        "daily_runs_price_snapshot": _lake_table("fact_price_snapshot", _daily_lake),
        "backfill_search_ranking": _lake_table("fact_search_ranking"),
        "backfill_price_snapshot": _lake_table("fact_price_snapshot"),
        "serving_views": serving_views,
        "keyword_list": keyword_list,
        "keyword_topk": keyword_topk,
        "price_slice": price_slice,
        "opportunity_score": _on_mart(research.opportunity_score, read_often=True),
        "opportunity_shortlist": _on_mart(
            lambda mart: research.opportunity_shortlist(research.opportunity_score(mart), 3), read_often=True
        ),
        "margin_screen": margin_screen,
        "demand_stability": _on_mart(research.demand_stability),
        "ad_saturation": _on_mart(research.ad_saturation),
        "fragmentation": _on_mart(research.fragmentation, read_often=True),
        "rank_history": rank_history,
        "keyword_groups": keyword_groups,
        "keyword_synonyms": keyword_synonyms,
        "demand_trend": demand_trend,
        "demand_absent_days": demand_absent_days,
        "quality_profile": quality_profile,
        "profile_drift": profile_drift,
        "current_uniqueness": current_uniqueness,
        "null_keys": null_keys,
        "dim_totals": dim_totals,
    }
