"""Whole runs: day by day, again, as a backfill, and served as views."""

import json
import os
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.operators.quality import current_duplicates, null_keys
from marketlake.operators.scd2 import valid_between
from marketlake.plans import daily_run, marts, views
from marketlake.plans.facts import price_snapshot
from marketlake.sources import dim_store, tables

DAYS = ["2026-03-04", "2026-03-05", "2026-03-06"]


def card(asin, price, **more):
    base = {
        "asin": asin,
        "title": f" {asin} ",
        "price": price,
        "original_price": "$50.00",
        "rating": "4.5 out of 5 stars",
        "ratings_count": "(1.2K)",
        "monthly_sales": "300+ bought in past month",
        "is_sponsored": asin == "A1",
        "is_prime": True,
        "is_best_seller": False,
        "is_amazons_choice": False,
    }
    return base | more


def detail(asin, title, **more):
    base = {
        "asin": asin,
        "title": title,
        "brand": "Brand: Acme",
        "category": "Home > Things",
        "best_seller_rank": ["#1,364 in Home", "#1 inThings"],
        "variation_count": 2,
        "images": ["/1.jpg", "/2.jpg"],
        "rating_overview": {"5": 76, "4": 13, "3": 6, "2": 2, "1": 3},
        "stock_status": "In Stock",
        "is_fba": True,
        "categories": [{"name": "Home", "url": "/h", "level": 1}, {"name": "Things", "url": "/t", "level": 2}],
        "description": "long text",
        "variations": [{"asin": "V1", "combination_key": "0_1"}],
    }
    return base | more


def write_feeds(root):
    def put(folder, day, name, metadata, products):
        path = root / folder / day
        path.mkdir(parents=True, exist_ok=True)
        (path / name).write_text(json.dumps({"metadata": metadata, "products": products}))

    for n, day in enumerate(DAYS):
        for keyword in ("lamp", "lamps"):
            meta = {"keyword": keyword, "marketplace": "US", "extracted_at": f"{day}T1{n}:00:00"}
            put("search", day, f"{keyword}.json", meta, [card("A1", f"${20 + n}.99"), card("A2", "$1,299.00", coupon="Save 5%")])
        late = {"keyword": "lamp", "marketplace": "US", "extracted_at": f"{day}T20:00:00"}
        put("search", day, "lamp_late.json", late, [card("A1", f"${10 + n}.49", coupon="Save $5"), card("A9", "N/A")])
        meta = {"marketplace": "US", "extracted_at": f"{day}T09:00:00"}
        products = [detail("A1", "Lamp" if n < 2 else "New lamp"), detail("A3", "Desk", brand=None)]
        if n != 1:
            products.append(detail("A2", f"Sofa {n}", variation_count=n))
        put("details", day, "d.json", meta, products)
    (root / "search" / DAYS[1] / "broken.json").write_text('{"metadata": {"keyword"')


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """One lake built day by day, one built at once."""
    root = tmp_path_factory.mktemp("lake")
    write_feeds(root / "feeds")
    feeds = str(root / "feeds")
    reports = {day: daily_run.run_day(spark, feeds, f"{root}/daily", day) for day in DAYS}
    daily_run.backfill(spark, feeds, f"{root}/whole", DAYS[0], DAYS[-1])
    return feeds, f"{root}/daily", f"{root}/whole", reports


def table(spark, lake, name):
    if name == "dim_product":
        return dim_store.read_dim(spark, daily_run.tables(lake)[name].path)
    found = daily_run.tables(lake)[name]
    return tables.read_days(spark, found.path, found.schema)


def content(spark, lake, name, without=()):
    df = table(spark, lake, name)
    df = df.drop("silver_processed_at", "gold_processed_at", *without)
    return sorted(str(r) for r in df.select(*sorted(df.columns)).collect())


TABLES = [n for n in daily_run.tables("") if n not in ("quarantine_product_details",)]


@pytest.mark.parametrize("name", TABLES)
def test_backfill_equals_daily_runs(spark, built, name):
    _, daily, whole, _ = built
    found = content(spark, daily, name)
    assert found and found == content(spark, whole, name)


def test_reports_count_rows(spark, built):
    _, _, _, reports = built
    by_table = {r.table: r for r in reports[DAYS[1]]}
    assert by_table["bronze_search_results"].details["bad_envelopes"] == 1
    assert by_table["bronze_search_results"].rows_out == 6
    assert (by_table["silver_search_results"].rows_in, by_table["silver_search_results"].rows_out) == (6, 5)
    assert by_table["dim_product"].details == {"total_rows": 3, "current_rows": 3}


def test_typed_values(spark, built):
    _, daily, _, _ = built
    rows = {(r.asin, r.keyword): r for r in table(spark, daily, "silver_search_results").filter(f"ingested_at = '{DAYS[0]}'").collect()}
    late = rows[("A1", "lamp")]
    assert (late.price_amount, late.has_coupon, late.coupon, late.ratings_count) == (10.49, True, None, 1200)
    assert late.title == "A1" and rows[("A2", "lamp")].price_amount == 1299.0
    page = table(spark, daily, "silver_product_details").filter("asin = 'A1'").first()
    assert (page.brand, page.category_leaf, page.category_depth, page.rating_weighted_avg) == ("Acme", "Things", 2, 4.57)
    assert (page.size_count, page.image_count, page.main_image_url, page.in_stock) == (None, 2, "/1.jpg", True)
    assert [tuple(r) for r in page.best_seller_ranks] == [(1364, "Home"), (1, "Things")]


def test_price_snapshot_takes_the_newest_card(spark, built):
    _, daily, _, _ = built
    row = table(spark, daily, "fact_price_snapshot").filter(f"asin = 'A1' and ingested_at = '{DAYS[0]}'").first()
    assert (row.min_price, row.max_price, row.avg_price, row.latest_price) == (10.49, 20.99, 15.74, 10.49)
    assert (row.has_coupon, row.coupon_discount_pct_latest, row.keyword_appearance_count) == (True, None, 2)
    assert row.original_price_latest == 50.0 and row.discount_pct_latest == 79.02


def test_price_snapshot_newest_with_missing_time(stored):
    schema = """asin string, marketplace string, ingested_at date, keyword string, source_extracted_at timestamp,
        price_amount double, original_price_amount double, discount_pct double, has_coupon boolean, coupon double"""
    day = date(2026, 3, 4)
    rows = stored(
        [
            ("a", "US", day, "k1", None, 9.0, None, None, False, None),
            ("a", "US", day, "k2", datetime(2026, 3, 4, 1), 5.0, None, None, False, None),
            ("a", "US", day, "k3", datetime(2026, 3, 4, 2), None, None, None, False, None),
            ("a", "US", day, "k3", datetime(2026, 3, 4, 0), 6.0, None, None, False, None),
            (None, "US", day, "k3", datetime(2026, 3, 4, 2), 1.0, None, None, False, None),
        ],
        schema,
    )
    found = price_snapshot(rows).collect()
    assert [(r.asin, r.latest_price, r.min_price, r.keyword_appearance_count) for r in found] == [("a", None, 5.0, 3)]


def test_search_only_product_keeps_its_row(spark, built):
    _, daily, _, _ = built
    rows = table(spark, daily, "fact_search_ranking").filter("asin = 'A9'").collect()
    assert len(rows) == 3 and all(r.product_sk is None for r in rows)


def test_brand_mart_leaves_out_unknown_brands(spark, built):
    _, daily, _, _ = built
    rows = {str(r.ingested_at): r for r in table(spark, daily, "mart_brand_competitive").collect()}
    assert {r.brand for r in rows.values()} == {"Acme"}
    assert [rows[d].asin_count for d in DAYS] == [2, 1, 2]
    assert rows[DAYS[0]].fba_pct == 100.0 and rows[DAYS[0]].avg_bsr_primary == 1364


def test_counting_needs_no_distinct_on_published_facts(spark, built):
    _, daily, _, _ = built
    fact = table(spark, daily, "fact_search_ranking")
    quick, exact = (marts.mart_keyword_daily(fact, unique_grain=u).drop("gold_processed_at") for u in (True, False))
    assert sorted(map(str, quick.collect())) == sorted(map(str, exact.collect()))
    cards = table(spark, daily, "silver_search_results")
    quick, exact = (price_snapshot(cards, unique_grain=u) for u in (True, False))
    assert sorted(map(str, quick.collect())) == sorted(map(str, exact.collect()))


def test_history_and_checks(spark, built):
    _, daily, _, _ = built
    dim = table(spark, daily, "dim_product")
    lamp = {r.title: r for r in dim.filter("asin = 'A1'").collect()}
    assert str(lamp["Lamp"].expiry_date) == DAYS[1] and not lamp["Lamp"].is_current
    assert str(lamp["New lamp"].effective_date) == DAYS[2] and lamp["New lamp"].is_current
    assert current_duplicates(dim, ["asin", "marketplace"]).count() == 0
    keys = null_keys(table(spark, daily, "fact_search_ranking"), ["asin", "keyword", "marketplace", "ingested_at"])
    assert {r.null_rows for r in keys.collect()} == {0}


def test_reading_since_a_day_holds_every_version_valid_then(spark, built):
    for lake in built[1:3]:
        path = daily_run.tables(lake)["dim_product"].path
        for start in DAYS:
            needed = valid_between(dim_store.read_dim(spark, path), start, DAYS[-1])
            found = valid_between(dim_store.read_dim(spark, path, since=start), start, DAYS[-1])
            assert sorted(map(str, found.collect())) == sorted(map(str, needed.collect()))


def test_rerun_gives_the_same_tables(spark, built):
    feeds, daily, _, reports = built
    before = {name: content(spark, daily, name) for name in TABLES}
    again = daily_run.run_day(spark, feeds, daily, DAYS[-1])
    assert {name: content(spark, daily, name) for name in TABLES} == before
    assert [(r.table, r.rows_in, r.rows_out) for r in again] == [(r.table, r.rows_in, r.rows_out) for r in reports[DAYS[-1]]]


def test_older_day_needs_a_backfill(spark, built):
    feeds, daily, _, _ = built
    with pytest.raises(ValueError, match="use backfill"):
        daily_run.run_day(spark, feeds, daily, DAYS[0])
    with pytest.raises(ValueError, match="must reach that day"):
        daily_run.backfill(spark, feeds, daily, DAYS[0], DAYS[1])


def test_rebuild_of_the_last_days_equals_the_first_build(spark, built):
    feeds, daily, whole, _ = built
    daily_run.backfill(spark, feeds, whole, DAYS[1], DAYS[2])
    assert content(spark, whole, "dim_product") == content(spark, daily, "dim_product")
    assert content(spark, whole, "mart_brand_competitive") == content(spark, daily, "mart_brand_competitive")


def test_day_without_files_writes_nothing(spark, built):
    feeds, daily, _, _ = built
    reports = daily_run.run_day(spark, feeds, daily, "2026-03-07")
    assert {(r.rows_in, r.rows_out) for r in reports if r.table != "dim_product"} == {(0, 0)}
    assert tables.stored_days(spark, daily_run.tables(daily)["mart_keyword_daily"].path) == DAYS


def test_views(spark, built, tmp_path):
    _, daily, _, _ = built
    assert views.register_views(spark, daily) == views.register_views(spark, daily) == list(views.VIEWS)
    assert views.list_views(spark) == sorted(views.VIEWS)
    served = spark.table("dim_product")
    assert len(served.columns) == 19 and "_attr_hash" not in served.columns
    assert served.filter("not is_current").count() == 0 and served.count() == 3
    top = spark.sql(
        "SELECT keyword FROM mart_keyword_daily WHERE ingested_at = :day AND marketplace = :m ORDER BY total_products DESC, keyword",
        args={"day": DAYS[0], "m": "US"},
    )
    assert [r.keyword for r in top.collect()] == ["lamp", "lamps"]
    with pytest.raises(FileNotFoundError, match="not built yet"):
        views.register_views(spark, str(tmp_path))


@pytest.mark.parametrize("rebuild", [False, True])
def test_unfinished_run_is_not_visible(spark, built, rebuild):
    _, daily, whole, _ = built
    path = daily_run.tables(whole)["dim_product"].path
    before = content(spark, whole, "dim_product")
    partial = table(spark, whole, "dim_product").withColumn("title", F.lit("half written"))
    dim_store.write_run(spark, partial, path, "2026-03-08", rebuild)
    assert content(spark, whole, "dim_product") != before
    for marker in Path(path).glob("*/run_day=2026-03-08/_SUCCESS"):
        marker.unlink()
    assert content(spark, whole, "dim_product") == before


def test_old_runs_can_go(spark, built):
    _, daily, _, _ = built
    path = daily_run.tables(daily)["dim_product"].path
    before = content(spark, daily, "dim_product")
    dim_store.drop_old_runs(spark, path)
    assert content(spark, daily, "dim_product") == before
    assert len(os.listdir(path)) == 1


def test_every_table_matches_its_declared_schema(spark, built):
    _, daily, _, _ = built
    for name in TABLES:
        declared = schemas.parse(daily_run.tables(daily)[name].schema)
        assert {f.name: f.dataType for f in table(spark, daily, name).schema} == {f.name: f.dataType for f in declared}
    assert "source_file" not in table(spark, daily, "silver_search_results").columns


LATE_TABLES = [n for n in TABLES if not n.startswith("quarantine")]


@pytest.mark.parametrize("late", DAYS)
def test_a_late_day_gives_the_lake_of_a_backfill(spark, tmp_path, built, late):
    """One day's folders come after all others; the newest day is a plain run."""
    _, _, whole, _ = built
    write_feeds(tmp_path / "feeds")
    (tmp_path / "kept").mkdir()
    for folder in ("search", "details"):
        os.rename(tmp_path / "feeds" / folder / late, tmp_path / "kept" / folder)
    feeds, lake = str(tmp_path / "feeds"), str(tmp_path / "lake")
    for day in DAYS:
        if day != late:
            daily_run.run_day(spark, feeds, lake, day)
    closed = set(Path(lake).glob("gold/dim_product/*/run_day=*/*/*.parquet"))
    for folder in ("search", "details"):
        os.rename(tmp_path / "kept" / folder, tmp_path / "feeds" / folder / late)
    daily_run.run_late_day(spark, feeds, lake, late)
    for name in LATE_TABLES:
        assert content(spark, lake, name) == content(spark, whole, name), name
    assert late == DAYS[-1] or set(Path(lake).glob("gold/dim_product/*/run_day=*/*/*.parquet")) == closed
    path = daily_run.tables(lake)["dim_product"].path
    for start in DAYS:
        needed = valid_between(dim_store.read_dim(spark, path), start, DAYS[-1])
        found = valid_between(dim_store.read_dim(spark, path, since=start), start, DAYS[-1])
        assert sorted(map(str, found.collect())) == sorted(map(str, needed.collect()))


def test_days_and_late_days_after_a_late_day(spark, tmp_path):
    """A patch is taken into the next day's run and into later patches and reruns."""
    write_feeds(tmp_path / "feeds")
    feeds, lake, whole = (str(tmp_path / n) for n in ("feeds", "lake", "whole"))
    page = tmp_path / "feeds" / "details" / DAYS[0] / "d.json"
    first = page.read_text()
    page.write_text(first.replace("Lamp", "Lantern"))
    daily_run.run_day(spark, feeds, lake, DAYS[0])
    (tmp_path / "feeds" / "details" / DAYS[1]).rename(tmp_path / "details1")
    daily_run.run_day(spark, feeds, lake, DAYS[1])
    (tmp_path / "details1").rename(tmp_path / "feeds" / "details" / DAYS[1])
    page.write_text(first)
    daily_run.run_day(spark, feeds, lake, DAYS[2])
    daily_run.run_late_day(spark, feeds, lake, DAYS[0])
    daily_run.run_late_day(spark, feeds, lake, DAYS[1])
    meta = {"marketplace": "US", "extracted_at": "2026-03-07T09:00:00"}
    for day, title in (("2026-03-07", "Newest lamp"), ("2026-03-08", "Newest lamp")):
        (tmp_path / "feeds" / "details" / day).mkdir()
        (tmp_path / "feeds" / "details" / day / "d.json").write_text(json.dumps({"metadata": meta, "products": [detail("A1", title), detail("A2", "Sofa 2", variation_count=2)]}))
        daily_run.run_day(spark, feeds, lake, day)
    daily_run.run_late_day(spark, feeds, lake, DAYS[1])
    daily_run.run_day(spark, feeds, lake, "2026-03-08")
    daily_run.backfill(spark, feeds, whole, DAYS[0], "2026-03-08")
    for name in LATE_TABLES:
        assert content(spark, lake, name) == content(spark, whole, name), name
