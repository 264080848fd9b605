"""What the physical plans must look like: pruning, pushdown, one shuffle, combining before it."""

import re

import pytest

from marketlake import schemas
from marketlake.plans import dimension, facts, marts, research, silver
from marketlake.sources import dim_store, tables


@pytest.fixture(scope="module")
def stored_tables(spark, tmp_path_factory):
    """Empty stored tables: enough to look at plans."""
    root = tmp_path_factory.mktemp("plans")

    def stored(ddl, name):
        path = f"{root}/{name}"
        spark.createDataFrame([], ddl).write.parquet(path)
        return spark.read.schema(ddl).parquet(path)

    return {
        "bronze": stored(schemas.BRONZE_SEARCH, "bronze"),
        "details": stored(schemas.BRONZE_DETAILS, "details"),
        "search": stored(schemas.SILVER_SEARCH, "search"),
        "ranking": stored(schemas.FACT_SEARCH_RANKING, "ranking"),
        "performance": stored(schemas.FACT_PRODUCT_PERFORMANCE, "performance"),
        "dim": stored(schemas.DIM_PRODUCT, "dim"),
        "keywords": stored(schemas.MART_KEYWORD_DAILY, "keywords"),
    }


def shuffles(plan):
    return len(re.findall(r"\bExchange hashpartitioning", plan))


def read_columns(plan):
    return set(re.findall(r"(\w+)#", re.search(r"FileScan parquet \[(.*?)\]", plan).group(1)))


def test_price_snapshot_is_one_scan_and_one_shuffle(stored_tables, plan_of):
    plan = plan_of(facts.price_snapshot(stored_tables["search"], unique_grain=True))
    assert plan.count("FileScan") == 1 and shuffles(plan) == 1
    assert "partial_max_by" in plan[plan.index("Exchange hashpartitioning") :]
    assert {"title", "url", "delivery"}.isdisjoint(read_columns(plan))


def test_keyword_mart_shuffles_groups_not_rows(stored_tables, plan_of):
    plan = plan_of(marts.mart_keyword_daily(stored_tables["ranking"], unique_grain=True))
    assert shuffles(plan) == 1
    assert "partial_count" in plan[plan.index("Exchange hashpartitioning") :]
    exact = plan_of(marts.mart_keyword_daily(stored_tables["ranking"]))
    assert "Expand" not in exact and shuffles(exact) == 2


def test_brand_mart_drops_rows_before_the_join(stored_tables, plan_of):
    plan = plan_of(marts.mart_brand_competitive(stored_tables["performance"], stored_tables["dim"], True))
    assert "IsNotNull(product_sk)" in plan and "IsNotNull(brand)" in plan
    assert "LeftOuter" not in plan


def test_large_unused_page_fields_are_not_read(stored_tables, plan_of):
    columns = read_columns(plan_of(silver.clean_products(stored_tables["details"])))
    assert {"description", "variations"}.isdisjoint(columns) and "brand" in columns


def test_pages_and_their_history_take_one_shuffle(stored_tables, plan_of):
    pages = silver.clean_products(stored_tables["details"])
    for df in (pages, dimension.dim_history(pages), facts.performance_with_versions(pages)):
        plan = plan_of(df)
        assert shuffles(plan) == 1 and "Exchange hashpartitioning(asin" in plan
        below = plan[plan.index("Exchange hashpartitioning") :]
        assert not {"Sort [", "WindowGroupLimit", "sha2("} & set(re.findall(r"Sort \[|WindowGroupLimit|sha2\(", below))


def test_hashes_are_made_after_the_shuffle(spark, stored_tables, plan_of):
    details = spark.createDataFrame([], schemas.SILVER_DETAILS)
    for df in (dimension.dim_history(details), dimension.dim_history(details, stored_tables["dim"])):
        plan = plan_of(df)
        assert "sha2(" in plan and "sha2(" not in plan[plan.index("Exchange hashpartitioning") :]


def test_lookup_forces_no_broadcast(stored_tables):
    df = facts.fact_search_ranking(stored_tables["search"], stored_tables["dim"])
    assert "broadcast" not in df._jdf.queryExecution().optimizedPlan().toString().lower()


def test_day_filter_reaches_the_scan(spark, stored_tables, plan_of, tmp_path):
    path = str(tmp_path / "mart")
    mart = stored_tables["keywords"]
    rows = spark.range(3).selectExpr(
        *[
            f"cast({'id' if n == 'total_products' else 'null'} as {t}) as {n}"
            for n, t in mart.dtypes
            if n != "ingested_at"
        ],
        "date_add(date'2026-03-04', cast(id as int)) as ingested_at",
    )
    tables.publish_days(rows, path, schemas.MART_KEYWORD_DAILY, "2026-03-04", "2026-03-06")
    plan = plan_of(research.keyword_topk(tables.read_days(spark, path, schemas.MART_KEYWORD_DAILY), "2026-03-05", 5))
    assert "TakeOrderedAndProject" in plan
    assert re.search(r"PartitionFilters: \[.*ingested_at.* = 2026-03-05", plan)


def test_current_versions_come_from_their_own_folder(spark, stored_tables, plan_of, tmp_path):
    path = str(tmp_path / "dim")
    for day in ("2026-03-04", "2026-03-05"):
        dim_store.write_run(spark, spark.createDataFrame(one_version(day), schemas.DIM_PRODUCT), path, day)
    current = dim_store.read_dim(spark, path).filter("is_current")
    assert [str(r.effective_date) for r in current.collect()] == ["2026-03-05"]
    assert re.search(r"PartitionFilters: \[.*is_current", plan_of(current))


def one_version(day):
    import datetime

    start = datetime.date.fromisoformat(day)
    values = {"product_sk": day, "asin": "a", "marketplace": "US", "effective_date": start, "is_current": True}
    return [tuple(values.get(n) for n in schemas.column_names(schemas.DIM_PRODUCT))]


def test_typing_stays_in_generated_code(stored_tables, plan_of):
    for df in (silver.clean_search(stored_tables["bronze"]), silver.clean_products(stored_tables["details"])):
        assert "Python" not in plan_of(df)


def pages_of_days(spark):
    """Pages of nine products in two marketplaces, a few without a product, unique per product and day."""
    filled = {
        "asin": "if(id % 50 = 7, null, concat('a', id % 9))",
        "marketplace": "if(id % 2 = 0, 'US', 'DE')",
        "ingested_at": "date_add(date'2026-03-01', cast(id div 18 as int))",
        "title": "concat('t', id div 54)",
        "brand": "if(id % 9 = 4, null, concat('B', id % 3))",
        "category_leaf": "if(id % 9 = 5, null, concat('L', id % 2))",
        "best_seller_ranks": "array(named_struct('rank', cast(id % 7 as int), 'category', 'c'))",
        "variation_count": "cast(id div 72 as int)",
        "is_fba": "id % 5 = 0",
        "rating_weighted_avg": "id / 10",
    }
    kinds = schemas.parse(schemas.SILVER_DETAILS)
    return spark.range(400).selectExpr(*[f"cast({filled.get(f.name, 'null')} as {f.dataType.simpleString()}) as {f.name}" for f in kinds])


def content(df):
    return sorted(df.drop("gold_processed_at").collect(), key=str)


def stored_history(spark, folder):
    details = tables.stored_by(pages_of_days(spark), f"{folder}/pages", dimension.KEYS)
    return details, tables.stored_by(dimension.dim_history(details), f"{folder}/dim", dimension.KEYS)


def test_lookup_in_tables_stored_by_product_takes_no_shuffle(spark, tmp_path, plan_of):
    details, dim = stored_history(spark, tmp_path)
    fact = facts.fact_product_performance(details, dim, "asof")
    assert shuffles(plan_of(dimension.dim_history(details))) == 0 and shuffles(plan_of(fact)) == 0
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("stored_")]

    plain = pages_of_days(spark).localCheckpoint()
    versions = dimension.dim_history(plain)
    assert content(dim) == content(versions.select(*dim.columns))
    assert content(fact) == content(facts.performance_with_versions(plain).select(*fact.columns))
    assert content(fact) == content(facts.fact_product_performance(plain, versions, "asof"))
    assert 0 < fact.filter("product_sk is null").count() < fact.count() == 400


def test_brand_mart_of_tables_stored_by_product_shuffles_groups_only(spark, tmp_path, plan_of):
    details, dim = stored_history(spark, tmp_path)
    fact = facts.fact_product_performance(details, dim, "asof")
    mart = marts.mart_brand_competitive(fact, dim, unique_grain=True)
    plan = plan_of(mart)
    assert shuffles(plan) == 1 and "partial_count" in plan[plan.index("Exchange hashpartitioning") :] and "Broadcast" not in plan

    joined = fact.join(dim.select("product_sk", "brand", "category_leaf"), "product_sk")
    assert content(mart) == content(marts.brand_figures(joined, unique_grain=True)) != []
    plain = marts.mart_brand_competitive(fact.localCheckpoint(), dim.localCheckpoint(), unique_grain=True)
    assert content(plain) == content(mart)
