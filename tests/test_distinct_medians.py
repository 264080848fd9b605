"""Distinct counts from states, exact medians, and ranks of several metrics in one chain."""

import random
import statistics
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from marketlake.operators.distinct_states import distinct_states, merged_counts, numbered, with_places
from marketlake.operators.medians import exact_medians
from marketlake.operators.ranks import percent_ranks
from marketlake.plans import distinct_days

FIRST = date(2026, 3, 4)
FACT = "keyword string, marketplace string, asin string, ingested_at date"


def made(seed, days=4, rows=3000):
    rng = random.Random(seed)
    out = [(rng.choice(["hot", "hot", "k1", "k2", None]), rng.choice(["US", "DE"]), rng.choice([None, *[f"P{k}" for k in range(700)]]), FIRST + timedelta(days=rng.randrange(days))) for _ in range(rows)]
    return out + [("wide", "US", f"W{k}", FIRST) for k in range(40_000)]


def wanted(rows, start, end):
    found = {}
    for keyword, marketplace, asin, day in rows:
        if asin is not None and start <= day <= end:
            found.setdefault((keyword, marketplace), set()).add(asin)
    return {k: len(v) for k, v in found.items()}


def test_products_over_any_days(spark, stored, tmp_path):
    rows = made(1)
    fact, root = stored(rows, FACT), str(tmp_path / "states")
    days = [FIRST + timedelta(days=n) for n in range(4)]
    for start, end in ((days[1], days[2]), (days[0], days[0]), (days[3], days[3]), (days[0], days[1])):
        distinct_days.record_products(spark, fact, root, str(start), str(end))
    numbers = distinct_days.product_numbers(spark, root)
    own = {r[2] for r in rows if r[2] is not None}
    assert sorted(r.number for r in numbers.collect()) == list(range(len(own))) and {r.asin for r in numbers.collect()} == own
    for start in days:
        for end in days:
            found = {(r.keyword, r.marketplace): r.total_products for r in distinct_days.keyword_products(spark, root, str(start), str(end)).collect()}
            assert found == wanted(rows, start, end)


def test_a_day_recorded_again_loses_what_it_no_longer_has(spark, stored, tmp_path):
    root = str(tmp_path / "states")
    for rows in ([("k", "US", "a", FIRST), ("k", "US", "b", FIRST), ("gone", "US", "a", FIRST)], [("k", "US", "c", FIRST)]):
        distinct_days.record_products(spark, stored(rows, FACT, str(len(rows))), root, str(FIRST), str(FIRST))
    assert [tuple(r) for r in distinct_days.keyword_products(spark, root, str(FIRST), str(FIRST)).collect()] == [("k", "US", 1)]
    assert distinct_days.keyword_products(spark, root, "2020-01-01", "2020-01-02").count() == 0


def test_states_combine_before_the_shuffle(spark, plan_of):
    rows = spark.range(100_000).select(F.lit("hot").alias("k"), (F.col("id") % 50_000).alias("number"))
    states = distinct_states(rows, ["k"], "number", "s")
    assert states.count() == 2 and merged_counts(states, ["k"], "s", "n").first().n == 50_000
    plan = plan_of(states)
    assert plan.count("Exchange hashpartitioning") == 1 and plan.index("partial_bitmap_construct_agg") > plan.index("Exchange hashpartitioning")


def test_numbers_have_no_gaps(spark, tmp_path):
    with_places(spark.range(1000).repartition(7).filter("id % 3 <> 0")).write.parquet(str(tmp_path / "placed"))
    rows = numbered(spark.read.parquet(str(tmp_path / "placed")), 50).collect()
    assert sorted(r.number for r in rows) == list(range(50, 50 + len(rows)))


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_medians(stored, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", None]), rng.choice([None, -3.5, 0.0, round(rng.uniform(-9, 1e6), 2)])) for _ in range(500)]
    rows += [("hot", float(k)) for k in range(20_001)] + [("hot", 7.0)] * 9000 + [("one", 5.0), ("none", None)] + [("two", 1.0), ("two", 2.0)]
    found = {r.g: r.m for r in exact_medians(stored(rows, "g string, v double"), ["g"], "v", "m").collect()}
    values = {}
    for g, v in rows:
        if v is not None:
            values.setdefault(g, []).append(v)
    assert found == {g: statistics.median_low(v) for g, v in values.items()}


def test_ranks_of_several_metrics_share_one_chain(spark, stored, plan_of):
    rng = random.Random(3)
    rows = stored([(rng.choice(["a", "b", None]), rng.choice([None, 1, 2, 50]), rng.uniform(-5, 5), [k]) for k in range(300)], "g string, x int, y double, tags array<int>")
    ranked = percent_ranks(rows, ["g"], ["x", "y"])
    want = rows.selectExpr("*", *[f"percent_rank() over (partition by g order by coalesce(cast({m} as double), 0.0)) as {m}_rank" for m in "xy"])
    assert ranked.columns == want.columns and sorted(map(str, ranked.collect())) == sorted(map(str, want.collect()))
    shuffles = [plan_of(percent_ranks(rows, ["g"], m)).count("Exchange hashpartitioning") for m in (["x"], ["x", "y"])]
    assert shuffles[0] == shuffles[1]
