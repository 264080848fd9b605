"""Latest rows, key lookups, percent ranks and checks, against brute force on small fixtures."""

import random
from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.functions.numbers import settled
from marketlake.operators import quality
from marketlake.operators.dedup import dedup_latest, newest_first
from marketlake.operators.lookup import resolve_sk
from marketlake.operators.ranks import percent_ranks

DAY = date(2026, 3, 4)


# --- latest rows ----------------------------------------------------------------------------------------------


def latest(df, keys=("asin", "marketplace")):
    return dedup_latest(df, list(keys), newest_first("ts", ["source_file", "v"]))


ROWS = "asin string, marketplace string, ts string, source_file string, v int"


def test_latest_wins_and_null_time_loses(stored):
    rows = stored(
        [("a", "US", "2", "f1", 1), ("a", "US", "3", "f0", 2), ("a", "US", None, "f9", 3), ("b", "US", None, "f1", 4)],
        ROWS,
    )
    assert {r.v for r in latest(rows).collect()} == {2, 4}


def test_equal_times_fall_back_to_file_then_content(stored):
    rows = [("a", "US", "3", "f1", 1), ("a", "US", "3", "f2", 2), ("b", "US", "3", "f1", 5), ("b", "US", "3", "f1", 6)]
    forward, backward = stored(rows, ROWS), stored(rows[::-1], ROWS, "reversed")
    assert sorted(latest(forward).collect()) == sorted(latest(backward).collect())
    assert 2 in {r.v for r in latest(forward).collect()}


def test_marketplace_in_the_key_keeps_both(stored):
    rows = stored([("a", "US", "1", "f", 1), ("a", "DE", "2", "f", 2)], ROWS)
    assert latest(rows).count() == 2
    assert latest(rows, keys=["asin"]).count() == 1


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.sampled_from(["US", "DE", None]), st.integers(0, 3)), max_size=30))
def test_latest_is_one_row_per_key_and_idempotent(spark, keys):
    rows = spark.createDataFrame([(a, m, str(t), "f", i) for i, (a, m, t) in enumerate(keys)], ROWS)
    once = latest(rows)
    assert once.count() == len({(a, m) for a, m, _ in keys})
    assert sorted(map(str, latest(once).collect())) == sorted(map(str, once.collect()))


def test_latest_limits_rows_before_the_shuffle(stored, plan_of):
    plan = plan_of(latest(stored([("a", "US", "1", "f", 1)], ROWS)))
    exchange = plan.index("Exchange")
    assert "WindowGroupLimit" in plan[exchange:], "one row per key must leave each map task"


# --- key lookups ----------------------------------------------------------------------------------------------

DIM = "product_sk string, asin string, marketplace string, effective_date date, expiry_date date, is_current boolean"
CARD = "asin string, marketplace string, ingested_at date, v int"


def dim_rows():
    rows = []
    for n in range(20):
        for version in range(5):
            start = DAY + timedelta(days=3 * version + n % 3)
            end = None if version == 4 and n % 4 else start + timedelta(days=2)
            rows.append((f"sk{n}.{version}", f"a{n}", "US" if n % 2 else "DE", start, end, end is None))
    rows.append(("sk_null", None, "US", DAY, None, True))
    return rows


def brute_asof(cards, dim):
    out = []
    for asin, marketplace, day, v in cards:
        hits = [
            d[0] for d in dim
            if d[1] == asin and d[2] == marketplace and asin is not None and marketplace is not None
            and d[3] <= day and (d[4] is None or day <= d[4])
        ]
        assert len(hits) <= 1
        out.append((hits[0] if hits else None, asin, marketplace, day, v))
    return sorted(out, key=str)


def test_asof_lookup_equals_brute_force_with_a_hot_product(stored):
    rng = random.Random(7)
    cards = [
        ("a3" if rng.random() < 0.4 else rng.choice([None, *[f"a{n}" for n in range(25)]]), rng.choice(["US", "DE", None]),
         DAY + timedelta(days=rng.randint(-3, 25)), i)
        for i in range(600)
    ]
    dim = dim_rows()
    found = resolve_sk(stored(cards, CARD), stored(dim, DIM, "dim"), ["asin", "marketplace"], "asof")
    assert sorted(map(tuple, found.collect()), key=str) == brute_asof(cards, dim)


def test_current_lookup_keeps_unknown_products(stored):
    cards = stored([("a1", "US", DAY, 1), ("zz", "US", DAY, 2), (None, "US", DAY, 3)], CARD)
    found = resolve_sk(cards, stored(dim_rows(), DIM, "dim"), ["asin", "marketplace"])
    assert {r.v: r.product_sk for r in found.collect()} == {1: "sk1.4", 2: None, 3: None}


def test_asof_lookup_compares_no_ranges(stored, plan_of):
    cards, dim = stored([("a1", "US", DAY, 1)], CARD), stored(dim_rows(), DIM, "dim")
    plan = plan_of(resolve_sk(cards, dim, ["asin", "marketplace"], "asof"))
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and all("effective_date" not in line for line in joins)


def test_dimension_does_not_pass_through_the_driver(stored, plan_of):
    cards, dim = stored([("a1", "US", DAY, 1)], CARD), stored(dim_rows(), DIM, "dim")
    for mode, once in (("current", False), ("asof", False), ("asof", True)):
        assert "Broadcast" not in plan_of(resolve_sk(cards, dim, ["asin", "marketplace"], mode, unique_days=once))


def test_hot_product_is_split_over_tasks(spark, stored, plan_of):
    """A third of all cards on one product, beyond the broadcast limit."""
    settings_for_small_data = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    rows = 60_000
    cards = spark.range(rows).selectExpr(
        "if(id % 3 = 0, 'hot', concat('a', id % 500)) as asin", "'US' as marketplace",
        "date'2026-03-04' as ingested_at", "id as v",
    )
    dim = stored([(f"sk{a}", a, "US", DAY, None, True) for a in ["hot", *[f"a{n}" for n in range(500)]]], DIM)
    for key, value in settings_for_small_data.items():
        spark.conf.set(key, value)
    try:
        found = resolve_sk(cards.repartition(16), dim, ["asin", "marketplace"]).persist()
        assert found.filter("product_sk = concat('sk', asin)").count() == rows
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        found.unpersist()
        for key in settings_for_small_data:
            spark.conf.unset(key)


def test_unknown_lookup_mode(stored):
    cards, dim = stored([("a1", "US", DAY, 1)], CARD), stored(dim_rows(), DIM, "dim")
    with pytest.raises(ValueError, match="mode"):
        resolve_sk(cards, dim, ["asin", "marketplace"], "latest")


# --- percent ranks --------------------------------------------------------------------------------------------


def test_percent_ranks_equal_the_window(stored):
    rng = random.Random(3)
    rows = [
        (i, rng.choice(["US", "US", "US", "DE", None]), rng.choice([None, 0.0, 0.0, -5.5, rng.randint(0, 9) / 4, rng.random() * 1e6]),
         rng.choice([0, 0, 0, rng.randint(0, 10**9)]))
        for i in range(2000)
    ] + [(9999, "alone", 3.0, 3)]
    df = stored(rows, "i int, market string, score double, n bigint")
    ranked = percent_ranks(df, ["market"], ["score", "n"])
    for metric in ("score", "n"):
        window = Window.partitionBy("market").orderBy(F.coalesce(F.col(metric).cast("double"), F.lit(0.0)))
        expected = df.select("i", F.percent_rank().over(window).alias("r"))
        assert {r.i: r.r for r in expected.collect()} == {r.i: r[f"{metric}_rank"] for r in ranked.collect()}


def test_percent_ranks_never_sort_a_whole_group(stored, plan_of):
    df = stored([(1, "US", 2.0)], "i int, market string, score double")
    windows = [x for x in plan_of(percent_ranks(df, ["market"], ["score"])).splitlines() if "Window [" in x]
    assert windows
    for line in windows:
        assert "bucket" in line, line


# --- checks ---------------------------------------------------------------------------------------------------


def test_quality_profile(stored):
    df = stored([(1, None, 5.0), (2, "x", 7.0), (None, "y", None)], "a int, b string, c double")
    out = {r.column_name: r for r in quality.quality_profile(df, {"c": (0, 6)}).collect()}
    assert (out["a"].null_rows, out["b"].null_rows, out["c"].null_rows) == (1, 1, 1)
    assert (out["c"].out_of_range_rows, out["a"].out_of_range_rows) == (1, None)
    assert out["a"].null_rate == 0.3333 and out["a"].total_rows == 3


def test_quality_profile_of_nothing(spark):
    out = quality.quality_profile(spark.createDataFrame([], "a int"), {}).collect()
    assert [(r.total_rows, r.null_rows, r.null_rate) for r in out] == [(0, 0, None)]


def test_current_duplicates(stored):
    rows = [("s1", "a", "US", DAY, None, True), ("s2", "a", "US", DAY, None, True), ("s3", "b", "US", DAY, None, True)]
    out = quality.current_duplicates(stored(rows, DIM), ["asin", "marketplace"]).collect()
    assert [tuple(r) for r in out] == [("a", "US", 2)]


def test_null_keys(stored):
    out = quality.null_keys(stored([("a", "US", DAY, 1), (None, "US", None, 2)], CARD), ["asin", "ingested_at"])
    assert {r.key_column: r.null_rows for r in out.collect()} == {"asin": 1, "ingested_at": 1}


def test_schema_differences(spark):
    df = spark.createDataFrame([], "keyword string, marketplace int, extra int")
    found = quality.schema_differences(df, schemas.parse("keyword string, marketplace string, day date"))
    assert found == ["missing column day", "unexpected column extra", "marketplace is int, declared string"]


def test_settled_does_not_depend_on_the_order_of_addition(stored):
    rows = stored([(10.005,), (10.004999999999999,), (10.0050000000001,), (None,)], "x double")
    assert [r[0] for r in rows.select(settled(F.col("x"), 2)).collect()] == [10.01, 10.01, 10.01, None]


