"""Publishing by day."""

import os

import pytest
from pyspark.errors import PySparkException

from marketlake.sources import tables
from marketlake.sources.files import scratch_dir

SCHEMA = "k string, v int, ingested_at date"


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def rows(spark, *values):
    df = spark.createDataFrame(list(values), "k string, v int, ingested_at string")
    return df.selectExpr("k", "v", "cast(ingested_at as date) as ingested_at")


def content(spark, path, *days):
    return sorted((r.k, r.v) for r in tables.read_days(spark, path, SCHEMA, *days).collect())


def test_replaces_only_that_day(spark, path):
    first = rows(spark, ("a", 1, "2026-03-04"), ("b", 2, "2026-03-05"))
    assert tables.publish_days(first, path, SCHEMA, "2026-03-04", "2026-03-05") == 2
    day_one = f"{path}/ingested_at=2026-03-04"
    before = sorted(os.listdir(day_one))
    assert tables.publish_day(rows(spark, ("c", 3, "2026-03-05")), path, SCHEMA, "2026-03-05") == 1
    assert content(spark, path) == [("a", 1), ("c", 3)]
    assert sorted(os.listdir(day_one)) == before
    tables.publish_day(rows(spark, ("c", 3, "2026-03-05")), path, SCHEMA, "2026-03-05")
    assert content(spark, path) == [("a", 1), ("c", 3)]


def test_row_of_another_day_fails_and_changes_nothing(spark, path):
    tables.publish_day(rows(spark, ("a", 1, "2026-03-04")), path, SCHEMA, "2026-03-04")
    stray = rows(spark, ("x", 9, "2026-03-04"), ("y", 9, "2026-03-05"))
    with pytest.raises(PySparkException, match="row outside"):
        tables.publish_day(stray, path, SCHEMA, "2026-03-05")
    with pytest.raises(PySparkException, match="NULL"):
        tables.publish_day(rows(spark, ("z", 9, None)), path, SCHEMA, "2026-03-05")
    assert content(spark, path) == [("a", 1)]


def test_rebalanced_write_holds_every_row(spark, path):
    values = [(f"k{n}", n, "2026-03-04" if n % 3 else "2026-03-05") for n in range(300)]
    assert tables.publish_days(rows(spark, *values), path, SCHEMA, "2026-03-04", "2026-03-05", rebalance=True) == 300
    assert content(spark, path) == sorted((k, v) for k, v, _ in values)


def test_day_published_without_rows_is_emptied(spark, path):
    tables.publish_days(rows(spark, ("a", 1, "2026-03-04"), ("b", 2, "2026-03-05")), path, SCHEMA, "2026-03-04", "2026-03-05")
    assert tables.publish_day(rows(spark).limit(0), path, SCHEMA, "2026-03-04") == 0
    assert content(spark, path) == [("b", 2)]
    assert tables.publish_day(rows(spark).limit(0), path, SCHEMA, "2026-03-06") == 0
    assert content(spark, path) == [("b", 2)]


def test_only_covered_days_are_emptied(spark, path):
    days = [f"2026-03-0{n}" for n in (4, 5, 6)]
    tables.publish_days(rows(spark, *[(d[-1], 1, d) for d in days]), path, SCHEMA, days[0], days[2])
    again = rows(spark, ("x", 9, days[0]))
    assert tables.publish_days(again, path, SCHEMA, days[0], days[2], covered=days[:2]) == 1
    assert content(spark, path) == [("6", 1), ("x", 9)]


def test_schema_is_enforced(spark, path):
    df = rows(spark, ("a", 1, "2026-03-04")).withColumnRenamed("v", "w")
    with pytest.raises(ValueError, match="missing column v; unexpected column w"):
        tables.publish_day(df, path, SCHEMA, "2026-03-04")


def test_append_modes(spark, path):
    df = rows(spark, ("a", 1, "2026-03-04"))
    assert tables.append_day(df, path, SCHEMA) == 1
    tables.append_day(df, path, SCHEMA)
    assert content(spark, path) == [("a", 1), ("a", 1)]
    tables.append_day(df, path, SCHEMA, mode="overwrite")
    assert content(spark, path) == [("a", 1)]
    with pytest.raises(PySparkException):
        tables.append_day(df, path, SCHEMA, mode="error")
    assert tables.append_day(df.limit(0), path, SCHEMA) == 0
    with pytest.raises(ValueError, match="unknown write mode"):
        tables.append_day(df, path, SCHEMA, mode="merge")


def test_reading_a_day_lists_only_that_day(spark, path):
    values = [("a", 1, "2026-03-04"), ("b", 2, "2026-03-05"), ("c", 3, "2026-03-06")]
    tables.publish_days(rows(spark, *values), path, SCHEMA, "2026-03-04", "2026-03-06")
    day = tables.read_day(spark, path, SCHEMA, "2026-03-05")
    assert all("ingested_at=2026-03-05" in f for f in day.inputFiles())
    assert content(spark, path, "2026-03-05", "2026-03-06") == [("b", 2), ("c", 3)]
    assert tables.read_day(spark, path, SCHEMA, "2030-01-01").count() == 0
    assert tables.read_days(spark, f"{path}_absent", SCHEMA).count() == 0


def test_scratch_lies_in_the_shared_folder(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
