"""Product history: day by day, in one pass, reruns and late days."""

import random
from datetime import date, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from marketlake.functions.keys import sha_key
from marketlake.operators.quality import current_duplicates
from marketlake.operators.scd2 import as_new_versions, as_open_versions, first_after, scd2_history, scd2_splice, scd2_step, splice_changes, splice_keys, valid_between

KEYS, TRACKED = ["asin", "marketplace"], ["title", "brand"]
START = date(2026, 3, 4)
SNAPSHOT = "asin string, marketplace string, title string, brand string, image string, day date"


def versions(rows):
    """Daily rows as open versions with their key."""
    return as_new_versions(rows, TRACKED, F.col("day")).drop("day").withColumn("sk", sha_key(*KEYS, "effective_date"))


def fold(spark, rows, days):
    """Day after day, on collected rows in between, so that plans stay short."""
    schema = versions(rows).schema
    dim = spark.createDataFrame([], schema)
    for day in days:
        incoming = versions(rows.filter(F.col("day") == F.lit(day)))
        dim = spark.createDataFrame(scd2_step(dim, incoming, day, KEYS).select(*schema.names).collect(), schema)
    return dim


def as_set(dim):
    rows = [tuple(r) for r in dim.select(*sorted(dim.columns)).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def brief(dim):
    return sorted((r.asin, r.title, r.effective_date, r.expiry_date, r.is_current) for r in dim.collect())


def test_changed_title_gives_two_adjoining_versions(spark, stored):
    day2 = START + timedelta(days=1)
    rows = stored([("a", "US", "old", "b", "i", START), ("a", "US", "new", "b", "i", day2)], SNAPSHOT)
    expected = [("a", "new", day2, None, True), ("a", "old", START, START, False)]
    assert brief(fold(spark, rows, [START, day2])) == expected
    assert brief(scd2_history(versions(rows), KEYS)) == expected


def test_plain_attributes_fold_as_their_hashes_do(stored):
    days = [START + timedelta(days=n) for n in range(6)]
    titles = [None, "", "a~b", "a", "a", None]
    rows = [(asin, "US", t, "b" if t == "a~b" else "b~b", "i", d) for asin in ("a", None) for t, d in zip(titles, days, strict=True)]
    rows = stored(rows, SNAPSHOT)
    plain = scd2_history(as_open_versions(rows, F.col("day")).drop("day"), KEYS, TRACKED).withColumn("sk", sha_key(*KEYS, "effective_date"))
    assert as_set(plain) == as_set(scd2_history(versions(rows), KEYS)) and plain.count() == 3 + 6


def test_untracked_change_and_absence_leave_the_version_alone(spark, stored):
    day2 = START + timedelta(days=1)
    rows = stored(
        [("a", "US", "t", "b", "i1", START), ("a", "US", "t", "b", "i2", day2), ("gone", "US", "t", "b", "i", START)],
        SNAPSHOT,
    )
    dim = fold(spark, rows, [START, day2])
    assert brief(dim) == [("a", "t", START, None, True), ("gone", "t", START, None, True)]
    assert dim.filter("asin = 'a'").first().image == "i1"


def test_same_product_in_two_marketplaces(spark, stored):
    rows = stored([("a", "US", "t", "b", "i", START), ("a", "DE", "u", "b", "i", START)], SNAPSHOT)
    assert fold(spark, rows, [START]).filter("is_current").count() == 2


def test_return_to_an_old_title_is_a_third_version(spark, stored):
    days = [START + timedelta(days=n) for n in range(3)]
    rows = stored([("a", "US", t, "b", "i", d) for t, d in zip(["x", "y", "x"], days)], SNAPSHOT)
    assert scd2_history(versions(rows), KEYS).count() == fold(spark, rows, days).count() == 3


def random_snapshots(seed, days):
    rng = random.Random(seed)
    rows = []
    for n in range(40):
        asin, marketplace = (None if n == 0 else f"a{n}"), (None if n == 1 else rng.choice(["US", "DE"]))
        for day in days:
            if rng.random() < 0.7:
                title, brand = rng.choice(["t1", "t2", "t3"]), rng.choice(["b", "b", None])
                rows.append((asin, marketplace, title, brand, f"i{rng.random()}", day))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_one_pass_equals_the_fold(spark, stored, seed):
    days = [START + timedelta(days=n) for n in range(6)]
    rows = stored(random_snapshots(seed, days), SNAPSHOT)
    folded, history = fold(spark, rows, days), scd2_history(versions(rows), KEYS)
    assert as_set(folded) == as_set(history)
    keyed = history.dropna(subset=KEYS)
    assert current_duplicates(keyed, KEYS).count() == 0
    for day in days:
        valid = valid_between(keyed, day, day)
        assert valid.count() == valid.select(*KEYS).distinct().count()


def test_rerun_of_a_day_replaces_that_day(spark, stored):
    days = [START + timedelta(days=n) for n in range(3)]
    rows = stored(random_snapshots(5, days), SNAPSHOT)
    dim = fold(spark, rows, days)
    again = scd2_step(dim, versions(rows.filter(F.col("day") == F.lit(days[-1]))), days[-1], KEYS)
    assert as_set(again) == as_set(dim)
    corrected = rows.filter(F.col("day") == F.lit(days[-1])).withColumn("title", F.lit("corrected"))
    redone = scd2_step(dim, versions(corrected), days[-1], KEYS)
    expected = scd2_step(fold(spark, rows, days[:-1]), versions(corrected), days[-1], KEYS)
    assert as_set(redone) == as_set(expected)


def test_older_day_is_refused(spark, stored):
    day2 = START + timedelta(days=1)
    rows = stored([("a", "US", "t", "b", "i", day2)], SNAPSHOT)
    dim = fold(spark, rows, [day2])
    with pytest.raises(ValueError, match="later than"):
        scd2_step(dim, versions(rows), START, KEYS)


def test_later_version_in_a_file_of_its_own_is_refused(spark, stored, tmp_path):
    days = [START, START + timedelta(days=4), START + timedelta(days=8)]
    rows = stored([(f"a{n}", "US", "t", "b", "i", d) for n, d in enumerate(days)], SNAPSHOT)
    for n in (0, 2):
        only = rows.filter(F.col("day") == F.lit(days[n]))
        fold(spark, only, [days[n]]).coalesce(1).write.mode("append").parquet(str(tmp_path / "dim"))
    dim = spark.read.parquet(str(tmp_path / "dim"))
    with pytest.raises(ValueError, match="later than"):
        scd2_step(dim, versions(rows.filter(F.col("day") == F.lit(days[1]))), days[1], KEYS)


def spliced(dim, rows, day):
    """`dim` with the day's rows put in; `rows` are all days as they now are."""
    snapshots = versions(rows)
    incoming = snapshots.filter(F.col("effective_date") == F.lit(day))
    following = first_after(snapshots, day, KEYS, splice_keys(dim, incoming, day, KEYS))
    return scd2_splice(dim, incoming, following, day, KEYS), splice_changes(dim, incoming, following, day, KEYS)


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_a_late_day_gives_the_history_of_all_days(spark, stored, seed):
    days = [START + timedelta(days=2 * n) for n in range(6)]
    rows = stored(random_snapshots(seed, days), SNAPSHOT, "all")
    for n, day in enumerate(days):
        without = rows.filter(F.col("day") != F.lit(day))
        dim = spark.createDataFrame(scd2_history(versions(without), KEYS).collect(), versions(rows).schema)
        assert as_set(spliced(dim, rows, day)[0]) == as_set(scd2_history(versions(rows), KEYS)), n


@pytest.mark.parametrize("seed", [5, 6])
def test_a_day_that_comes_again_takes_its_old_rows_place(spark, stored, seed):
    """Rows of the day change, vanish and appear; also a day without any row left."""
    days = [START + timedelta(days=n) for n in range(5)]
    old = stored(random_snapshots(seed, days), SNAPSHOT, "old")
    dim = spark.createDataFrame(scd2_history(versions(old), KEYS).collect(), versions(old).schema)
    other = stored(random_snapshots(seed + 10, days), SNAPSHOT, "other")
    for day in days:
        for now in (other.filter(F.col("day") == F.lit(day)), other.limit(0)):
            rows = old.filter(F.col("day") != F.lit(day)).unionByName(now)
            assert as_set(spliced(dim, rows, day)[0]) == as_set(scd2_history(versions(rows), KEYS))


def test_a_late_day_touches_only_versions_that_change(spark, stored):
    days = [START + timedelta(days=n) for n in range(5)]
    rows = [(a, "US", "t" if n < 4 else "end", "b", "i", d) for a in ("same", "split", "new", "far") for n, d in enumerate(days) if n != 2]
    rows = [r for r in rows if r[0] != "new"] + [("same", "US", "t", "b", "late", days[2]), ("split", "US", "x", "b", "i", days[2]), ("new", "US", "n", "b", "i", days[2])]
    rows = stored(rows, SNAPSHOT)
    dim = scd2_history(versions(rows.filter(F.col("day") != F.lit(days[2]))), KEYS)
    dim = spark.createDataFrame(dim.collect(), dim.schema)
    changed = spliced(dim, rows, days[2])[1].collect()
    assert {r.asin for r in changed} == {"split", "new"}
    shown = sorted((r.asin, r.title, r.effective_date, r.expiry_date, r.removed) for r in changed)
    assert shown == [
        ("new", "n", days[2], None, False),
        ("split", "t", days[0], days[1], False),
        ("split", "t", days[0], days[3], True),
        ("split", "t", days[3], days[3], False),
        ("split", "x", days[2], days[2], False),
    ]


def test_rows_without_a_key_do_not_meet_in_one_window(spark, stored):
    rows = stored([(None, "US", "t", "b", "i", START)] * 50 + [("a", None, "t", "b", "i", START)] * 50, SNAPSHOT)
    history = scd2_history(versions(rows), KEYS)
    assert history.count() == 100 and history.filter("is_current").count() == 100
