"""Synonym groups against all pairs, chains of links, drift between days, demand over days without rows."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from marketlake.operators.groups import connected_groups
from marketlake.operators.quality import day_drift, day_histograms
from marketlake.plans import research, synonyms

FIRST = date(2026, 3, 1)


def grouped(nodes, links):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            least = min(label[a], label[b])
            if label[a] != least or label[b] != least:
                label[a] = label[b] = least
                changed = True
    return label


def plain_groups(cards, percent):
    shown = {}
    for keyword, marketplace, asin in cards:
        if None not in (keyword, marketplace, asin):
            shown.setdefault(keyword, set()).add((marketplace, asin))
    fame = {}
    for products in shown.values():
        for p in products:
            fame[p] = fame.get(p, 0) + 1
    weight = lambda products: sum(1_000_000 // fame[p] for p in products)
    names = sorted(shown)
    links = [(a, b) for a in names for b in names if a < b and 100 * weight(shown[a] & shown[b]) >= percent * weight(shown[a] | shown[b]) and shown[a] & shown[b]]
    return grouped(names, links)


@pytest.mark.parametrize(("seed", "percent"), [(1, 50), (2, 30), (3, 80)])
def test_synonyms_equal_all_pairs(spark, stored, seed, percent):
    """Sets that overlap in part, copies of a set, a keyword with a third of all rows, a product under every keyword."""
    rng = random.Random(seed)
    cards = []
    for k in range(40):
        base, name = k // 4 * 10, "".join(rng.choice("abcdefg") for _ in range(6)) + str(k)
        cards += [(name, "US", f"P{base + n}") for n in range(10) if rng.random() < 0.75] + [(name, "US", "everywhere")]
    cards += [(f"copy{n}", "DE", f"C{p}") for n in range(12) for p in range(3)]
    cards += [("hot", "US", f"H{n}") for n in range(300)] + [("hott", "US", f"H{n}") for n in range(200)] + [("near", "US", f"H{n}") for n in range(150, 300)]
    cards += [("none", None, "x"), (None, "US", "x"), ("none", "US", None)] + cards[:20]
    found = {r.keyword_normal: r.keyword_group for r in synonyms.keyword_synonyms(stored(cards, "keyword string, marketplace string, asin string"), percent).collect()}
    assert found == plain_groups(cards, percent)


def test_groups_of_long_chains(spark):
    rng = random.Random(4)
    nodes = [f"n{k:04d}" for k in rng.sample(range(5000), 900)]
    links = list(zip(nodes[:600], nodes[1:600], strict=False)) + [(nodes[700], nodes[k]) for k in range(701, 850)] + [(nodes[3], nodes[3])]
    found = connected_groups(spark.createDataFrame([(n,) for n in nodes], "node string"), spark.createDataFrame(links, "a string, b string"))
    assert {r.node: r.label for r in found.collect()} == grouped(nodes, links)


def test_only_shifted_days_drift(stored):
    rng = random.Random(5)
    rows = []
    for n in range(6):
        for _ in range(400):
            x = rng.gauss(10, 2) + (5 if n == 3 else 0)
            rows.append((FIRST + timedelta(days=2 * n), x, None if n == 5 else rng.uniform(0, 1)))
    histograms = day_histograms(stored(rows, "day date, x double, y double"), "day", {"x": [6.0, 8.0, 10.0, 12.0, 14.0], "y": [0.5]})
    assert {tuple(r.bins)[-1] for r in histograms.filter("column_name = 'y'").collect()} == {0, 400}
    found = {(r.column_name, (r.day - FIRST).days // 2): r for r in day_drift(histograms, "day").collect()}
    assert {k for k, r in found.items() if r.drifted} == {("x", 3), ("x", 4), ("y", 5)}
    assert found["x", 0].stability_index is None and found["x", 0].previous_day is None and found["y", 5].largest_gap == 1.0


def test_a_spike_followed_by_nothing_is_not_stable(stored):
    rows = [("steady", "US", FIRST + timedelta(days=n), 100) for n in range(30)] + [("spike", "US", FIRST, 1000), ("spike", "US", FIRST + timedelta(days=1), 1000)]
    rows += [("rising", "US", FIRST + timedelta(days=n), 10 * n) for n in range(0, 30, 1)] + [("late", "DE", FIRST + timedelta(days=29), None)]
    mart, last = stored(rows, "keyword string, marketplace string, ingested_at date, total_monthly_sales_min bigint"), F.lit(str(FIRST + timedelta(days=29))).cast("date")
    found = {r.keyword: r for r in research.demand_trend(mart, last).collect()}
    assert (found["steady"].slope_per_day, found["steady"].stddev_demand, found["steady"].stability_score) == (0.0, 0.0, None)
    assert found["rising"].slope_per_day == 10.0 and found["rising"].absent_days == 0
    spike = found["spike"]
    assert spike.absent_days == 28 and spike.calendar_days == 30 and spike.slope_per_day < 0 and spike.stability_score < 1 and spike.avg_demand == 66.67
    assert (found["late"].calendar_days, found["late"].slope_per_day, found["late"].avg_demand) == (1, None, 0.0)
    ranges = research.absent_ranges(mart, last)
    assert [(r.keyword, r.first_absent, r.last_absent) for r in ranges.collect()] == [("spike", FIRST + timedelta(days=2), FIRST + timedelta(days=29))]
    assert research.absent_days(ranges).count() == 28
