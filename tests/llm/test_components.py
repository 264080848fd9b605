"""Connected components of link tables, and the work that small ones cost."""

import random

import pytest

from marketlake.llm.components import components, merged


def plain(links):
    """Smallest node of each linked node's component."""
    label = {x: x for link in links for x in link}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= (label[a], label[b]) != (low, low)
            label[a] = label[b] = low
    return label


@pytest.fixture
def many_partitions(spark):
    """As many shuffle partitions as a large cluster has, none put together while a query runs."""
    conf = {"spark.sql.shuffle.partitions": "211", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_components_and_merged(spark, stored):
    draw = random.Random(7)
    first = [(draw.randrange(-90, 90), draw.randrange(-90, 90)) for _ in range(60)] + [(100, k) for k in range(101, 140)] + [(3, 3), (1, 2), (1, 2)]
    later = [(draw.randrange(-90, 300), draw.randrange(-90, 300)) for _ in range(40)]
    first_links, later = ([(min(x), max(x)) for x in part if x[0] != x[1]] for part in (first, later))
    classes = stored(rows(components(spark.createDataFrame(first, "a long, b long"))), "node long, label long", "classes")
    assert rows(classes) == sorted(plain(first_links).items())
    more = stored(later, "a long, b long", "more")
    assert rows(merged(classes, more)) == sorted(plain(first_links + later).items())
    assert rows(merged(classes, more.where("a > b"))) == rows(classes)


def test_no_links(spark):
    none = spark.createDataFrame([], "a long, b long")
    assert rows(components(none)) == []


def test_small_tables_take_few_tasks(spark, stored, many_partitions):
    """Rounds took a task for each shuffle partition and stage, which the driver pays for, whatever they hold."""
    links = stored([(k, k + 1) for k in range(60)] + [(500, k) for k in range(501, 900)], "a long, b long")
    spark.sparkContext.setJobGroup("small-components", "")
    try:
        got = components(links)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    status = spark.sparkContext.statusTracker()
    tasks = [status.getStageInfo(s).numTasks for j in status.getJobIdsForGroup("small-components") for s in status.getJobInfo(j).stageIds if status.getStageInfo(s)]
    assert tasks and max(tasks) < 50 and sum(tasks) < 2000, (max(tasks), sum(tasks))
    assert rows(got) == sorted([(k, 0) for k in range(61)] + [(k, 500) for k in range(500, 900)])
