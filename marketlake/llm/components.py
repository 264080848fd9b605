"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.scratch import in_few_tasks, stored


def _star(edges: DataFrame, larger: bool, rows: int) -> DataFrame:
    """Each node's neighbours (the larger ones, or the smaller ones and itself) linked to its smallest neighbour."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if larger else edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = in_few_tasks(least.select("a", F.least("a", "m").alias("m")), rows)
    moved = in_few_tasks(both.join(least, "a"), rows)
    if larger:
        out = moved.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).where("a > b")
    return in_few_tasks(out.distinct(), rows)


def components(links: DataFrame) -> DataFrame:
    """(node, label) of all nodes that occur in `links` (a, b long); the label is the component's smallest node.

    Neighbours are joined to a minimum, not gathered, so a node of any degree is split over tasks. Rounds grow with the
    logarithm of the largest component; each is a written table, in as many tasks as its rows ask for.
    """
    edges = stored(links.select("a", "b").where("a <> b"), "edges", "lz4")
    before = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64(F.greatest("a", "b"), F.least("a", "b")).cast("decimal(38,0)"))).first()
        if not now[0] or now == before:
            break
        before = now
        edges = stored(_star(_star(edges, True, now[0]), False, now[0]), "edges", "lz4")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(in_few_tasks(edges.select("b", "b").distinct(), now[0]))


def merged(classes: DataFrame, links: DataFrame) -> DataFrame:
    """`classes` (node, label) as `components` gives them, those joined that further `links` (a, b) lead between.

    Only the classes that `links` meet are worked on. Both should be written tables, as they are read more than once.
    """
    if links.isEmpty():
        return classes
    for side in ("a", "b"):  # a node that is in no class yet is its own
        links = links.join(classes.select(F.col("node").alias(side), "label"), side, "left").withColumn(side, F.coalesce("label", side)).drop("label")
    above = stored(components(links), "classes", "lz4")
    inside = classes.join(above.select(F.col("node").alias("label"), F.col("label").alias("top")), "label", "left")
    return inside.select("node", F.coalesce("top", "label").alias("label")).union(above.join(classes, "node", "left_anti"))
