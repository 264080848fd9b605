"""Connected groups of a table of links, by hooking and pointer jumping."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.sources.files import scratch_dir


def connected_groups(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, label) of every node; linked nodes share a label, the smallest node of their group.

    ``links`` has columns ``a`` and ``b``. In a round every node takes the smallest label next to it, and then the label of
    its label, so labels cross a chain in a number of rounds that grows with the logarithm of its length. Neighbours are
    combined to a minimum before the shuffle, never gathered. Every round is a written table.
    """
    both = _written(links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct())
    labels = _written(nodes.select("node", F.col("node").alias("label")).distinct())
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        hooked = labels.join(near, "node", "left").select("node", F.col("label").alias("before"), F.least("label", F.coalesce("near", "label")).alias("label"))
        hooked = _written(hooked)
        jump = hooked.select(F.col("node").alias("label"), F.col("label").alias("further"))
        now = _written(hooked.join(jump, "label").select("node", "before", F.least("label", "further").alias("label")))
        if now.filter("label <> before").isEmpty():
            return now.select("node", "label")
        labels = now.select("node", "label")


def _written(df: DataFrame) -> DataFrame:
    path = scratch_dir(df.sparkSession, "groups")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
