"""Exact medians of groups of any size, all groups at once."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.operators.ranks import join_null_safe, running_before, value_bucket


def exact_medians(df: DataFrame, group: list[str], value: str, name: str, share: float = 0.5) -> DataFrame:
    """The smallest value of each group that ``share`` of the group's values do not exceed; NULL values do not count.

    Selection in two passes. Equal values are counted first, combined before the shuffle, so a hot value is one row. Counts
    of ordered buckets tell which bucket holds the middle; only that bucket's values are then put in order. No task sorts
    a whole group: the first pass orders a group's buckets, whose number depends on the range of values only, the second
    the values of one bucket.
    """
    amount = F.col(value).cast("double")
    counts = df.filter(amount.isNotNull()).groupBy(*group, amount.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("bucket", value_bucket(F.col("value")))
    whole = Window.partitionBy(*group)
    buckets = counts.groupBy(*group, "bucket").agg(F.sum("n").alias("rows"))
    buckets = buckets.withColumn("below", running_before("rows", whole.orderBy("bucket"))).withColumn("wanted", F.ceil(F.sum("rows").over(whole) * share))
    middle = buckets.filter((F.col("below") < F.col("wanted")) & (F.col("wanted") <= F.col("below") + F.col("rows")))
    inside = join_null_safe(counts, middle.select(*group, "bucket", "below", "wanted"), [*group, "bucket"])
    before = running_before("n", Window.partitionBy(*group, "bucket").orderBy("value"))
    reached = inside.withColumn("before", F.col("below") + before)
    found = (F.col("before") < F.col("wanted")) & (F.col("wanted") <= F.col("before") + F.col("n"))
    return reached.filter(found).select(*group, F.col("value").alias(name))
