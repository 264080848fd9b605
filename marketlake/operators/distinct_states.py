"""Exact distinct counts that combine: bitmaps of numbered values, per group and bucket of numbers.

A value gets a number once and for ever. The values of a group are then bits of fixed-size bitmaps, which are OR-ed: over rows in
every map task before the shuffle, and over days when a range of days is asked. A hot group sends a few bitmaps per task
instead of its rows, and the count of any union of days comes from the states alone.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The place of a row in its partition, and the partition, in monotonically_increasing_id().
PLACE_BITS = 33


def with_places(values: DataFrame) -> DataFrame:
    """The rows with ``place``, which ``numbered`` turns into a number: write this, so that places are settled."""
    return values.withColumn("place", F.monotonically_increasing_id())


def numbered(placed: DataFrame, first: int) -> DataFrame:
    """The rows of ``with_places``, written and read back, numbered without gaps from ``first`` on.

    Only the number of rows of each partition is summed in one task.
    """
    part = F.shiftright("place", PLACE_BITS)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("part", (F.coalesce(before, F.lit(0)) + F.lit(first)).alias("start"))
    number = F.col("start") + F.col("place").bitwiseAND((1 << PLACE_BITS) - 1)
    return placed.withColumn("part", part).join(sizes, "part").withColumn("number", number).drop("part", "start", "place")


def distinct_states(rows: DataFrame, group: list[str], number: str, state: str) -> DataFrame:
    """A bitmap per group and bucket of the numbers (from 0) found in ``rows``; NULL is not counted."""
    found = rows.filter(F.col(number).isNotNull())
    shifted = F.col(number) + 1  # bucket and position count from 1
    return found.groupBy(*group, F.bitmap_bucket_number(shifted).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(shifted)).alias(state))


def merged_counts(states: DataFrame, group: list[str], state: str, name: str) -> DataFrame:
    """Distinct values of each group over all states given, however they were cut."""
    whole = states.groupBy(*group, "bucket").agg(F.bitmap_or_agg(state).alias(state))
    return whole.groupBy(*group).agg(F.sum(F.bitmap_count(state)).alias(name))
