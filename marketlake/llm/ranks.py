"""Ranks of rows without one task per key: rows are cut into ordered bins, ranked in a bin, and shifted by the bins before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BIN = 10_000


def bins(rows: int) -> int:
    """A power of two, so that evenly dealt rows come to about ROWS_PER_BIN a bin."""
    return 1 << max(0, (rows // ROWS_PER_BIN).bit_length())


def hash_bin(column: str, count: int) -> Column:
    """The bin of an evenly spread 64-bit value, in its unsigned order; `count` is a power of two."""
    bits = count.bit_length() - 1
    return F.shiftrightunsigned(F.col(column), 64 - bits) if bits else F.lit(0).cast("long")


def ranked(df: DataFrame, keys: list[str], bin_: Column, order: list[str], name: str) -> DataFrame:
    """`df` with the rank from 0 within `keys` (none null) by bin and then `order`.

    A key of any size is split over its bins; only counts by key and bin are summed in order.
    """
    df = df.withColumn("_bin", bin_)
    counts = df.groupBy(*keys, "_bin").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*keys, "_bin", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*keys, "_bin").orderBy(*order)
    out = df.join(counts, [*keys, "_bin"])
    return out.withColumn(name, F.col("_before") + F.row_number().over(inside) - 1).drop("_bin", "_before")
