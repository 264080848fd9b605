"""Bounded training samples: of each group the texts with the smallest hashes, one row for each."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.scratch import stored

#: Of hashes in 53 bits, so many times the wanted number are ranked; a group's distinct hashes are counted to a few hundredths.
SPARE, SPARE_ROWS = 4, 50


def sampled(rows: DataFrame, group: str, per_group: int, seed: int, identity: list[str]) -> DataFrame:
    """Of each value of `group`, the rows whose hash of `identity` is among the `per_group` smallest distinct ones, with
    that hash as `key`; of rows alike in `identity`, one.

    A group with any row gives a row, and none gives more than `per_group`, however often rows or ids repeat. Hashes are
    written once; only those low enough to be among about SPARE times `per_group` distinct ones are ranked, so the ranking
    is as small for a group of any size.
    """
    key = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *identity), 11)
    narrow = stored(rows.select(group, key.alias("key")), "sample-keys")
    sizes = narrow.groupBy(group).agg(F.approx_count_distinct("key", 0.02).alias("_n"))
    low = narrow.join(F.broadcast(sizes), group)  # one row for each group
    low = low.where(F.col("key") <= F.lit(float(1 << 53)) * (SPARE * per_group + SPARE_ROWS) / F.col("_n")).select(group, "key").distinct()
    first = Window.partitionBy(group).orderBy("key")
    bound = low.withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_group).groupBy(group).agg(F.max("key").alias("_bound"))
    return rows.withColumn("key", key).join(F.broadcast(bound), group).where("key <= _bound").drop("_bound").dropDuplicates([group, "key"])


def fitted(sample: DataFrame, fit: Callable[[pa.Table], object]):
    """`fit` of a bounded sample, in one task; only the model, whose size its parameters bound, comes to the driver."""
    names = sample.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = list(batches)
        if got:
            model = fit(pa.Table.from_batches(got).rename_columns(names))
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    rows = sample.repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(rows[0]["model"]) if rows else None
