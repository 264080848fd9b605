"""Proportional stratified interleaving into shards of equal row counts.

Rows of a source are put in a seeded order, their rank is divided by the source's size, and all rows are sorted by that
fraction; cutting the sorted rows into equal runs gives every shard each source's share. Neither a source nor the whole
is sorted in one task: both ranks are taken in ordered bins (ranks.py).

Cases: a null source is a source of its own; a null text has no bytes; a null doc_id is ordered like any value. Identical
rows tie and are alike. An empty table gives an empty result; extra columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.ranks import bins, hash_bin, ranked
from marketlake.llm.scratch import stored

ROW_OVERHEAD = 8


def shard_rows(documents: DataFrame, shards: int = 24, seed: int = 17) -> DataFrame:
    """Shard and slot of each row, by the law that the shards' row counts differ by one at most."""
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = documents.select(
        "doc_id",
        F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), F.col("source"))).alias("src"),
        (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    slim = stored(slim.withColumn("h", F.xxhash64("doc_id", "size", "text_crc32", F.monotonically_increasing_id(), F.lit(seed))), "shard-rows")
    sources = slim.groupBy("src").agg(F.count("*").alias("n_src"))
    rows = slim.count()
    per_bin = bins(rows)
    drawn = ranked(slim, ["src"], hash_bin("h", per_bin), ["h", "doc_id"], "rank").join(sources, "src")
    drawn = drawn.withColumn("place", (F.col("rank") + 0.5) / F.col("n_src"))
    drawn = drawn.select("doc_id", "src", "size", "text_crc32", "h", "place", F.floor(F.col("place") * per_bin).alias("part"))
    placed = ranked(drawn, [], F.col("part"), ["place", "src", "h", "doc_id"], "row")
    shard = F.expr(f"row * {shards} div {max(rows, 1)}")
    begins = F.expr(f"(shard * {rows} + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("row") - begins).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
