"""Keywords that mean the same, found by the products they show."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.operators.groups import connected_groups
from marketlake.operators.ranks import running_before
from marketlake.plans.research import normal_keyword
from marketlake.sources.files import scratch_dir

# A product shown under n keywords weighs WHOLE div n in each: one shown everywhere says little.
WHOLE = 1_000_000
# Bins of the products that are shown under equally many keywords, so that no task orders all products of a keyword.
BINS = 64


def keyword_synonyms(cards: DataFrame, min_percent: int = 50) -> DataFrame:
    """``keyword_normal`` with its ``keyword_group``, the smallest keyword of its connected group, for ``dim_keyword``.

    Two keywords are linked when the products shown under both weigh at least ``min_percent`` of those shown under either.
    Keywords with the same products are one set from the start. Of a set only the rarest products are joined, as many as
    any linked set must meet (the rest weighs too little by itself), and only sets of similar weight are paired; what both
    show is then added up for these pairs. ``cards`` needs ``keyword``, ``marketplace`` and ``asin``.
    """
    product = F.struct("marketplace", "asin").alias("product")
    shown = cards.dropna(subset=["keyword", "marketplace", "asin"])
    shown = _written(shown.select(normal_keyword(F.col("keyword")).alias("keyword"), product).distinct())
    fame = shown.groupBy("product").agg(F.count(F.lit(1)).alias("fame"))
    shown = _written(shown.join(fame, "product").withColumn("weight", F.expr(f"{WHOLE} div fame")))
    code = [F.xxhash64(F.lit(n), "product.marketplace", "product.asin") for n in (1, 2)]
    sets = shown.groupBy("keyword").agg(F.sum("weight").alias("total"), F.count(F.lit(1)).alias("n"), *[F.bit_xor(c).alias(f"code{n}") for n, c in enumerate(code)])
    alike = ["n", "code0", "code1", "total"]
    first = sets.groupBy(*alike).agg(F.min("keyword").alias("a"))
    sets = _written(sets.join(first, alike).select("a", F.col("keyword").alias("b"), "total"))
    own = _written(shown.join(sets.filter("a = b").select(F.col("a").alias("keyword"), "total"), "keyword"))
    links = _similar(own, min_percent).union(sets.filter("a <> b").select("a", "b"))
    groups = connected_groups(sets.select(F.col("b").alias("node")), links)
    return groups.select(F.col("node").alias("keyword_normal"), F.col("label").alias("keyword_group"))


def _similar(own: DataFrame, min_percent: int) -> DataFrame:
    """Pairs of sets that are similar enough."""
    rare = _rarest(own, min_percent)
    left = rare.select("product", F.col("keyword").alias("a"), F.col("total").alias("total_a"))
    right = rare.select("product", F.col("keyword").alias("b"), F.col("total").alias("total_b"))
    near = (100 * F.least("total_a", "total_b") >= min_percent * F.greatest("total_a", "total_b")) & (F.col("a") < F.col("b"))
    pairs = _written(left.join(right, "product").filter(near).select("a", "b", "total_a", "total_b").distinct())
    of_a = pairs.join(own.select(F.col("keyword").alias("a"), "product", "weight"), "a")
    both = of_a.join(own.select(F.col("keyword").alias("b"), "product"), ["b", "product"])
    shared = both.groupBy("a", "b", "total_a", "total_b").agg(F.sum("weight").alias("shared"))
    return shared.filter(100 * F.col("shared") >= min_percent * (F.col("total_a") + F.col("total_b") - F.col("shared"))).select("a", "b")


def _rarest(own: DataFrame, min_percent: int) -> DataFrame:
    """Of each set, in order of rarity, the products from which on the rest still weighs ``min_percent`` of the whole.

    Sets are alike only if their first common product is among these in both. A set's products are ordered in bins.
    """
    binned = own.withColumn("bin", F.pmod(F.xxhash64("product.asin", "product.marketplace"), F.lit(BINS)).cast("int"))
    key = ["keyword", "fame", "bin"]
    bins = binned.groupBy(*key).agg(F.sum("weight").alias("bin_weight"))
    earlier = running_before("bin_weight", Window.partitionBy("keyword").orderBy("fame", "bin"))
    bins = bins.select(*key, earlier.alias("before_bin"))
    inside = running_before("weight", Window.partitionBy(*key).orderBy("product"))
    before: Column = F.col("before_bin") + F.col("inside")
    rows = binned.withColumn("inside", inside).join(bins, key)
    return rows.filter(100 * (F.col("total") - before) >= min_percent * F.col("total")).select("product", "keyword", "total")


def _written(df: DataFrame) -> DataFrame:
    path = scratch_dir(df.sparkSession, "synonyms")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
