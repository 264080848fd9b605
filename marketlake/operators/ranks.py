"""Percent ranks inside groups that may be too large for one task."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Width of a value bucket on a logarithmic scale: 1/64 is about 1.6 % of the value.
BUCKETS_PER_LOG_UNIT = 64


def percent_ranks(df: DataFrame, group: list[str], metrics: list[str]) -> DataFrame:
    """Adds ``<metric>_rank``: the share of the group's other rows with a smaller value, NULL counting as 0.

    Equal to ``percent_rank() over (partition by group order by metric)``, but that window sorts a whole group
    in one task. Here equal values are counted first (combined before the shuffle), values fall into ordered
    buckets, and a running total is taken once over the few buckets of a group and once inside each bucket.
    A hot value is one counted row, a hot group is spread over its buckets. The join back to the rows has
    unique values on its right, so a value shared by very many rows is split by adaptive execution.

    All metrics go through one chain, as rows of (metric, value), and through one join back. ``df`` is read twice: pass a
    published table.
    """
    named = [F.struct(F.lit(n).alias("metric"), _value(m).alias("value")) for n, m in enumerate(metrics)]
    ranks = _ranks_of_values(df.select(*group, F.inline(F.array(*named))), [*group, "metric"])
    none = F.lit(None).cast(df.schema)
    rows = [s.withField("row", F.struct(*df.columns) if n == 0 else none) for n, s in enumerate(named)]  # a row travels once
    rows = df.withColumn("_row", F.monotonically_increasing_id()).select("_row", *group, F.inline(F.array(*rows)))
    found = join_null_safe(rows, ranks, [*group, "metric", "value"]).groupBy("_row")
    own = [F.max(F.when(F.col("metric") == n, F.col("rank"))).alias(f"{m}_rank") for n, m in enumerate(metrics)]
    return found.agg(F.first("row", ignorenulls=True).alias("row"), *own).select("row.*", *[f"{m}_rank" for m in metrics])


def _ranks_of_values(rows: DataFrame, key: list[str]) -> DataFrame:
    """Rank of every ``value`` within its key."""
    counts = rows.groupBy(*key, "value").agg(F.count(F.lit(1)).alias("n")).withColumn("bucket", value_bucket(F.col("value")))
    in_bucket = Window.partitionBy(*key, "bucket")
    counts = counts.withColumn("below_in_bucket", running_before("n", in_bucket.orderBy("value")))
    whole = Window.partitionBy(*key)
    buckets = counts.groupBy(*key, "bucket").agg(F.sum("n").alias("bucket_rows"))
    buckets = buckets.select(
        *key,
        "bucket",
        running_before("bucket_rows", whole.orderBy("bucket")).alias("below_bucket"),
        F.sum("bucket_rows").over(whole).alias("group_rows"),
    )
    values = join_null_safe(counts, buckets, [*key, "bucket"])
    below = F.col("below_bucket") + F.col("below_in_bucket")
    rank = F.when(F.col("group_rows") > 1, below / (F.col("group_rows") - 1)).otherwise(0.0)
    return values.select(*key, "value", rank.alias("rank"))


def _value(metric: str) -> Column:
    return F.coalesce(F.col(metric).cast("double"), F.lit(0.0))


def value_bucket(value: Column) -> Column:
    """A bucket number that never falls as the value grows, and is the same on every run."""
    return (F.signum(value) * F.floor(F.log1p(F.abs(value)) * BUCKETS_PER_LOG_UNIT)).cast("int")


def running_before(rows: str, window) -> Column:
    return F.coalesce(F.sum(rows).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def join_null_safe(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    right = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    return left.join(right, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on]).drop(*[f"_r_{c}" for c in on])
