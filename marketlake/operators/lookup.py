"""Surrogate-key lookup against the product dimension.

The dimension is never broadcast: a broadcast passes through the driver, and Spark takes the size of a part of its columns
for far less than the surrogate keys come to. A hot product may sit on the left side of the sort-merge join; the right side
holds one row per key (and day), so adaptive execution splits that product's rows over many tasks and copies one row to each.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def resolve_sk(
    df: DataFrame,
    dim: DataFrame,
    keys: list[str],
    mode: str = "current",
    day: str = "ingested_at",
    sk: str = "product_sk",
    unique_days: bool = False,
) -> DataFrame:
    """Adds the surrogate key of each row's product; a product without a version keeps its row with NULL.

    ``current`` takes today's current version, ``asof`` the version valid on the row's own day (backfills).
    ``unique_days`` says that ``df`` holds a key once a day, as facts by product and day do: its rows then stand on
    the time line themselves, which saves the distinct and the join back.
    """
    if mode == "asof" and unique_days:
        return _carried(df, dim, keys, day, sk)
    if mode == "current":
        found, on = dim.filter("is_current").select(sk, *keys), keys
    elif mode == "asof":
        found, on = valid_versions(dim, df.select(*keys, day).distinct(), keys, day, sk), [*keys, day]
    else:
        raise ValueError(f"mode must be 'current' or 'asof', not {mode!r}")
    return df.join(found.hint("merge"), on, "left").select(sk, *df.columns)


def valid_versions(dim: DataFrame, asked: DataFrame, keys: list[str], day: str, sk: str) -> DataFrame:
    """The version valid on each asked (key, day), which must be distinct.

    Versions and asked days are laid on one time line per key and the newest version is carried forward: one
    sort, where a join on the validity range would compare every day of a key with every version of it. A time
    line holds at most one version and one asked row per day, so it is bounded by the number of days.
    """
    return _time_line(asked.dropna(subset=keys), dim, keys, day, sk).filter(_valid(day)).select(*keys, day, F.col(f"newest.{sk}").alias(sk))


def _time_line(asked: DataFrame, dim: DataFrame, keys: list[str], day: str, sk: str) -> DataFrame:
    """The asked rows, each with the ``newest`` version that starts on its day or before."""
    version = F.struct(F.col(sk), F.col("expiry_date"))
    starts = dim.dropna(subset=keys).select(*keys, F.col("effective_date").alias(day), version.alias("version"))
    line = starts.unionByName(asked, allowMissingColumns=True)
    so_far = (
        Window.partitionBy(*keys)
        .orderBy(day, F.col("version").isNull())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return line.withColumn("newest", F.last("version", ignorenulls=True).over(so_far)).filter(F.col("version").isNull())


def _valid(day: str) -> Column:
    return F.col("newest.expiry_date").isNull() | (F.col(day) <= F.col("newest.expiry_date"))


def _carried(df: DataFrame, dim: DataFrame, keys: list[str], day: str, sk: str) -> DataFrame:
    """``df`` through the time line itself; rows without a key, which match nothing, go round it."""
    line = beside_versions(df, dim.select(*keys, "effective_date", sk, "expiry_date"), keys)
    so_far = (
        Window.partitionBy(*keys)
        .orderBy(F.coalesce("version.effective_date", day), F.col("version").isNull())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    newest = line.withColumn("newest", F.last("version", ignorenulls=True).over(so_far)).filter(F.col("version").isNull())
    found = newest.select(F.when(_valid(day), F.col(f"newest.{sk}")).alias(sk), *df.columns)
    keyless = df.filter(" or ".join(f"{k} is null" for k in keys))
    return found.unionByName(keyless.select(F.lit(None).cast(dim.schema[sk].dataType).alias(sk), *df.columns))


def beside_versions(df: DataFrame, versions: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """The rows of ``df``, with NULL as ``version``, and below them a row for each version of their keys, which holds the
    other columns of ``versions`` as ``version``. Its other columns are those of any row of the key.

    The first row of a key meets the key's versions as one list, which is then taken apart: a join on the key alone, where
    a union would lose how both tables are dealt. Tables stored by key (``tables.stored_by``) take no shuffle here, others
    one each. All versions of a key are held at once, so there should be no more than one a day. Rows without a key drop
    out, and with ``inner`` those without a version.
    """
    version = F.struct(*[c for c in versions.columns if c not in keys])
    held = versions.dropna(subset=keys).groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.collect_list(version).alias("_versions"))
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys)) == 1
    own = F.array(F.lit(None).cast(held.schema["_versions"].dataType.elementType))
    listed = F.when(F.col("_first") & F.col("_versions").isNotNull(), F.concat(own, "_versions")).otherwise(own)
    rows = df.dropna(subset=keys).withColumn("_first", first)
    # Never broadcast: the lists would pass through the driver.
    both = rows.join(held.hint("merge"), [F.col(k) == F.col(f"_{k}") for k in keys], how)
    return both.select(*df.columns, F.explode(listed).alias("version"))
