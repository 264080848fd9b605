"""Checks on finished tables. Each returns a DataFrame of findings."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketlake.functions.numbers import settled


def quality_profile(df: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """Null count and rate of every column, with the rows outside its allowed range, in one pass.

    All counts combine before the shuffle; no distinct counts, so the input is never expanded.
    """
    measures = []
    for c in df.columns:
        low, high = ranges.get(c, (None, None))
        outside = F.lit(None).cast("bigint") if low is None else F.count_if(~F.col(c).between(low, high))
        measures.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.count_if(F.col(c).isNull()).alias("null_rows"),
                outside.alias("out_of_range_rows"),
            )
        )
    totals = df.agg(F.count(F.lit(1)).alias("total_rows"), F.array(*measures).alias("measures"))
    return totals.select("total_rows", F.inline("measures")).withColumn(
        "null_rate", F.when(F.col("total_rows") > 0, F.round(F.col("null_rows") / F.col("total_rows"), 4))
    )


def day_histograms(df: DataFrame, day: str, edges: dict[str, list[float]]) -> DataFrame:
    """Rows of each day by bin, for each column of ``edges``: below the first edge, between edges, from the last on, NULL.

    All bins of all columns are counted in one pass and combine before the shuffle on the day.
    """
    columns = []
    for name, bounds in edges.items():
        value = F.col(name)
        bins = [value < bounds[0]]
        bins += [(value >= low) & (value < high) for low, high in zip(bounds, bounds[1:], strict=False)]
        bins += [value >= bounds[-1], value.isNull()]
        columns.append(F.struct(F.lit(name).alias("column_name"), F.array(*[F.count_if(b) for b in bins]).alias("bins")))
    return df.groupBy(day).agg(F.array(*columns).alias("columns")).select(day, F.inline("columns"))


def day_drift(histograms: DataFrame, day: str, max_stability: float = 0.2, max_gap: float = 0.1) -> DataFrame:
    """How far each day's histogram is from that of the day before it in the table, by column.

    ``stability_index`` is the population stability index, with half a row added to every bin so that empty bins count;
    ``largest_gap`` the largest difference of the running shares, with NULL as the last bin. A day beyond either bound
    has ``drifted``; a column's first day has nothing to be compared with. A window holds one row per day.
    """
    line = Window.partitionBy("column_name").orderBy(day)
    rows = histograms.withColumns({"before": F.lag("bins").over(line), "previous_day": F.lag(day).over(line)})
    total = lambda bins: F.aggregate(bins, F.lit(0).cast("bigint"), lambda a, n: a + n)
    rows = rows.withColumns({"n_rows": total("bins"), "n_before": total("before")})

    def smoothed(count: Column, whole: str) -> Column:
        return (count + F.lit(0.5)) / (F.col(whole) + F.size("bins") * F.lit(0.5))

    def step(now: Column, then: Column) -> Column:
        p, q = smoothed(now, "n_rows"), smoothed(then, "n_before")
        return (p - q) * F.log(p / q)

    index = F.aggregate(F.zip_with("bins", "before", step), F.lit(0.0), lambda a, x: a + x)
    start = F.struct(F.lit(0).cast("bigint").alias("now"), F.lit(0).cast("bigint").alias("then"), F.lit(0.0).alias("gap"))

    def widen(a: Column, x: Column) -> Column:
        now, then = a["now"] + x["now"], a["then"] + x["then"]
        gap = F.abs(now / F.col("n_rows") - then / F.col("n_before"))
        return F.struct(now.alias("now"), then.alias("then"), F.greatest(a["gap"], gap).alias("gap"))

    pairs = F.zip_with("bins", "before", lambda now, then: F.struct(now.alias("now"), then.alias("then")))
    rows = rows.withColumns({"stability_index": settled(index, 6), "largest_gap": settled(F.aggregate(pairs, start, widen)["gap"], 6)})
    far = (F.col("stability_index") > max_stability) | (F.col("largest_gap") > max_gap)
    return rows.select("column_name", day, "previous_day", "n_rows", "stability_index", "largest_gap", F.coalesce(far, F.lit(False)).alias("drifted"))


def current_duplicates(dim: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more than one current version; empty when the dimension is sound."""
    return dim.filter("is_current").groupBy(*keys).agg(F.count(F.lit(1)).alias("current_rows")).filter("current_rows > 1")


def null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose business key holds a NULL, counted per key column."""
    counts = [F.struct(F.lit(k).alias("key_column"), F.count_if(F.col(k).isNull()).alias("null_rows")) for k in keys]
    return df.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))


def dim_totals(dim: DataFrame) -> DataFrame:
    """All versions and the current ones, counted in one pass."""
    return dim.agg(F.count(F.lit(1)).alias("total_rows"), F.count_if("is_current").alias("current_rows"))


def schema_differences(df: DataFrame, declared: StructType) -> list[str]:
    """What separates a DataFrame from its declared schema: missing, extra or differently typed columns."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = {f.name: f.dataType.simpleString() for f in declared.fields}
    missing = [f"missing column {c}" for c in wanted if c not in actual]
    extra = [f"unexpected column {c}" for c in actual if c not in wanted]
    retyped = [f"{c} is {actual[c]}, declared {t}" for c, t in wanted.items() if c in actual and actual[c] != t]
    return missing + extra + retyped
