"""Tables as Parquet directories partitioned by day: read some days, replace some days, append a day."""

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.operators.quality import schema_differences
from marketlake.sources.files import TABLE_CODEC, child_names, delete

DAY = "ingested_at"


@dataclass(frozen=True)
class RunReport:
    """What one write did. ``details`` holds table-specific counts."""

    table: str
    path: str
    mode: str
    rows_in: int
    rows_out: int
    details: dict[str, int] | None = None


def stored_days(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> list[str]:
    """Days a table holds, within an optional range."""
    prefix = f"{DAY}="
    days = [n.removeprefix(prefix) for n in child_names(spark, path) if n.startswith(prefix)]
    return [d for d in days if (start is None or d >= start) and (end is None or d <= end)]


def read_days(
    spark: SparkSession, path: str, schema: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """The rows of a range of days; empty when there are none.

    Only the wanted partitions are listed: naming the whole table would list every file of every day.
    """
    days = stored_days(spark, path, start, end)
    if not days:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/{DAY}={d}" for d in days]
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def read_day(spark: SparkSession, path: str, schema: str, day: str) -> DataFrame:
    return read_days(spark, path, schema, day, day)


def publish_days(
    df: DataFrame, path: str, schema: str, start: str, end: str, rebalance: bool = False, covered: Iterable[str] = ()
) -> int:
    """Replaces the days found in ``df`` and the ``covered`` ones; returns the rows written. Other days stay as they are.

    ``covered`` names the days that the source of ``df`` held: one that gave no row is emptied, as its rows of an
    earlier run are no longer true. They go after the write, so a run that fails leaves them.
    A row of a day outside ``start``..``end`` fails the write instead of replacing that day. ``rebalance``
    evens out the files: a large day is split over several tasks, small days do not get a file from each task.
    """
    differences = schema_differences(df, schemas.parse(schema))
    if differences:
        raise ValueError(f"{path}: " + "; ".join(differences))
    in_range = F.col(DAY).cast("date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    foreign = F.concat(F.lit(f"row outside {start}..{end}: "), F.coalesce(F.col(DAY).cast("string"), F.lit("NULL")))
    checked = df.select(*schemas.column_names(schema)).withColumn(
        DAY, F.when(in_range, F.col(DAY)).otherwise(F.raise_error(foreign))
    )
    if rebalance:
        checked = checked.hint("rebalance") if start == end else checked.hint("rebalance", F.col(DAY))
    written, days = _write(checked, path, "overwrite")
    for day in sorted(set(covered) & set(stored_days(df.sparkSession, path, start, end)) - days):
        delete(df.sparkSession, f"{path}/{DAY}={day}")
    return written


def publish_day(df: DataFrame, path: str, schema: str, day: str, rebalance: bool = False) -> int:
    """Replaces one day, with nothing if ``df`` is empty."""
    return publish_days(df, path, schema, day, day, rebalance, covered=[day])


def append_day(df: DataFrame, path: str, schema: str, mode: str = "append") -> int:
    """Plain write by day (append, overwrite, error or ignore); reruns with ``append`` duplicate rows."""
    if mode not in ("append", "overwrite", "error", "ignore"):
        raise ValueError(f"unknown write mode {mode!r}")
    if df.isEmpty():
        return 0
    return _write(df.select(*schemas.column_names(schema)), path, mode)[0]


def _write(df: DataFrame, path: str, mode: str) -> tuple[int, set[str]]:
    """Writes once; rows and days written. Both are taken in the writing stage, so a retried task is not counted twice."""
    written = Observation()
    (
        df.observe(written, F.count(F.lit(1)).alias("rows"), F.collect_set(F.col(DAY).cast("string")).alias("days"))
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .parquet(path, compression=TABLE_CODEC)
    )
    return written.get["rows"], set(written.get["days"] or ())


def stored_by(df: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """``df`` written to a new folder in buckets of ``keys`` and read back: steps by these keys then need no shuffle.

    As many buckets as shuffle partitions, so rows that a step by these keys left behind are written where they are. The
    table's name is only for the write, as Spark buckets named tables alone; it is gone from the catalog when this returns.
    """
    spark, name = df.sparkSession, f"stored_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, *keys).option("path", path).saveAsTable(name, format="parquet", compression=TABLE_CODEC)
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")  # an external table: its files stay
