"""Days built as their files arrive: a stream over the feed folders decides which days are run."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.plans import daily_run
from marketlake.sources import dim_store
from marketlake.sources.feeds import FILES
from marketlake.sources.tables import RunReport

# The columns of Spark's file listing source. The contents are never asked for here, so they are not read.
LISTING = "path string, modificationTime timestamp, length long, content binary"


def run_new_files(
    spark: SparkSession, feeds: str, lake: str, checkpoint: str, multi_line: bool = True, files_a_batch: int = 100_000
) -> list[RunReport]:
    """Brings the lake up to date with all files that arrived since the last call, and ends.

    The stream's checkpoint knows which files were taken in. A batch names days, not rows: a new day is run, files for an
    earlier day make it a late day, and the first batch into an empty lake is one backfill. Each of these replaces whole
    days from all their files, so a batch that is played again after a crash, or a day whose files come in several
    batches, gives the same tables as files that had been there from the start. Days run in order, one run at a time.
    """
    reports: list[RunReport] = []

    def run(batch: DataFrame, _: int) -> None:
        reports.extend(run_days(spark, feeds, lake, batch_days(batch), multi_line))

    arrived = (
        spark.readStream.schema(LISTING)
        .format("binaryFile")
        .option("pathGlobFilter", FILES)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_a_batch)
        .load(feeds)
    )
    query = arrived.select("path").writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return reports


def batch_days(files: DataFrame) -> list[str]:
    """Days of the folders that hold the files, in order: one row a day reaches the driver."""
    day = F.regexp_extract("path", r"(\d{4}-\d{2}-\d{2})/[^/]+$", 1).alias("day")
    return sorted(r.day for r in files.select(day).filter("day <> ''").distinct().collect())


def run_days(spark: SparkSession, feeds: str, lake: str, days: list[str], multi_line: bool = True) -> list[RunReport]:
    """Runs the named days: newer ones as daily runs, earlier ones as late days, and all of a first load at once."""
    path = daily_run.tables(lake)["dim_product"].path
    if len(days) > 1 and dim_store.newest_day(spark, path) is None:
        return daily_run.backfill(spark, feeds, lake, days[0], days[-1], multi_line)
    reports = []
    for day in days:
        newest = dim_store.newest_day(spark, path)
        run = daily_run.run_day if newest is None or day >= newest else daily_run.run_late_day
        reports += run(spark, feeds, lake, day, multi_line)
    return reports
