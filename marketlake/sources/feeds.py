"""Raw feeds: JSON envelopes ``{metadata, products: [...]}`` under ``<root>/<feed>/<yyyy-mm-dd>/*.json``, plain or as ``.json.gz``."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.sources.files import child_names


# Fixed value: names of feed files. A compressed file is read by one task, so it should be no larger than a task's share.
FILES = "*.{json,json.gz}"


@dataclass(frozen=True)
class Feed:
    name: str
    folder: str
    envelope: str  # schema of one file
    bronze: str  # schema of the raw table
    metadata: dict[str, str]  # column in the raw table -> field of the envelope's metadata


SEARCH = Feed(
    "search_results",
    "search",
    schemas.SEARCH_ENVELOPE,
    schemas.BRONZE_SEARCH,
    {"keyword": "keyword", "marketplace": "marketplace", "source_extracted_at": "extracted_at"},
)
DETAILS = Feed(
    "product_details",
    "details",
    schemas.DETAILS_ENVELOPE,
    schemas.BRONZE_DETAILS,
    {"marketplace": "marketplace", "source_extracted_at": "extracted_at"},
)
FEEDS = (SEARCH, DETAILS)


def read_envelopes(
    spark: SparkSession, root: str, feed: Feed, days: list[str], multi_line: bool = True
) -> DataFrame | None:
    """One row per envelope of the given days, or None when no day has a folder.

    All days are one scan. ``multi_line`` reads one envelope per file, which a single task must hold; feeds
    written as one envelope per line (``multi_line=False``) are split like any other text. A day's folder is
    named after the day, alone or as ``<name>=<day>``.
    """
    return scan(
        spark,
        root,
        feed,
        days,
        multi_line,
        lambda r: r.schema(feed.envelope).option("columnNameOfCorruptRecord", "_corrupt_record"),
    )


def scan(
    spark: SparkSession,
    root: str,
    feed: Feed,
    days: list[str],
    multi_line: bool,
    shaped: Callable[[DataFrameReader], DataFrameReader],
) -> DataFrame | None:
    """The JSON files of the given days with their origin, as the reader's options shape the records."""
    folders = [f"{root}/{feed.folder}/{n}" for n in day_folders(spark, root, feed, days)]
    if not folders:
        return None
    reader = spark.read.option("multiLine", multi_line).option("mode", "PERMISSIVE").option("pathGlobFilter", FILES)
    return (
        shaped(reader)
        .json(folders)
        .withColumn("source_file", F.col("_metadata.file_name"))
        .withColumn("ingested_at", F.regexp_extract("_metadata.file_path", r"(\d{4}-\d{2}-\d{2})/[^/]+$", 1))
    )


def feed_days(spark: SparkSession, root: str, feed: Feed, days: list[str]) -> list[str]:
    """Those of ``days`` that have a folder."""
    return [n.rpartition("=")[2] for n in day_folders(spark, root, feed, days)]


def day_folders(spark: SparkSession, root: str, feed: Feed, days: list[str]) -> list[str]:
    wanted = set(days)
    return [n for n in child_names(spark, f"{root}/{feed.folder}") if n.rpartition("=")[2] in wanted]


def flatten(envelopes: DataFrame, feed: Feed) -> DataFrame:
    """One row per product, stamped with its envelope's metadata, its origin and its place in the envelope.

    A file that does not parse has no products and drops out here; ``quarantined`` reports it.
    """
    stamps = [F.col(f"metadata.{field}").alias(name) for name, field in feed.metadata.items()]
    origin = ["source_file", "ingested_at"]
    return (
        envelopes.filter(_complete(feed))
        .select(*stamps, *origin, F.posexplode("products").alias("source_position", "product"))
        .select("product.*", *feed.metadata, "source_file", "source_position", "ingested_at")
    )


def read_feed(spark: SparkSession, root: str, feed: Feed, day: str, multi_line: bool = True) -> DataFrame:
    """The raw rows of one day; empty when the folder is missing or holds no JSON file."""
    envelopes = read_envelopes(spark, root, feed, [day], multi_line)
    return spark.createDataFrame([], feed.bronze) if envelopes is None else flatten(envelopes, feed)


def is_bad(feed: Feed) -> Column:
    """Envelopes to report: unreadable, without required metadata, or with a field of another type."""
    return F.col("_corrupt_record").isNotNull() | ~_complete(feed)


def quarantined(envelopes: DataFrame, feed: Feed) -> DataFrame:
    """What could not be loaded, and why. A ``partial`` envelope's rows are loaded, its unreadable fields are NULL."""
    reason = (
        F.when(F.col("_corrupt_record").isNotNull() & F.col("products").isNull(), "malformed")
        .when(~_complete(feed), "missing_metadata")
        .otherwise("partial")
    )
    return envelopes.filter(is_bad(feed)).select(
        "source_file", reason.alias("reason"), F.col("_corrupt_record").alias("raw"), "ingested_at"
    )


def _complete(feed: Feed) -> Column:
    complete = F.lit(True)
    for field in feed.metadata.values():
        complete = complete & F.col(f"metadata.{field}").isNotNull()
    return complete
