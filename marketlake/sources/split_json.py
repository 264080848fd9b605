"""One very large JSON envelope read by many tasks.

The text reader cuts files into byte ranges at closing braces, so no task holds a file. Whether a brace stands in a string is
the parity of the quotes before it, and how deep it is the sum of what opens and closes before it: both are running sums,
taken within a byte range for either state at its begin, and over the few ranges of a file after that. A product is what lies
between two closings of an entry of the top-level array ``products``.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketlake.sources.feeds import Feed, day_folders

_PLACE = ["file", "range"]
_FIRST_BRACE = r'^(?:[^"{]++|"(?:[^"\\]++|\\.)*+")*+'  # all before the first brace outside strings
_DEEP = ["braces", "brackets"]


def read_split(
    spark: SparkSession, root: str, feed: Feed, days: list[str], pattern: str = "*.json"
) -> tuple[DataFrame, DataFrame] | None:
    """Raw rows of the given days, as ``feeds.flatten`` gives them, and the files that could not be loaded with the reason.

    None when no day has a folder. A file is one envelope, its ``products`` an array of objects; entries of other types
    are left out and have no position. A file whose quotes, braces or brackets do not close is ``malformed``, one without the
    feed's metadata ``missing_metadata``; neither gives rows. A product that does not parse by itself has NULL fields, as
    has one field of another type; other faults of syntax between products are not seen.
    """
    folders = [f"{root}/{feed.folder}/{name}" for name in day_folders(spark, root, feed, days)]
    if not folders:
        return None
    pieces = _with_depth(_pieces(spark, folders, pattern))
    ranges = _range_starts(pieces)
    placed = _placed(pieces, ranges)
    entries = _entries(placed)
    files = _files(ranges, entries, feed)
    loaded = files.where("reason is null").drop("reason")
    return _products(entries, loaded, feed), files.where("reason is not null").select(
        F.element_at(F.split("file", "/"), -1).alias("source_file"), "reason", _day("file").alias("ingested_at")
    )


def _pieces(spark: SparkSession, folders: list[str], pattern: str) -> DataFrame:
    """The texts between closing braces, in the order of `row` within a byte range of a file."""
    texts = spark.read.option("lineSep", "}").option("pathGlobFilter", pattern).text(folders)
    return texts.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("range"),
        F.col("_metadata.file_size").alias("bytes"),
        F.monotonically_increasing_id().alias("row"),
        F.col("value").alias("text"),
    )


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _with_depth(pieces: DataFrame) -> DataFrame:
    """What each piece adds to depth, and what the pieces up to it add within their range, if the range begins outside or inside a string."""
    parts = F.split(F.regexp_replace("text", r"(?s)\\.", ""), '"')  # quotes that are left begin or end strings
    out = pieces.withColumn("quotes", F.size(parts) - 1)
    for state in (0, 1):
        bare = F.array_join(F.filter(parts, lambda _, k: k % 2 == state), " ")  # noqa: B023
        closing = F.when((F.col("quotes") + state) % 2 == 0, 1).otherwise(0)  # the brace that the piece ends with
        out = out.withColumn(f"braces_{state}", _count(bare, "{") - closing)
        out = out.withColumn(f"brackets_{state}", _count(bare, "[") - _count(bare, "]"))
    before = Window.partitionBy(*_PLACE).orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*_PLACE).orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    out = out.withColumn("inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    for state in (0, 1):
        for kind in _DEEP:
            own = F.when((F.col("inside") + state) % 2 == 0, F.col(f"{kind}_0")).otherwise(F.col(f"{kind}_1"))
            out = out.withColumn(f"{kind}_from_{state}", F.sum(own).over(upto))
    return out


def _range_starts(pieces: DataFrame) -> DataFrame:
    """One row per byte range: the state that it begins with, and that it ends with."""
    last = [F.max_by(f"{kind}_from_{state}", "row").alias(f"{kind}_{state}") for kind in _DEEP for state in (0, 1)]
    ranges = pieces.groupBy(*_PLACE).agg(
        F.sum("quotes").alias("quotes"), F.sum(F.octet_length("text") + 1).alias("read"), F.max("bytes").alias("bytes"), *last
    )
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("starts_inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    for kind in _DEEP:
        own = F.when(F.col("starts_inside") == 0, F.col(f"{kind}_0")).otherwise(F.col(f"{kind}_1"))
        ranges = ranges.withColumn(f"own_{kind}", own)
        ranges = ranges.withColumn(f"start_{kind}", F.coalesce(F.sum(f"own_{kind}").over(before), F.lit(0)))
    return ranges


def _placed(pieces: DataFrame, ranges: DataFrame) -> DataFrame:
    """Pieces with the depth they end at; `ends` marks those that close a top-level field's object or an array's entry."""
    starts = ranges.select(*_PLACE, "starts_inside", *[f"start_{kind}" for kind in _DEEP])
    out = pieces.join(starts, _PLACE)
    for kind in _DEEP:
        own = F.when(F.col("starts_inside") == 0, F.col(f"{kind}_from_0")).otherwise(F.col(f"{kind}_from_1"))
        out = out.withColumn(kind, F.col(f"start_{kind}") + own)
    outside = (F.col("starts_inside") + F.col("inside") + F.col("quotes")) % 2 == 0
    return out.withColumn("ends", outside & (F.col("braces") == 1) & F.col("brackets").isin(0, 1))


def _entries(placed: DataFrame) -> DataFrame:
    """One row per object that is a top-level field, or an entry of a top-level array: its text, and what stands before it."""
    before = Window.partitionBy(*_PLACE).orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    ended = F.col("ends").cast("long")
    counts = placed.groupBy(*_PLACE).agg(F.sum(ended).alias("n"))
    earlier = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*_PLACE, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
    numbered = placed.withColumn("within", F.coalesce(F.sum(ended).over(before), F.lit(0))).join(counts, _PLACE)
    pieces = F.array_sort(F.collect_list(F.struct("range", "row", "text")))
    whole = numbered.groupBy("file", (F.col("earlier") + F.col("within")).alias("number")).agg(
        F.transform(pieces, lambda x: F.concat(x["text"], F.lit("}"))).alias("pieces"),
        F.max("ends").alias("ends"),
        F.max(F.when(F.col("ends"), F.col("brackets"))).alias("brackets"),
    )
    # the brace that opens the envelope itself goes first
    first = F.when(F.col("number") == 0, F.regexp_replace(F.get("pieces", F.lit(0)), r"^\s*\{", "")).otherwise(F.get("pieces", F.lit(0)))
    head = F.regexp_extract(first, _FIRST_BRACE, 0)
    rest = F.array_join(F.slice("pieces", 2, F.greatest(F.size("pieces") - 1, F.lit(0))), "")
    return whole.where("ends").select(
        "file",
        "number",
        "brackets",
        F.regexp_extract(head, r'"([^"]*)"\s*:\s*(?:\[[^"]*)?$', 1).alias("field"),
        F.concat(F.substr(first, F.length(head) + 1), rest).alias("json"),
    )


def _files(ranges: DataFrame, entries: DataFrame, feed: Feed) -> DataFrame:
    """One row per file: its metadata, and why it is not loaded (else NULL)."""
    unread = F.sum("read") - F.max("bytes")  # 1 where no brace follows the last piece
    ended = ranges.groupBy("file").agg(
        ((F.sum("quotes") % 2 == 0) & (F.sum("own_braces") + unread == 0) & (F.sum("own_brackets") == 0)).alias("whole")
    )
    shape = StructType.fromDDL(feed.envelope)["metadata"].dataType
    found = entries.where("brackets = 0 and field = 'metadata'").groupBy("file").agg(F.max_by("json", "number").alias("json"))
    files = ended.join(found, "file", "left").withColumn("metadata", F.from_json("json", shape))
    stamps = [F.col(f"metadata.{field}").alias(name) for name, field in feed.metadata.items()]
    complete = F.lit(True)
    for name in feed.metadata:
        complete = complete & F.col(name).isNotNull()
    files = files.select("file", "whole", *stamps)
    reason = F.when(~F.col("whole"), "malformed").when(~complete, "missing_metadata")
    return files.select("file", *feed.metadata, reason.alias("reason"))


def _products(entries: DataFrame, files: DataFrame, feed: Feed) -> DataFrame:
    """Entries of the array `products`: those from its first on, as far as the first of another top-level field."""
    fields = entries.where("field <> ''").select("file", "number", F.col("field").alias("name"))
    later = Window.partitionBy("file").orderBy("number")  # one row per top-level field of a file
    spans = fields.withColumn("next", F.lead("number").over(later)).where("name = 'products'")
    shape = StructType.fromDDL(feed.envelope)["products"].dataType.elementType
    rows = entries.where("brackets = 1").join(spans.select("file", F.col("number").alias("begin"), "next"), "file")
    rows = rows.where("number >= begin and (next is null or number < next)").join(files, "file")
    return rows.select(
        F.from_json("json", shape).alias("product"),
        *feed.metadata,
        F.element_at(F.split("file", "/"), -1).alias("source_file"),
        (F.col("number") - F.col("begin")).cast("int").alias("source_position"),
        _day("file").alias("ingested_at"),
    ).select("product.*", *feed.metadata, "source_file", "source_position", "ingested_at")


def _day(file: str) -> Column:
    return F.regexp_extract(file, r"(\d{4}-\d{2}-\d{2})/[^/]+$", 1)
