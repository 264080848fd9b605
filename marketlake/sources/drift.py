"""What a feed holds beyond its declared schema: fields nobody declared, and declared fields of another type.

The declared read keeps what it knows and drops the rest. Here the raw records are read as VARIANT beside it, every field
is compared with the declaration in the record's own row, and only fields that differ leave it. They are kept with their
raw values, so a field declared later can be filled from the days before, and counted by day and field for a report.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from marketlake import schemas
from marketlake.sources.feeds import Feed, scan

DRIFT = """
    source_file string, source_position int,
    fields array<struct<field: string, declared: string, observed: string, value: string>>, ingested_at string
"""

# The kinds of a variant that a declared type reads without loss.
ACCEPTED = {
    "string": ["STRING"],
    "boolean": ["BOOLEAN"],
    "int": ["BIGINT"],
    "bigint": ["BIGINT"],
    "double": ["BIGINT", "DECIMAL", "DOUBLE"],
    "array": ["ARRAY"],
    "struct": ["OBJECT"],
}
# What stands for a whole record, and for one that cannot be read as a variant.
RECORD, UNREADABLE = "$", "UNREADABLE"


def declared_types(kind: DataType, path: str = "") -> dict[str, str]:
    """Declared type by path: ``a.b`` is field b of a, ``a[]`` an element of a."""
    if isinstance(kind, StructType):
        found = {}
        for f in kind.fields:
            own = f"{path}.{f.name}" if path else f.name
            found |= {own: f.dataType.typeName() if _nested(f.dataType) else f.dataType.simpleString()} | declared_types(f.dataType, own)
        return found
    if isinstance(kind, ArrayType):
        element = kind.elementType
        own = f"{path}[]"
        return {own: element.typeName() if _nested(element) else element.simpleString()} | declared_types(element, own)
    return {}


def drifted(spark: SparkSession, root: str, feed: Feed, days: list[str], multi_line: bool = True) -> DataFrame | None:
    """One row per record part with undeclared or retyped fields; None when no day has a folder.

    A part is a product (``source_position`` as in the raw table) or the rest of its envelope (no position). Nothing is
    shuffled, and a record without such a field gives no row. NULL fits every type. A field inside an undeclared one is not
    listed by itself. A record that is no variant, as with a key twice, is listed as unreadable.
    """
    records = scan(spark, root, feed, days, multi_line, lambda r: r.option("singleVariantColumn", "record"))
    if records is None:
        return None
    declared = declared_types(schemas.parse(feed.envelope))
    products = {p.removeprefix("products[]."): t for p, t in declared.items() if p.startswith("products[].")}
    envelope = {p: t for p, t in declared.items() if not p.startswith("products[]") and p != "_corrupt_record"}
    origin = ["source_file", "ingested_at"]
    whole = records.select(*origin, F.lit(None).cast("int").alias("source_position"), F.col("record").alias("part"))
    each = records.select(*origin, F.posexplode(F.try_variant_get("record", "$.products", "array<variant>")).alias("source_position", "part"))
    unreadable = F.array(_difference(F.lit(RECORD), F.lit("struct"), F.lit(UNREADABLE), F.lit(None).cast("string")))
    whole = _differences(whole, envelope, closed="products").withColumn("fields", F.when(F.col("part").isNull(), unreadable).otherwise(F.col("fields")))
    kind = _kind(F.col("part"))
    odd = F.array(_difference(F.lit("products[]"), F.lit("struct"), kind, F.to_json("part")))
    each = _differences(each, products).withColumn("fields", F.when(~kind.isin("OBJECT", "VOID"), odd).otherwise(F.col("fields")))
    rows = whole.unionByName(each)
    return rows.filter(F.size("fields") > 0).select("source_file", "source_position", "fields", "ingested_at")


def drift_report(drift: DataFrame, feed: Feed) -> DataFrame:
    """Fields by day: undeclared ones are ``new``, others ``retyped``; with the kind observed and how often."""
    found = drift.select("ingested_at", F.inline("fields"))
    change = F.when(F.col("observed") == UNREADABLE, "unreadable").when(F.col("declared").isNull(), "new").otherwise("retyped")
    counted = found.groupBy("ingested_at", "field", "declared", "observed").agg(F.count(F.lit(1)).alias("seen"))
    return counted.select(F.lit(feed.name).alias("feed"), "ingested_at", "field", change.alias("change"), "declared", "observed", "seen")


def _nested(kind: DataType) -> bool:
    return isinstance(kind, StructType | ArrayType)


def _difference(field: Column, declared: Column, observed: Column, value: Column) -> Column:
    return F.struct(field.alias("field"), declared.alias("declared"), observed.alias("observed"), value.alias("value"))


def _kind(value: Column) -> Column:
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def _differences(rows: DataFrame, declared: dict[str, str], closed: str = "") -> DataFrame:
    """Adds ``fields``: those of ``part`` that are not as declared, level by level into declared structs and arrays.

    The elements of the array ``closed`` are not looked at.
    """
    types = F.create_map(*[F.lit(x) for pair in declared.items() for x in pair])
    fits = F.create_map(*[x for t in sorted(set(declared.values())) for x in (F.lit(t), F.array(*[F.lit(k) for k in ACCEPTED[t]]))])

    def entry(path: Column, value: Column) -> Column:
        return F.struct(path.alias("path"), value.alias("value"), _kind(value).alias("kind"), F.element_at(types, path).alias("declared"))

    def inside(value: Column, named) -> Column:
        fields = F.try_variant_get(value, "$", "map<string,variant>")
        return F.transform(F.map_entries(fields), lambda e: entry(named(e["key"]), e["value"]))

    def below(x: Column) -> Column:
        elements = F.try_variant_get(x["value"], "$", "array<variant>")
        listed = F.transform(elements, lambda v: entry(F.concat(x["path"], F.lit("[]")), v))
        named = inside(x["value"], lambda key: F.concat(x["path"], F.lit("."), key))
        return F.when(x["kind"] == "ARRAY", listed).otherwise(named)

    rows = rows.withColumn("level0", inside(F.col("part"), lambda key: key))
    depth = max(path.count(".") + path.count("[]") for path in declared)
    for n in range(depth):
        open_ = F.filter(f"level{n}", lambda x: ((x["declared"] == "array") & (x["kind"] == "ARRAY") & (x["path"] != closed)) | ((x["declared"] == "struct") & (x["kind"] == "OBJECT")))
        rows = rows.withColumn(f"level{n + 1}", F.flatten(F.transform(open_, below)))
    every = F.concat(*[F.coalesce(F.col(f"level{n}"), F.array()) for n in range(depth + 1)])
    differs = lambda x: (x["kind"] != "VOID") & ~F.coalesce(F.array_contains(F.element_at(fits, x["declared"]), x["kind"]), F.lit(False))
    shown = F.transform(F.filter(every, differs), lambda x: _difference(x["path"], x["declared"], x["kind"], F.to_json(x["value"])))
    return rows.withColumn("fields", shown).drop(*[f"level{n}" for n in range(depth + 1)])
