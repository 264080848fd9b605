"""Typed columns from the texts and nested values on a product page."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketlake.functions.numbers import number

# How the marketplace writes brands, ranks, sizes, weights and dates.
BRAND_PREFIX = r"^Brand:\s*"
RANK_IN_CATEGORY = r"#?([\d,]+)\s+in\s*([^\r\n]*)"
SIDES_AND_UNIT = r"^([\d.]+)\s*x\s*([\d.]+)(?:\s*x\s*([\d.]+))?(?:\s*([A-Za-z]\w*))?"
WEIGHT_AND_UNIT = r"^([\d.]+)\s+(.+)$"
LISTING_DATES = {r"^[A-Za-z]{3} ": "MMM d, yyyy", r"^[A-Za-z]{4,} ": "MMMM d, yyyy", r"^\d{4}-": "yyyy-MM-dd"}
IN_STOCK = "in stock"
STARS = (5, 4, 3, 2, 1)


def brand_name(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, BRAND_PREFIX, ""))


def seller_ranks(c: Column) -> Column:
    """Each "#1,234 in Toys" as {rank, category}; any number of entries, "in" may touch the category.

    The first rank of an entry counts; a line break ends its category.
    """

    def entry(text: Column) -> Column:
        rank = F.replace(F.regexp_extract(text, RANK_IN_CATEGORY, 1), F.lit(","), F.lit(""))
        return F.struct(
            rank.try_cast("int").alias("rank"),
            F.trim(F.regexp_extract(text, RANK_IN_CATEGORY, 2)).alias("category"),
        )

    return F.transform(c, entry)


def dimension_columns(c: Column) -> dict[str, Column]:
    """Length, width, optional height and unit. A unit starts with a letter, so "12 x 10" has none."""

    def side(group: int) -> Column:
        return number(F.regexp_extract(c, SIDES_AND_UNIT, group))

    return {
        "dimension_length": side(1),
        "dimension_width": side(2),
        "dimension_height": side(3),
        "dimension_unit": F.regexp_extract(c, SIDES_AND_UNIT, 4),
    }


def weight_columns(c: Column) -> dict[str, Column]:
    return {
        "weight_value": number(F.regexp_extract(c, WEIGHT_AND_UNIT, 1)),
        "weight_unit": F.trim(F.regexp_extract(c, WEIGHT_AND_UNIT, 2)),
    }


def rating_columns(overview: Column) -> dict[str, Column]:
    """Share of each star (0 when missing) and the average star weighted by those shares."""
    shares = {n: F.coalesce(overview.getField(str(n)).cast("double"), F.lit(0.0)) for n in STARS}
    total = sum(shares.values(), F.lit(0.0))
    weighted = sum((n * share for n, share in shares.items()), F.lit(0.0))
    columns = {f"rating_pct_{n}": share for n, share in shares.items()}
    columns["rating_weighted_avg"] = F.when(total > 0, F.round(weighted / total, 2))
    return columns


def listing_date(c: Column) -> Column:
    """A date in one of the known formats. Its start tells which: a format that does not fit costs an exception."""
    text = F.trim(c)
    dates = [F.when(text.rlike(start), F.try_to_timestamp(text, F.lit(f))) for start, f in LISTING_DATES.items()]
    return F.coalesce(*dates).cast("date")


def last_name(categories: Column) -> Column:
    return F.try_element_at(categories, F.lit(-1)).getField("name")


def is_in_stock(status: Column) -> Column:
    return F.lower(status) == IN_STOCK
