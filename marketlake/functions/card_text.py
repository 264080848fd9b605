"""Typed columns from the texts on a search-result card.

All are plain Column expressions, safe under ANSI mode: an unreadable text gives NULL, never an error.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketlake.functions.numbers import number

# How the marketplace writes prices, ratings, counts and coupons.
CURRENCY_TEXT = r"^([^\d]+)"
PRICE_NUMBER = r"([\d,]+(?:\.\d+)?)"
LEADING_NUMBER = r"^([\d.]+)"
COUNT_IN_PARENTHESES = r"\(([\d.,]+)([KkMm]?)\)"
COUNT_ANYWHERE = r"([\d.][\d.,]*)([KkMm]?)"
SAVED_PERCENT = r"Save\s*([\d.]+)\s*%"
THOUSAND, MILLION = 1_000, 1_000_000


def _plain_number(text: Column) -> Column:
    return number(F.replace(text, F.lit(","), F.lit("")))


def price_columns(c: Column) -> dict[str, Column]:
    """raw text, currency text and amount of a price such as "$1,299.00"."""
    return {
        "raw": c,
        "currency": F.trim(F.regexp_extract(c, CURRENCY_TEXT, 1)),
        "amount": _plain_number(F.regexp_extract(c, PRICE_NUMBER, 1)),
    }


def discount_pct(original: Column, price: Column) -> Column:
    """Percent below the original price; negative when the price is above it."""
    return F.when(original > 0, F.round((original - price) / original * 100, 2))


def leading_number(c: Column) -> Column:
    """4.5 from "4.5 out of 5 stars"."""
    return number(F.regexp_extract(c, LEADING_NUMBER, 1))


def magnitude_number(c: Column, parens: bool) -> Column:
    """A count with an optional K or M, cut to a whole number: "(3.4K)" is 3400, "(1,234)" is 1234."""
    pattern = COUNT_IN_PARENTHESES if parens else COUNT_ANYWHERE
    unit = F.upper(F.regexp_extract(c, pattern, 2))
    factor = F.when(unit == "K", THOUSAND).when(unit == "M", MILLION).otherwise(1)
    return (_plain_number(F.regexp_extract(c, pattern, 1)) * factor).try_cast("bigint")


def coupon_columns(c: Column) -> dict[str, Column]:
    """Whether a coupon is shown, and its percentage (NULL for a fixed amount)."""
    return {
        "has_coupon": c.isNotNull(),
        "coupon": number(F.regexp_extract(c, SAVED_PERCENT, 1)),
    }
