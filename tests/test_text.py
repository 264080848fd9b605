"""Texts in, typed values out."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from marketlake.functions import card_text as card
from marketlake.functions import page_text as page


def parsed(stored, values, column):
    rows = stored([(i, v) for i, v in enumerate(values)], "i int, raw string")
    out = rows.select("i", column(F.col("raw")).alias("out")).orderBy("i").collect()
    return [r.out for r in out]


def check(stored, column, cases):
    assert parsed(stored, [c[0] for c in cases], column) == [c[1] for c in cases]


def test_price_amount(stored):
    check(
        stored,
        lambda c: card.price_columns(c)["amount"],
        [
            ("VND 340,600", 340600.0),
            ("$12.99", 12.99),
            ("$1,299.00", 1299.0),
            ("$12.99 - $15.99", 12.99),
            ("12,99", 1299.0),
            ("N/A", None),
            (",", None),
            ("", None),
            (None, None),
        ],
    )


def test_price_currency(stored):
    check(
        stored,
        lambda c: card.price_columns(c)["currency"],
        [("VND 340,600", "VND"), ("$12.99", "$"), ("12.99", ""), ("N/A", "N/A"), (None, None)],
    )


def test_rating(stored):
    check(
        stored,
        card.leading_number,
        [("4.5 out of 5 stars", 4.5), ("5 stars", 5.0), ("no", None), ("1.2.3 x", None), (None, None)],
    )


def test_ratings_count(stored):
    # "(1,234)" deliberately reads the whole number instead of nothing.
    check(
        stored,
        lambda c: card.magnitude_number(c, parens=True),
        [
            ("(130.9K)", 130900),
            ("(3.4K)", 3400),
            ("(22)", 22),
            ("(1.2m)", 1200000),
            ("22", None),
            ("(1,234)", 1234),
            ("(99999999999999999999M)", None),
            (None, None),
        ],
    )


def test_monthly_sales(stored):
    # "1,500+" deliberately reads 1500 instead of 1.
    check(
        stored,
        lambda c: card.magnitude_number(c, parens=False),
        [
            ("1K+ bought in past month", 1000),
            ("300+ bought in past month", 300),
            ("1,500+ bought", 1500),
            ("no", None),
            (None, None),
        ],
    )


def test_coupon(stored):
    cases = ["Save 15%with coupon (some sizes/colors)", "Save $5 with coupon", None]
    assert parsed(stored, cases, lambda c: card.coupon_columns(c)["coupon"]) == [15.0, None, None]


def test_has_coupon_is_never_null(stored):
    cases = ["Save 15%", "Save $5 with coupon", None]
    assert parsed(stored, cases, lambda c: card.coupon_columns(c)["has_coupon"]) == [True, True, False]


@pytest.mark.parametrize(
    ("original", "price", "expected"),
    [(20.0, 15.0, 25.0), (10.0, 15.0, -50.0), (0.0, 5.0, None), (None, 5.0, None), (5.0, None, None), (3.0, 2.0, 33.33)],
)
def test_discount(stored, original, price, expected):
    rows = stored([(original, price)], "original double, price double")
    assert rows.select(card.discount_pct(F.col("original"), F.col("price"))).first()[0] == expected


def test_brand(stored):
    check(
        stored,
        page.brand_name,
        [("Brand: ACME", "ACME"), ("Visit the X Store", "Visit the X Store"), (" Brand: Y", "Brand: Y"), (None, None)],
    )


def test_seller_ranks(stored):
    rows = stored(
        [
            (0, ["#364 in Clothing, Shoes & Jewelry", "#1 inWomen's Fashion Sweatshirts", "#1,234 in Toys\n(See Top 100 in Games)"]),
            (1, ["in X", None]),
            (2, []),
            (3, None),
        ],
        "i int, texts array<string>",
    )
    out = [r.ranks for r in rows.select("i", page.seller_ranks(F.col("texts")).alias("ranks")).orderBy("i").collect()]
    as_pairs = [None if ranks is None else [(r.rank, r.category) for r in ranks] for ranks in out]
    assert as_pairs == [
        [(364, "Clothing, Shoes & Jewelry"), (1, "Women's Fashion Sweatshirts"), (1234, "Toys")],
        [(None, ""), (None, None)],
        [],
        None,
    ]


def test_dimensions(stored):
    # "12 x 10" deliberately keeps both sides and has no unit.
    cases = [
        ("12.68 x 10.91 x 3.31 inches", (12.68, 10.91, 3.31, "inches")),
        ("12 x 10 inches", (12.0, 10.0, None, "inches")),
        ("12 x 10", (12.0, 10.0, None, "")),
        ("12 x 10 x 5", (12.0, 10.0, 5.0, "")),
        ("12 x 10 x 5inches", (12.0, 10.0, 5.0, "inches")),
        ("round", (None, None, None, "")),
        (None, (None, None, None, None)),
    ]
    out = parsed(stored, [c[0] for c in cases], lambda c: F.struct(*page.dimension_columns(c).values()))
    assert [tuple(r) for r in out] == [c[1] for c in cases]


def test_weight(stored):
    cases = [
        ("14.25 ounces", (14.25, "ounces")),
        ("1.2 Fluid ounces ", (1.2, "Fluid ounces")),
        ("heavy", (None, "")),
        (None, (None, None)),
    ]
    out = parsed(stored, [c[0] for c in cases], lambda c: F.struct(*page.weight_columns(c).values()))
    assert [tuple(r) for r in out] == [c[1] for c in cases]


def test_listing_date(stored):
    check(
        stored,
        page.listing_date,
        [
            ("August 28, 2025", date(2025, 8, 28)),
            (" Aug 28, 2025", date(2025, 8, 28)),
            ("2025-08-28", date(2025, 8, 28)),
            ("May 3, 2024", date(2024, 5, 3)),
            ("28/08/2025", None),
            (None, None),
        ],
    )


def test_rating_shares(stored):
    shares = "struct<`5`: int, `4`: int, `3`: int, `2`: int, `1`: int>"
    rows = stored(
        [(0, (76, 13, 6, 2, 3)), (1, (10, None, None, None, None)), (2, (0, 0, 0, 0, 0)), (3, None)],
        f"i int, overview {shares}",
    )
    columns = page.rating_columns(F.col("overview"))
    out = rows.select("i", *[c.alias(n) for n, c in columns.items()]).orderBy("i").collect()
    assert [r.rating_weighted_avg for r in out] == [4.57, 5.0, None, None]
    assert [r.rating_pct_4 for r in out] == [13.0, 0.0, 0.0, 0.0]


def test_nested_values_of_missing_arrays(stored):
    rows = stored(
        [(0, ["a", "b"], [("x", "u", 1), ("y", "u", 2)]), (1, [], []), (2, None, None)],
        "i int, images array<string>, categories array<struct<name: string, url: string, level: int>>",
    )
    out = rows.select(
        "i",
        F.array_size("images").alias("n"),
        F.get("images", F.lit(0)).alias("first"),
        page.last_name(F.col("categories")).alias("leaf"),
    )
    assert [tuple(r)[1:] for r in out.orderBy("i").collect()] == [(2, "a", "y"), (0, None, None), (None, None, None)]


def test_in_stock(stored):
    check(stored, page.is_in_stock, [("In Stock", True), ("Only 3 left in stock", False), (None, None)])
