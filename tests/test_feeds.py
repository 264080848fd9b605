"""Raw JSON envelopes: good, bad, missing and mixed."""

import gzip
import json

import pytest

from marketlake.sources import drift, feeds

DAY = "2026-03-04"


@pytest.fixture
def root(tmp_path):
    return tmp_path / "feeds"


def write(root, feed, name, content, day=DAY):
    folder = root / feed.folder / day
    folder.mkdir(parents=True, exist_ok=True)
    text = content if isinstance(content, str) else json.dumps(content, indent=2)
    (folder / name).write_text(text)


def cards(keyword, *products, **metadata):
    base = {"keyword": keyword, "marketplace": "US", "extracted_at": "2026-03-04T11:21:36.898408"}
    return {"metadata": base | metadata, "products": list(products)}


def read(spark, root, feed=feeds.SEARCH):
    return feeds.read_feed(spark, str(root), feed, DAY)


def bad(spark, root, feed=feeds.SEARCH):
    envelopes = feeds.read_envelopes(spark, str(root), feed, [DAY])
    return {r.source_file: r.reason for r in feeds.quarantined(envelopes, feed).collect()}


def test_rows_carry_metadata_and_origin(spark, root):
    write(root, feeds.SEARCH, "one.json", cards("shoe", {"asin": "A1", "title": " t "}, {"asin": "A2"}))
    rows = {r.asin: r for r in read(spark, root).collect()}
    assert set(rows) == {"A1", "A2"}
    first = rows["A1"]
    assert (first.keyword, first.marketplace, first.title) == ("shoe", "US", " t ")
    assert (first.ingested_at, first.source_file) == (DAY, "one.json")
    assert first.source_extracted_at == "2026-03-04T11:21:36.898408"
    assert rows["A2"].title is None


def test_schema_is_the_declared_one(spark, root):
    write(root, feeds.DETAILS, "one.json", {"metadata": {"marketplace": "US", "extracted_at": "x"}, "products": [{}]})
    found, empty = read(spark, root, feeds.DETAILS), feeds.read_feed(spark, str(root), feeds.DETAILS, "2026-03-05")
    assert sorted(found.dtypes) == sorted(empty.dtypes)
    assert dict(found.dtypes)["ingested_at"] == "string"


def test_missing_and_empty_folders_give_no_rows(spark, root):
    assert read(spark, root).count() == 0
    (root / "search" / DAY).mkdir(parents=True)
    assert read(spark, root).count() == 0
    (root / "search" / DAY / "notes.txt").write_text("not a feed file")
    assert read(spark, root).count() == 0


def test_subfolders_are_not_read(spark, root):
    write(root, feeds.SEARCH, "one.json", cards("k", {"asin": "A1"}))
    write(root, feeds.SEARCH, "old.json", cards("k", {"asin": "A0"}), day=f"{DAY}/archive")
    assert [r.asin for r in read(spark, root).collect()] == ["A1"]


def test_truncated_file_is_reported_and_the_rest_kept(spark, root):
    write(root, feeds.SEARCH, "good.json", cards("k", {"asin": "A1"}))
    write(root, feeds.SEARCH, "cut.json", json.dumps(cards("k", {"asin": "A2"}))[:60])
    assert [r.asin for r in read(spark, root).collect()] == ["A1"]
    assert bad(spark, root) == {"cut.json": "malformed"}


def test_only_bad_files_give_no_rows(spark, root):
    write(root, feeds.SEARCH, "cut.json", "{")
    assert read(spark, root).count() == 0
    assert bad(spark, root) == {"cut.json": "malformed"}


def test_missing_metadata_is_reported(spark, root):
    write(root, feeds.SEARCH, "no_keyword.json", cards(None, {"asin": "A1"}))
    assert read(spark, root).count() == 0
    assert bad(spark, root) == {"no_keyword.json": "missing_metadata"}


def test_files_of_different_shape_share_one_schema(spark, root):
    write(root, feeds.SEARCH, "a.json", cards("k", {"asin": "A1", "unknown_field": 1}))
    write(root, feeds.SEARCH, "b.json", cards("k", {"asin": "A2", "coupon": None, "rating": 4.5}))
    rows = {r.asin: r for r in read(spark, root).collect()}
    assert rows["A2"].rating == "4.5" and rows["A2"].coupon is None
    assert "unknown_field" not in rows["A1"].asDict()


def test_field_of_another_type_keeps_the_other_products(spark, root):
    details = {
        "metadata": {"marketplace": "US", "extracted_at": "2026-03-04T11:21:36"},
        "products": [{"asin": "A1", "variation_count": "many"}, {"asin": "A2", "variation_count": 3}],
    }
    write(root, feeds.DETAILS, "odd.json", details)
    rows = {r.asin: r.variation_count for r in read(spark, root, feeds.DETAILS).collect()}
    assert rows == {"A1": None, "A2": 3}
    assert bad(spark, root, feeds.DETAILS) == {"odd.json": "partial"}


def test_envelope_per_line_and_named_day_folders(spark, root):
    folder = root / "search" / f"day={DAY}"
    folder.mkdir(parents=True)
    lines = [json.dumps(cards("k", {"asin": f"A{n}"})) for n in range(3)]
    (folder / "part.json").write_text("\n".join(lines))
    rows = feeds.flatten(feeds.read_envelopes(spark, str(root), feeds.SEARCH, [DAY], multi_line=False), feeds.SEARCH)
    assert {(r.asin, r.ingested_at) for r in rows.collect()} == {("A0", DAY), ("A1", DAY), ("A2", DAY)}


def test_fields_beyond_the_declared_schema(spark, tmp_path):
    """New and retyped fields at every depth, NULLs, numbers where texts are declared, unreadable records."""
    folder = tmp_path / "details" / "2026-03-04"
    folder.mkdir(parents=True)
    clean = {"asin": "a", "title": None, "variation_count": 2, "categories": [{"name": "n", "url": None, "level": 1}], "rating_overview": {"5": 1}}
    odd = {
        "asin": 5, "variation_count": 2.5, "is_fba": "yes", "images": ["x", 3, None], "categories": {"name": "n"}, "extra": {"deep": [1, {"x": True}]},
        "rating_overview": {"5": "many", "0": 1}, "available_dimensions": {"size_name": "s"}, "variations": [{"asin": "v", "odd": [1]}, 7],
    }
    meta = {"type": "t", "marketplace": "US", "total_products": 2, "extracted_at": "2026-03-04T00:00:00"}
    (folder / "a.json").write_text(json.dumps({"metadata": meta, "products": [clean, odd, clean]}))
    (folder / "b.json").write_text(json.dumps({"metadata": meta | {"version": 3}, "products": "none", "more": []}))
    (folder / "c.json").write_text('{"metadata": {"type": "t", "type": "u"}, "products": []}')
    (folder / "d.json").write_text(json.dumps({"metadata": meta, "products": [clean]}))
    rows = drift.drifted(spark, str(tmp_path), feeds.DETAILS, ["2026-03-04"])
    found = {(r.source_file, r.source_position): {(f.field, f.declared, f.observed, f.value) for f in r.fields} for r in rows.collect()}
    assert found == {
        ("a.json", 1): {
            ("asin", "string", "BIGINT", "5"), ("variation_count", "int", "DECIMAL", "2.5"), ("is_fba", "boolean", "STRING", '"yes"'), ("images[]", "string", "BIGINT", "3"),
            ("categories", "array", "OBJECT", '{"name":"n"}'), ("extra", None, "OBJECT", '{"deep":[1,{"x":true}]}'), ("rating_overview.5", "int", "STRING", '"many"'),
            ("rating_overview.0", None, "BIGINT", "1"), ("available_dimensions.size_name", "array", "STRING", '"s"'), ("variations[].odd", None, "ARRAY", "[1]"), ("variations[]", "struct", "BIGINT", "7"),
        },
        ("b.json", None): {("metadata.version", None, "BIGINT", "3"), ("products", "array", "STRING", '"none"'), ("more", None, "ARRAY", "[]")},
        ("c.json", None): {("$", "struct", "UNREADABLE", None)},
    }
    report = {(r.field, r.change, r.seen) for r in drift.drift_report(rows, feeds.DETAILS).collect()}
    assert {("extra", "new", 1), ("asin", "retyped", 1), ("$", "unreadable", 1)} <= report
    assert drift.drifted(spark, str(tmp_path), feeds.SEARCH, ["2026-03-04"]) is None


def test_compressed_files_are_read_like_plain_ones(spark, tmp_path):
    folder = tmp_path / feeds.SEARCH.folder / "2026-03-04"
    folder.mkdir(parents=True)
    for name, asin, opened in (("a.json", "A1", open), ("b.json.gz", "A2", gzip.open)):
        with opened(folder / name, "wt") as file:
            file.write(json.dumps({"metadata": {"keyword": "k", "marketplace": "US", "extracted_at": "t"}, "products": [{"asin": asin}]}))
    rows = feeds.read_feed(spark, str(tmp_path), feeds.SEARCH, "2026-03-04").collect()
    assert sorted((r.asin, r.source_file) for r in rows) == [("A1", "a.json"), ("A2", "b.json.gz")]
