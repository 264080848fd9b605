"""One large envelope read in byte ranges, against the read by one task."""

import json
import random

import pytest

from marketlake.sources import feeds, split_json

DAY = "2026-03-04"
ODD = ['a "quoted" {brace}', "back\\slash\\", '}{][}"', "plain", "", '\\"}', "é 语 }", "line\nbreak {"]


@pytest.fixture
def ranges(spark):
    """Byte ranges of 2 KB, so that small files are cut."""
    keys = {"spark.sql.files.maxPartitionBytes": "2048", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def write(root, feed, name, text):
    folder = root / feed.folder / DAY
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


def page(k, rng):
    sizes = {"size_name": rng.choices(ODD, k=2), "color_name": []}
    links = [{"name": rng.choice(ODD), "url": "/}", "level": n} for n in range(k % 3)]
    return {"asin": f"A{k}", "title": rng.choice(ODD), "description": rng.choice(ODD) * 3, "variation_count": k, "available_dimensions": sizes, "categories": links}


def envelope(n, rng, **more):
    stamps = {"metadata": {"type": "x {", "marketplace": rng.choice(["US", "DE"]), "total_products": n, "extracted_at": "2026-03-04T01:00:00"}}
    return stamps | more | {"products": [page(k, rng) for k in range(n)]}


def both(spark, root, feed=feeds.DETAILS):
    rows, bad = split_json.read_split(spark, str(root), feed, [DAY])
    whole = feeds.read_feed(spark, str(root), feed, DAY)
    by_place = lambda df: sorted((r.asDict(recursive=True) for r in df.select(whole.columns).collect()), key=lambda r: (r["source_file"], r["source_position"]))
    return by_place(rows), by_place(whole), {r.source_file: r.reason for r in bad.collect()}


def test_equals_the_read_by_one_task(spark, tmp_path, ranges):
    rng = random.Random(5)
    write(tmp_path, feeds.DETAILS, "pretty.json", json.dumps(envelope(40, rng), indent=2) + "\n\n")
    write(tmp_path, feeds.DETAILS, "tight.json", json.dumps(envelope(60, rng), ensure_ascii=False, separators=(",", ":")))
    late = envelope(20, rng, note='{"products": [{', errors=[{"asin": "E1"}, {"asin": "E2"}])
    write(tmp_path, feeds.DETAILS, "late.json", json.dumps({k: late[k] for k in ("note", "errors", "products", "metadata")}))
    write(tmp_path, feeds.DETAILS, "after.json", json.dumps(envelope(9, rng) | {"other": [{"asin": "O"}], "nested": {"a": {"b": [{}]}}}))
    write(tmp_path, feeds.DETAILS, "none.json", json.dumps(envelope(0, rng)))
    got, want, bad = both(spark, tmp_path)
    assert len(want) == 129 and got == want and bad == {}
    texts = split_json._pieces(spark, [f"{tmp_path}/{feeds.DETAILS.folder}/{DAY}"], "*.json")
    assert texts.rdd.getNumPartitions() > 5 and texts.select("file", "range").distinct().count() > 5


def test_files_that_do_not_close_or_lack_metadata(spark, tmp_path, ranges):
    rng = random.Random(6)
    text = json.dumps(envelope(30, rng))
    write(tmp_path, feeds.DETAILS, "cut.json", text[: len(text) // 2])
    write(tmp_path, feeds.DETAILS, "open.json", text[:-1])
    write(tmp_path, feeds.DETAILS, "quote.json", text + '"')
    write(tmp_path, feeds.DETAILS, "bare.json", json.dumps({"products": [{"asin": "A"}]}))
    write(tmp_path, feeds.DETAILS, "empty.json", "")
    write(tmp_path, feeds.DETAILS, "good.json", text)
    got, want, bad = both(spark, tmp_path)
    assert [r["source_file"] for r in got] == ["good.json"] * 30
    assert got == [r for r in want if r["source_file"] == "good.json"]
    assert bad == {"cut.json": "malformed", "open.json": "malformed", "quote.json": "malformed", "bare.json": "missing_metadata"}


def test_days_without_folder(spark, tmp_path):
    assert split_json.read_split(spark, str(tmp_path), feeds.DETAILS, [DAY]) is None
