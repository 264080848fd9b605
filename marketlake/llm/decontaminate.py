"""Winnowing: the smallest k-gram hash of each sliding window is a text's fingerprint; shared fingerprints are extended.

With k-grams of 5 words and windows of 6 k-grams, any 10 words that a document and an item share give both the same
fingerprint, so no shared span of 10 words is missed. Documents drop fingerprints that no item has by a Bloom filter of a
fixed size, the rest are joined by hash, and each pair of document and item is extended word by word. Items of fewer words
than a window are looked for whole, at every place.

Cases: a null or empty text has no words and is never hit; an item without words occurs nowhere. Rows of one item_id count
as one item; a null item_id is the item of the empty id. Repeated documents are judged row by row. Extra columns are dropped;
with no items no document is hit, and without documents the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm import words as W
from marketlake.llm.bloom import build, may_hold
from marketlake.llm.scratch import stored, text_key, without

WINDOW_WORDS = 10
GRAM_WORDS = 5
BLOOM_BITS = 1 << 23


def winnow(codes: np.ndarray, gram: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the k-grams that are smallest in some `window` of them; ties are all kept.

    Windows over the border of two texts only add places, so texts may stand end to end.
    """
    value = W.grams(codes, gram)
    value[max(0, len(codes) - gram + 1) :] = np.iinfo(np.uint64).max
    if len(value) < window:
        return np.arange(len(value)), value
    least = np.lib.stride_tricks.sliding_window_view(value, window).min(axis=1)
    pad = np.zeros(window - 1, W.U64)
    most = np.lib.stride_tricks.sliding_window_view(np.concatenate([pad, least, pad]), window).max(axis=1)
    place = np.flatnonzero(most == value)
    return place, value[place]


def _tagged(value: np.ndarray, size: int) -> np.ndarray:
    """Hashes of whole items of `size` words, kept apart from fingerprints."""
    return W.mix(value + W.U64(size) * W.U64(0xD6E8FEB86659FD93))


def _item_prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts in W.chunks(batch.column(1)):
            found = W.words(texts, W.WORDLIKE)
            codes = W.hashes(texts, found)
            for r in range(texts.rows):
                own = codes[found.first[r] : found.first[r + 1]]
                if len(own) >= WINDOW_WORDS:
                    prints, short = np.unique(winnow(own, GRAM_WORDS, WINDOW_WORDS - GRAM_WORDS + 1)[1]), 0
                elif len(own):
                    prints, short = _tagged(W.grams(own, len(own))[:1], len(own)), len(own)
                else:
                    continue
                n = len(prints)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[texts.first_row + r].as_py()] * n, pa.int64()), pa.array([short] * n, pa.int32()), pa.array(prints.view(np.int64))],
                    ["item_row", "short", "print"],
                )


def _doc_prints(bloom: np.ndarray, shorts: list[int]):
    """Of each document: its words, the fingerprints that the filter lets through, and its text if there are any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(3)
            for texts in W.chunks(text):
                found = W.words(texts, W.WORDLIKE)
                codes = W.hashes(texts, found)
                place, value = winnow(codes, GRAM_WORDS, WINDOW_WORDS - GRAM_WORDS + 1)
                ok = may_hold(bloom, value)
                place, value = [place[ok]], [value[ok]]
                for size in shorts:
                    at = np.flatnonzero(W.whole(found, size))
                    own = _tagged(W.grams(codes, size)[at], size)
                    ok = may_hold(bloom, own)
                    place.append(at[ok])
                    value.append(own[ok])
                place, value = np.concatenate(place), np.concatenate(value)
                row = np.searchsorted(found.first, place, side="right") - 1
                order = np.argsort(row, kind="stable")
                first = np.searchsorted(row[order], np.arange(texts.rows + 1))
                has = np.diff(first) > 0
                rows = slice(texts.first_row, texts.first_row + texts.rows)
                some = text.slice(rows.start, texts.rows).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(rows.start, texts.rows),
                        batch.column(1).slice(rows.start, texts.rows),
                        batch.column(2).slice(rows.start, texts.rows),
                        pa.array(np.diff(found.first).astype(np.int64)),
                        W.lists(value[order].view(np.int64), first, pa.int64()),
                        some.take(pa.array(np.arange(texts.rows), mask=~has)),
                    ],
                    ["row_id", "doc_id", "text_key", "n_words", "prints", "text"],
                )

    return run


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word ranges of each document (end exclusive) that lie in occurrences of the item's windows."""
    for batch in batches:
        for i in range(batch.num_rows):
            codes = []
            for c in (2, 3):
                texts = next(W.chunks(batch.column(c).slice(i, 1)))
                codes.append(W.hashes(texts, W.words(texts, W.WORDLIKE)))
            doc, item = codes
            size = min(WINDOW_WORDS, len(item))
            if not size or len(doc) < size:
                continue
            at = np.flatnonzero(np.isin(W.grams(doc, size)[: len(doc) - size + 1], W.grams(item, size)[: len(item) - size + 1]))
            if not len(at):
                continue
            cut = np.flatnonzero(np.diff(at) > size) + 1
            start, end = at[np.concatenate([[0], cut])], at[np.concatenate([cut - 1, [-1]])] + size
            spans = [{"s": int(a), "e": int(b)} for a, b in zip(start, end, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), pa.array([spans], pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())])))],
                ["row_id", "item_id", "spans"],
            )


def _covered(spans):
    """Words in the union of ranges."""
    start = F.struct(F.lit(0).cast("long").alias("e"), F.lit(0).cast("long").alias("n"))

    def add(a, x):
        return F.struct(F.greatest(a["e"], x["e"]).alias("e"), (a["n"] + F.greatest(F.lit(0).cast("long"), x["e"] - F.greatest(a["e"], x["s"]))).alias("n"))

    return F.aggregate(F.array_sort(spans), start, add)["n"]


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: words, words inside item windows, and the items with occurring windows."""
    items = stored(benchmark.select(F.monotonically_increasing_id().alias("item_row"), F.col("item_id").cast("string").alias("item_id"), "text"), "bench-items")
    prints = stored(items.select("item_row", "text").mapInArrow(_item_prints, "item_row long, short int, print long"), "bench-prints")
    shorts = [r.short for r in prints.where("short > 0").select("short").distinct().collect()]  # below WINDOW_WORDS: nine at most
    docs = documents.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", text_key(), "text")
    scan = _doc_prints(build(prints, "print", BLOOM_BITS), shorts)
    docs = stored(docs.mapInArrow(scan, "row_id long, doc_id long, text_key long, n_words long, prints array<long>, text string"), "doc-prints")
    pairs = docs.select("row_id", F.explode("prints").alias("print")).join(prints.select("item_row", "print"), "print").select("row_id", "item_row").distinct()
    pairs = pairs.join(docs.where("text is not null").select("row_id", "text"), "row_id")
    pairs = pairs.join(items.select("item_row", "item_id", F.col("text").alias("item_text")), "item_row")
    spans = pairs.select("row_id", "item_id", "text", "item_text").mapInArrow(_extend, "row_id long, item_id string, spans array<struct<s:long,e:long>>")
    hits = spans.groupBy("row_id").agg(
        _covered(F.flatten(F.collect_list("spans"))).alias("n_hit"), F.array_sort(F.collect_set(F.coalesce("item_id", F.lit("")))).alias("items")
    )
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    return docs.select("row_id", "doc_id", "text_key", "n_words").join(hits, "row_id", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(items_of).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items_of).cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        "text_key",
    )


def drop_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`documents` without those that hold a window of an item."""
    return without(documents, contamination(documents, benchmark).where("contaminated"))
