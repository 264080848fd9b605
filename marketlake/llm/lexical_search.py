"""Ranked lexical search by sequential reads of impact-sorted lists, with no random access (NRA).

The index is cut by documents: a shard holds a bounded number of documents and bytes, with each term's postings sorted by
falling impact. Queries come in blocks of bounded size; a task reads its shards' lists from the front for each query, a step
at a time, and keeps for each document the sum of what was read (its lower score) and that sum plus the next unread
impact of every list in which it was not met yet (its upper score). Reading goes on until no unread document can reach the
tenth best lower score, and every document that still can has equal lower and upper scores, so that ties are known too.
Shards send their best rows, of which the best are kept. Postings are never shuffled. A task holds one shard at a time, however
many it writes or reads: each is a row group of its own and a batch of its own.

Scores are whole numbers: a term's weight is floor(1000 * ln((2 * N + 2) / (2 * df + 1))), a posting's impact that times
(10**9 * tf) div (1000 * tf + 8 * m), where m = 100 - 90 + (90 * n * N) div L. Terms are told apart by 64-bit hashes.

Cases: a null or empty text has no terms, is no result and, as a query, has none. Rows of one query id are one query; a null
id is an id of its own. Rows that repeat a doc_id are documents of their own, each with its place. Equal scores are ordered by
doc_id, null last. Texts of any length are read whole; a longer one than a shard's bytes has a shard of its own. Extra
columns are dropped; without queries or documents the result is empty.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm import words as W
from marketlake.llm.scratch import row_by_row, stored

#: Bounds of a shard, which fit a task's memory; documents of a shard are numbered by 16 bits.
SHARD_DOCS, SHARD_BYTES = 16_384, 24 << 20
#: Distinct terms, summed over queries, that one pass over the index serves.
BLOCK_TERMS = 200_000
#: Postings that are first read of each list; every further step reads as many as all before.
FIRST_READ = 64
#: Postings that are put in order at once, whole lists.
SORTED_AT_ONCE = 1 << 18
TOP = 10

_SHARD = "n_docs long, n_terms long, ids binary, known binary, lengths binary, terms binary, sizes binary, docs binary, counts binary"
_SORTED = "ids binary, known binary, terms binary, sizes binary, docs binary, gains binary"


def _cell(values: np.ndarray) -> pa.Array:
    """The bytes of `values` as a column of one row, not copied."""
    values = np.ascontiguousarray(values)
    return pa.Array.from_buffers(pa.binary(), 1, [None, pa.py_buffer(np.array([0, values.nbytes], np.int32)), pa.py_buffer(values)])


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    """All parts in one array; the list is emptied."""
    out = np.concatenate(parts)
    parts.clear()
    return out


def _shards(shard_docs: int, shard_bytes: int):
    """Postings of the documents of a task, by term, a row for each shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, known, lengths, terms, docs, counts = [], [], [], [], [], []
        rows = size = 0

        def flush() -> pa.RecordBatch:
            term = _joined(terms)
            order = np.argsort(term, kind="stable")
            term, doc, count = term[order], _joined(docs)[order], _joined(counts)[order]
            del order
            first = np.flatnonzero(np.concatenate([np.ones(min(1, len(term)), bool), term[1:] != term[:-1]]))
            length = _joined(lengths)
            own = [_joined(ids), _joined(known), length.astype(np.int64), term[first], np.diff(np.append(first, len(term))).astype(np.int32), doc, count]
            held = [pa.array([int((length > 0).sum())], pa.int64()), pa.array([int(length.sum())], pa.int64())]
            return pa.RecordBatch.from_arrays(held + [_cell(a) for a in own], [c.split()[0] for c in _SHARD.split(", ")])

        for batch in batches:
            for texts in W.chunks(batch.column(1)):
                for a in range(0, texts.rows, shard_docs):
                    part = W.Texts(texts.first_row + a, texts.data[texts.begin[a] : texts.begin[min(a + shard_docs, texts.rows)]], texts.begin[a : a + shard_docs + 1] - texts.begin[a])
                    if rows and (rows + part.rows > shard_docs or size + len(part.data) > shard_bytes):
                        yield flush()
                        rows = size = 0
                    found = W.words(part, W.WORDLIKE)
                    code, row = W.hashes(part, found), found.row
                    order = np.lexsort((code, row))
                    code, row = code[order], row[order]
                    new = np.flatnonzero(np.concatenate([np.ones(min(1, len(code)), bool), (code[1:] != code[:-1]) | (row[1:] != row[:-1])]))
                    terms.append(code[new])
                    docs.append((row[new] + rows).astype(np.uint16))
                    counts.append(np.diff(np.append(new, len(code))).astype(np.int32))
                    lengths.append(np.diff(found.first))
                    id_ = batch.column(0).slice(part.first_row, part.rows)
                    known.append(np.asarray(id_.is_valid().to_numpy(zero_copy_only=False), bool))
                    ids.append(id_.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
                    rows, size = rows + part.rows, size + len(part.data)
        if rows:
            yield flush()

    return run


def _read(batch: pa.RecordBatch, name: str, row: int, kind) -> np.ndarray:
    return np.frombuffer(batch.column(name)[row].as_buffer(), kind)


def _impact_sorted(all_docs: int, all_terms: int):
    """Each list of a shard by falling gain, the part of the impact that is the posting's own; equal ones by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                length, back = np.unique(_read(batch, "lengths", r, np.int64), return_inverse=True)
                own = np.array([100 - 90 + 90 * int(n) * all_docs // max(all_terms, 1) for n in length], np.int64)[back]  # whole numbers of any size
                sizes, doc = _read(batch, "sizes", r, np.int32), _read(batch, "docs", r, np.uint16)
                count, first = _read(batch, "counts", r, np.int32), np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
                docs, gains, a = np.empty(len(doc), np.uint16), np.empty(len(doc), np.int32), 0
                while a < len(sizes):
                    b = max(a + 1, int(np.searchsorted(first, first[a] + SORTED_AT_ONCE, side="right")) - 1)
                    some = slice(first[a], first[b])
                    n = count[some].astype(np.int64)
                    gain = 1_000_000_000 * n // (1000 * n + 8 * own[doc[some]])  # less than a million, which 20 bits hold
                    order = (np.repeat(np.arange(b - a), sizes[a:b]) << 36) | (((1 << 20) - 1 - gain) << 16) | doc[some]
                    order.sort()
                    docs[some], gains[some] = order & 0xFFFF, (1 << 20) - 1 - ((order >> 16) & ((1 << 20) - 1))
                    a = b
                cells = [batch.column(c).slice(r, 1) for c in ("ids", "known", "terms", "sizes")] + [_cell(docs), _cell(gains)]
                yield pa.RecordBatch.from_arrays(cells, [c.split()[0] for c in _SORTED.split(", ")])

    return run


def nra(lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int, top: int, first_read: int = FIRST_READ) -> tuple[np.ndarray, np.ndarray]:
    """Documents that can be among the `top` best, ties with the last of them included, and their final scores.

    A list holds documents and impacts by falling impact; every document at most once.
    """
    lower = np.zeros(n_docs, np.int64)
    live = np.ones(n_docs, bool)
    unread = np.array([impact[0] if len(impact) else 0 for _, impact in lists], np.int64)
    done, depth, closed = 0, first_read, False
    while True:
        for t in np.flatnonzero(unread):
            doc, impact = lists[t][0][done:depth], lists[t][1][done:depth]
            if closed:
                own = live[doc]
                doc, impact = doc[own], impact[own]
            lower[doc] += impact
            unread[t] = lists[t][1][depth] if depth < len(lists[t][1]) else 0
        done, depth = depth, 2 * depth
        some = np.flatnonzero(live & (lower > 0))
        bar = np.partition(lower[some], len(some) - top)[len(some) - top] if len(some) >= top else 0
        rest = int(unread.sum())
        if not closed and 0 < rest >= bar:
            continue  # a document that was not met yet can still come in
        closed = True
        missing = np.full(n_docs, rest, np.int64)  # what the lists in which a document was not met can still add
        for t in np.flatnonzero(unread):
            missing[lists[t][0][:done]] -= unread[t]
        some = some[lower[some] + missing[some] >= bar]
        if not missing[some].any():
            return some, lower[some]
        live[:] = False
        live[some] = True
        for t in np.flatnonzero(unread):  # a list in which every document left was met is not read on
            if live[lists[t][0][:done]].sum() == len(some):
                unread[t] = 0


def _search(queries: list[tuple[int, np.ndarray, np.ndarray]], top: int):
    """The best rows of each query in each shard: (query, doc_id, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                terms, sizes = _read(batch, "terms", r, np.uint64), _read(batch, "sizes", r, np.int32)
                docs, gains = _read(batch, "docs", r, np.uint16), _read(batch, "gains", r, np.int32)
                ids, known = _read(batch, "ids", r, np.int64), _read(batch, "known", r, bool)
                first = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
                out = []
                for query, own, weight in queries:
                    at = np.searchsorted(terms, own)
                    at[at == len(terms)] = 0
                    here = (terms[at] == own) & (weight > 0) if len(terms) else np.zeros(len(own), bool)
                    lists = [(docs[first[k] : first[k + 1]], gains[first[k] : first[k + 1]] * w) for k, w in zip(at[here], weight[here], strict=True)]
                    if not lists:
                        continue
                    doc, score = nra(lists, len(ids), top)
                    best = np.lexsort((ids[doc], ~known[doc], -score))[:top]
                    out.append((np.full(len(best), query), doc[best], score[best]))
                if out:
                    query, doc, score = (np.concatenate(c) for c in zip(*out, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(ids[doc], mask=~known[doc]), pa.array(score)], ["query", "doc_id", "score"])

    return run


def _holders(wanted: np.ndarray):
    """Documents of each shard that hold a wanted term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                terms, sizes = _read(batch, "terms", r, np.uint64), _read(batch, "sizes", r, np.int32)
                own = np.isin(terms, wanted, assume_unique=True)
                yield pa.RecordBatch.from_arrays([pa.array(terms[own].view(np.int64)), pa.array(sizes[own].astype(np.int64))], ["term", "df"])

    return run


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct terms of each row, with the row's number."""
    for batch in batches:
        for texts in W.chunks(batch.column(1)):
            found = W.words(texts, W.WORDLIKE)
            both = np.unique(np.rec.fromarrays([found.row, W.hashes(texts, found)], names="row,term"))
            row = batch.column(0).slice(texts.first_row, texts.rows).take(pa.array(both.row))
            yield pa.RecordBatch.from_arrays([row, pa.array(np.ascontiguousarray(both.term).view(np.int64))], ["row", "term"])


def index(documents: DataFrame, shard_docs: int = SHARD_DOCS, shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, int]:
    """The impact-sorted shards of `documents`, written, and the number of documents with a term."""
    shards = stored(documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(_shards(shard_docs, shard_bytes), _SHARD), "search-shards", large_rows=True)
    n_docs, n_terms = shards.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    own = shards.drop("n_docs", "n_terms").mapInArrow(_impact_sorted(n_docs or 0, n_terms or 0), _SORTED)
    with row_by_row(documents.sparkSession):
        return stored(own, "search-index", large_rows=True), n_docs or 0


def search(documents: DataFrame, queries: DataFrame, query_id: str, top: int = TOP, block_terms: int = BLOCK_TERMS, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """(query_id, rank, doc_id, score): the `top` best documents with a score above 0 for each id of `queries`."""
    rows = stored(queries.select(F.monotonically_increasing_id().alias("row"), F.col(query_id).alias("id"), "text"), "queries")
    terms = rows.select("row", "text").mapInArrow(_query_terms, "row long, term long")
    asked = terms.join(rows.select("row", "id"), "row").groupBy("id").agg(F.collect_set("term").alias("terms"))  # a query's own vocabulary
    asked = stored(asked.select(F.monotonically_increasing_id().alias("query"), "id", "terms"), "query-terms")
    blocks = -(-(asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // block_terms)
    sorted_shards, n_docs = index(documents, shard_docs) if blocks else (None, 0)
    best = []
    for block in range(blocks):  # a pass over the index serves a block of queries, dealt by hash
        own = asked.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == block).select("query", "terms").collect()
        wanted = np.unique(np.array([t for r in own for t in r["terms"]], np.int64)).view(np.uint64)
        wanted.sort()
        with row_by_row(documents.sparkSession):
            df = sorted_shards.select("terms", "sizes").mapInArrow(_holders(wanted), "term long, df long").groupBy("term").agg(F.sum("df")).collect()
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df}  # terms of the block only
        found = [(r["query"], np.array([t for t in r["terms"] if t in weight], np.int64)) for r in own]
        found = [(q, t.view(np.uint64), np.array([weight[x] for x in t.tolist()], np.int64)) for q, t in found]
        with row_by_row(documents.sparkSession):
            best.append(stored(sorted_shards.mapInArrow(_search(found, top), "query long, doc_id long, score long"), "search-best"))
    if not best:
        best = [documents.sparkSession.createDataFrame([], "query long, doc_id long, score long")]
    first = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = functools.reduce(DataFrame.union, best).withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)
    return ranked.join(asked.select("query", F.col("id").alias(query_id)), "query").select(query_id, "rank", "doc_id", "score")
