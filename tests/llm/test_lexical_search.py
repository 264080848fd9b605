"""Ranked search against brute force: sequential reads on made lists, small shards and blocks, odd rows, ties."""

import collections
import math
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import brute
from marketlake.llm import lexical_search as S


def terms(text):
    return [t.translate(brute._LOWER) for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def ranked(docs, items, top=10):
    own = [(d, collections.Counter(terms(t))) for d, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in own), sum(sum(c.values()) for _, c in own)
    df = collections.Counter(t for _, c in own for t in c)
    asked = collections.defaultdict(set)
    for item, text in items:
        asked[item] |= set(terms(text))
    out = []
    for item, wanted in asked.items():
        scores = []
        for d, c in own:
            m = 10 + 90 * sum(c.values()) * n_docs // max(n_terms, 1)
            scores.append((sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in wanted if c[t]), d))
        best = sorted((s for s in scores if s[0] > 0), key=lambda s: (-s[0], s[1] is None, s[1] or 0))[:top]
        out += [(item, k + 1, d, s) for k, (s, d) in enumerate(best)]
    return sorted(map(repr, out))


def found(docs, items, **options):
    return sorted(repr(tuple(r)) for r in S.search(docs, items, "item_id", **options).collect())


@pytest.mark.parametrize("first_read", [1, 3, 64])
def test_sequential_reads_give_the_best(first_read):
    rng = np.random.default_rng(first_read)
    for _ in range(300):
        n = int(rng.integers(1, 120))
        total, lists = np.zeros(n, np.int64), []
        for _ in range(rng.integers(1, 8)):
            doc = rng.permutation(n)[: rng.integers(0, n + 1)]
            impact = -np.sort(-rng.integers(0, rng.choice([3, 1000]), len(doc)))
            total[doc] += impact
            lists.append((doc, impact))
        doc, score = S.nra(lists, n, 10, first_read)
        assert (score == total[doc]).all() and len(set(doc.tolist())) == len(doc)
        best = np.sort(total[total > 0])[::-1]
        bar = best[9] if len(best) >= 10 else 1
        assert sorted(doc[score >= bar].tolist()) == np.flatnonzero(total >= bar).tolist()


def test_reads_stop_before_the_end():
    """A document of high impacts in every list is known after a few reads of long lists."""

    class Read(np.ndarray):
        last = 0

        def __getitem__(self, key):
            if isinstance(key, slice):
                Read.last = max(Read.last, key.stop)
            return np.asarray(super().__getitem__(key))

    n = 10_000
    lists = [(np.concatenate([np.arange(10), 10 + np.random.default_rng(k).permutation(n - 10)]).view(Read), np.concatenate([np.full(10, 1000), np.arange(n - 10, 0, -1) // 50])) for k in range(3)]
    doc, score = S.nra(lists, n, 10)
    assert sorted(doc.tolist()) == list(range(10)) and (score == 3000).all() and Read.last < n // 10


def test_search_of_tables(spark, sf_dir):
    docs, items = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    assert found(docs, items) == ranked([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])


def test_search_of_odd_rows(spark, odd_documents):
    items = [(1, None), (2, ""), (3, "one TWO"), (4, "word7 is"), (4, "w1 w2 secret99"), (None, "here éè TOKEN"), (5, "no such term"), (6, " ".join(f"w{k}" for k in range(997)))]
    items = spark.createDataFrame(items, "item_id long, text string")
    want = ranked([(r.doc_id, r.text) for r in odd_documents.collect()], [tuple(r) for r in items.collect()])
    assert found(odd_documents, items) == want
    assert found(odd_documents.coalesce(1), items, block_terms=20) == want
    assert found(odd_documents.coalesce(1), items, shard_docs=2) == want


def test_ties_go_by_id(spark):
    docs = spark.createDataFrame([(k, "same words here") for k in range(40, 0, -1)] + [(None, "same words here"), (50, "other")] + [(100 + k, "z") for k in range(60)], "doc_id long, text string").repartition(5)
    items = spark.createDataFrame([("a", "same")], "item_id string, text string")
    assert [(r["rank"], r["doc_id"]) for r in S.search(docs, items, "item_id").orderBy("rank").collect()] == [(k, k) for k in range(1, 11)]
    assert S.search(docs, items, "item_id", top=41).orderBy("rank").collect()[-1]["doc_id"] is None


def test_empty_tables(spark, no_documents, odd_documents):
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert S.search(no_documents, items, "item_id").count() == 0
    assert S.search(odd_documents, items.where("item_id > 1"), "item_id").count() == 0


def test_a_task_holds_one_shard(spark, odd_documents, monkeypatch):
    """Of many shards of a task, one is held at a time: each has a row group and an Arrow batch of its own."""
    tables, batches = [], spark.sparkContext.accumulator(0)

    def stored(*args, _stored=S.stored, **options):
        tables.append((args[1], _stored(*args, **options)))
        return tables[-1][1]

    def sorted_(*args, _sorted=S._impact_sorted):
        return lambda own: _sorted(*args)(counted(own))

    def counted(own):
        for batch in own:
            batches.add(1)
            assert batch.num_rows == 1
            yield batch

    monkeypatch.setattr(S, "stored", stored)
    monkeypatch.setattr(S, "_impact_sorted", sorted_)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    shards, _ = S.index(odd_documents.coalesce(1), shard_docs=2)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
    assert [name for name, _ in tables] == ["search-shards", "search-index"] and shards.count() == batches.value > 3
    for _, table in tables:
        for file in table.inputFiles():
            held = pq.ParquetFile(file.removeprefix("file://")).metadata
            assert {held.row_group(k).num_rows for k in range(held.num_row_groups)} == {1}


def test_shards_are_sorted_in_little_memory(monkeypatch):
    """Lists by falling gain and then by document, whole or in blocks, and few bytes held for each posting."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{k}" for k in rng.zipf(1.3, rng.integers(0, 300)) % 5000) for _ in range(6000)]
    docs = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    tracemalloc.start()
    (shard,) = S._shards(S.SHARD_DOCS, S.SHARD_BYTES)(iter([docs]))
    made = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    read = {c: S._read(shard, c, 0, kind) for c, kind in (("sizes", np.int32), ("docs", np.uint16), ("counts", np.int32), ("lengths", np.int64))}
    own = 10 + 90 * read["lengths"][read["docs"]] * 6000 // 900_000
    gain = 10**9 * read["counts"].astype(np.int64) // (1000 * read["counts"].astype(np.int64) + 8 * own)
    order = np.lexsort((read["docs"], -gain, np.repeat(np.arange(len(read["sizes"])), read["sizes"])))
    for at_once in (1, 1000, S.SORTED_AT_ONCE):
        monkeypatch.setattr(S, "SORTED_AT_ONCE", at_once)
        tracemalloc.start()
        (found,) = S._impact_sorted(6000, 900_000)(iter([shard]))
        held = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert (S._read(found, "docs", 0, np.uint16) == read["docs"][order]).all()
        assert (S._read(found, "gains", 0, np.int32) == gain[order]).all()
    assert held < 64 * min(len(order), S.SORTED_AT_ONCE) + 8 * len(order)
    assert made < 48 * len(order) + 40 * S.W.CHUNK_BYTES
