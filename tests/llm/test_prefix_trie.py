"""The trie against a plain one in Python: made conversations, odd rows, lists ranked in many rounds."""

import collections
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from marketlake.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    turns = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            turns[conv].append((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    turns = {c: [t[3:] for t in sorted(own)] for c, own in turns.items()}
    nodes, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, own in sorted(turns.items()):
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(c - 100 * int(c / 100))
        rebuilt = tuple(turns.get(base, [])[:h] + own[h:])
        for d in range(len(rebuilt) + 1):
            nodes[rebuilt[:d]].append(c)
        ends[rebuilt].append(c)
    kids = collections.defaultdict(list)
    for n in nodes:
        if n:
            kids[n[:-1]].append(n)
    leaves, saved = {}, {}
    for n in sorted(nodes, key=len, reverse=True):
        leaves[n] = sum(leaves[k] for k in kids[n]) or 1
        saved[n] = sum(saved[k] for k in kids[n]) + ((len(nodes[n]) - 1) * len(n[-1][1]) if n else 0)
    return sorted(
        repr((nodes[n][0], len(n), nodes[n[:-1]][0] if n else None, len(nodes[n]), len(kids[n]), leaves[n], saved[n], hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest()))
        for n in nodes
    )


def found(df, **options):
    return sorted(repr(tuple(r)) for r in T.prefix_trie(df, **options).collect())


@pytest.mark.parametrize(("size", "block"), [(1, 5), (2, 1), (500, 1), (500, 40)])
def test_list_ranks(spark, size, block):
    arcs = random.Random(size).sample(range(10 * size), size)
    rows = spark.createDataFrame([(a, b) for a, b in zip(arcs, [*arcs[1:], None], strict=True)], "arc long, next long").repartition(3)
    assert sorted(map(tuple, T.list_ranks(rows, block).collect())) == sorted((a, k) for k, a in enumerate(arcs))


def test_prefix_sums_over_bins(spark, monkeypatch):
    monkeypatch.setattr(T, "SUM_BLOCK", 7)
    rows = spark.range(1000).select(F.col("id").alias("place"), (F.col("id") * 3 % 11).alias("v"))
    total, want = 0, []
    for k in range(1000):
        total += k * 3 % 11
        want.append((k, total))
    assert sorted(map(tuple, T.prefix_sums(rows, ["v"]).collect())) == want


def test_trie_of_made_conversations(spark):
    """Shared openings, copies, a conversation that holds a third of all turns, turns without order, negative ids, gaps."""
    rng = random.Random(1)
    rows = []
    for conv in [*range(-5, 120), *rng.sample(range(120, 5000), 60), 10**12]:
        rows += [(conv, t, rng.choice(["user", "assistant"]) if t % 2 else None, rng.choice(["a", "bé😀", "", None, "long text"])) for t in range(rng.choice([0, 1, 2, 3, 5, 9]))]
    rows += [(7, t, "user", f"turn {t % 50}") for t in range(20, 400)]
    rows += [(200 + k, t, "user", "copy") for k in range(1, 90) for t in range(2)] + [(8, None, "x", "y"), (8, None, "x", "y"), (8, None, None, None), (None, 1, "a", "b")]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, "extra", 1) for r in rows], SCHEMA + ", node string, bin int").repartition(5)
    assert found(df, block=50) == plain(rows)


def test_long_lists_of_ends_are_hashed_in_order(spark):
    rows = [(c, 9, "user", "same") for c in range(0, 4500, 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert found(df) == plain(rows)


def test_trie_of_tables(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    assert found(df) == plain([(r.conv_id, r.turn, r.role, r.text) for r in df.collect()])


def test_empty_table(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []
    assert found(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)) == []
