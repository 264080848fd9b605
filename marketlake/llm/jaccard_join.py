"""Grouped prefix join of documents by the Jaccard similarity of their 5-word shingles, and the classes it links.

1. Every document's distinct shingles are counted into a table of a fixed number of counters. Shingles are ordered by
   counter and hash, rare first; any fixed order gives right results, this one gives few candidates.
2. A set of n shingles is looked up by its first n - ceil(0.8 n) + 1. Documents of one size and prefix are one group.
3. A shingle's groups are paired by size and place in the prefix; pairs of groups are expanded to their members, and the
   members' texts are compared exactly.

Only links that can join two classes are looked for. First each group meets, for each shingle of its prefix, the shingle's
most central group, and the links found make classes; then all pairs of groups of different classes. A pair in one
class can be left out, as its link would not change the result. So a thousand copies of one text cost a thousand
comparisons. Equal sets count as one node throughout.

Cases: a null or empty text, or one without words, has no shingles and is linked with nothing; its component is its own
doc_id. Rows may repeat a doc_id, with equal or different texts: each row gets its own text's component. A null doc_id is
passed over as the smallest of a component. Extra columns are dropped; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm import words as W
from marketlake.llm.bloom import build, may_hold
from marketlake.llm.components import components, merged
from marketlake.llm.scratch import cores, stored, text_key, without

SHINGLE_WORDS = 5
COUNTERS = 1 << 20
_SLICES = 64
SHARD_TOKENS = 4_000_000
_PAIR = "a long, b long"


def set_hash(value: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of each set, from sums of its shingles' hashes."""
    total = np.concatenate([np.zeros(1, W.U64), np.cumsum(W.mix(value ^ W.U64(0xA5A5A5A55A5A5A5A)), dtype=W.U64)])
    return W.mix((total[first[1:]] - total[first[:-1]]) + np.diff(first).astype(W.U64) * W.U64(0x9E3779B97F4A7C15))


def prefix_length(n: np.ndarray) -> np.ndarray:
    return np.where(n > 0, n - (4 * n + 4) // 5 + 1, 0)


def required(a, b):
    """Common shingles that make 100 * common >= 80 * union, for sets of a and b shingles."""
    return (4 * (a + b) + 8) // 9


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents hold a shingle of each counter, one row for each slice of the counters."""
    total = np.zeros(COUNTERS, np.int64)
    for batch in batches:
        for texts in W.chunks(batch.column(0)):
            value, _ = W.shingle_sets(texts, SHINGLE_WORDS)
            total += np.bincount((value >> W.U64(44)).astype(np.int64), minlength=COUNTERS)
    if total.any():
        parts = [x.astype("<u4" if total.max() < 1 << 32 else "<u8").tobytes() for x in total.reshape(_SLICES, -1)]
        yield pa.RecordBatch.from_arrays([pa.array(range(_SLICES), pa.int32()), pa.array(parts, pa.binary())], ["slice", "counts"])


def _levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Logarithms of the counters' sums, a sixteenth of a doubling a step, by slice."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = np.frombuffer(blob, "<u4" if len(blob) == 4 * COUNTERS // _SLICES else "<u8").astype(np.int64)
            sums[k] = sums[k] + own if k in sums else own
    for k, v in sums.items():
        level = np.minimum(np.log2(v + 1) * 16, 1023).astype("<i2")
        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([level.tobytes()], pa.binary())], ["slice", "levels"])


def shingle_levels(documents: DataFrame) -> np.ndarray:
    """Of each counter the logarithm of its count, COUNTERS small numbers whatever the input; the counts stay with the tasks,
    which add up their own first, then tasks by slice."""
    parts = documents.select("text").mapInArrow(_tally, "slice int, counts binary").repartition(_SLICES, "slice")
    out = np.zeros((_SLICES, COUNTERS // _SLICES), np.int16)
    for row in parts.mapInArrow(_levels, "slice int, levels binary").collect():
        out[row["slice"]] = np.frombuffer(row["levels"], "<i2")
    return out.ravel()


def _bitmap(value: np.ndarray) -> bytes:
    """Parities of a set's hashes by bit. The bits in which two differ are at most the shingles of one set only."""
    bits = min(1 << 16, 1 << max(8, int(2 * len(value) - 1).bit_length()))
    odd = np.bincount((value & W.U64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def _signatures(level: np.ndarray):
    """Of each document: set size and hash, group, centrality, prefix in order, and bitmap."""
    names = ["doc_id", "text_key", "n", "node", "grp", "central", "prefix", "bitmap"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in W.chunks(batch.column(2)):
                value, first = W.shingle_sets(texts, SHINGLE_WORDS)
                n = np.diff(first)
                own = level[(value >> W.U64(44)).astype(np.int64)]
                length = prefix_length(n)
                prefix, groups, central, bitmaps = [], np.zeros(len(n), W.U64), np.zeros(len(n), np.float32), []
                for r in range(len(n)):
                    part, rank = value[first[r] : first[r + 1]], own[first[r] : first[r + 1]]
                    # value is ascending, so a stable sort by level breaks ties by hash
                    prefix.append(part[np.argsort(rank, kind="stable")[: length[r]]])
                    if n[r]:
                        groups[r] = W.grams(prefix[-1], len(prefix[-1]))[0] + W.U64(n[r])
                        central[r] = rank.mean()
                    bitmaps.append(_bitmap(part) if n[r] else b"")
                ends = np.concatenate([[0], np.cumsum(length)])
                flat = np.concatenate(prefix) if prefix else np.zeros(0, W.U64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(texts.first_row, texts.rows),
                        batch.column(1).slice(texts.first_row, texts.rows),
                        pa.array(n.astype(np.int32)),
                        pa.array(set_hash(value, first).view(np.int64)),
                        pa.array(W.mix(groups).view(np.int64)),
                        pa.array(central),
                        W.lists(flat.view(np.int64), ends, pa.int64()),
                        pa.array(bitmaps, pa.binary()),
                    ],
                    names,
                )

    return run


def shared_tokens(groups: DataFrame) -> DataFrame:
    """Prefix shingles of two groups or more. Tasks send each shingle once, with a mark if they met it twice."""
    shards = 1 << max(cores(groups.sparkSession), groups.agg(F.sum(F.size("prefix"))).first()[0] // SHARD_TOKENS if not groups.isEmpty() else 0).bit_length()
    bits = W.U64(65 - shards.bit_length())

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            token, count = np.unique(batch.column(0).flatten().to_numpy().view(np.uint64), return_counts=True)
            cuts = np.searchsorted(token >> bits, np.arange(shards + 1))
            for k in np.flatnonzero(np.diff(cuts)):
                part = slice(cuts[k], cuts[k + 1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(k)], pa.int32()), pa.array([W.pack_sorted(token[part])], pa.binary()), pa.array([np.packbits(count[part] > 1).tobytes()], pa.binary())],
                    ["shard", "tokens", "twice"],
                )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for k, blob, twice in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                token = W.unpack_sorted(blob)
                own = seen.setdefault(k, [])
                own += [token, token[np.unpackbits(np.frombuffer(twice, np.uint8), count=len(token)).astype(bool)]]
        for own in seen.values():
            token, count = np.unique(np.concatenate(own), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(token[count > 1].view(np.int64))], ["token"])

    sent = groups.select("prefix").mapInArrow(send, "shard int, tokens binary, twice binary")
    return sent.repartition(shards, "shard").mapInArrow(meet, "token long")


def _postings(wanted: np.ndarray):
    """(token, grp, head, central, n, pos) of the prefix shingles that the filter lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix = batch.column(4)
            token = prefix.flatten().to_numpy()
            on = np.flatnonzero(may_hold(wanted, token.view(np.uint64)))
            size = prefix.value_lengths().to_numpy()
            row = np.repeat(np.arange(len(size)), size)[on]
            pos = (on - (np.cumsum(size) - size)[row]).astype(np.int32)
            rest = batch.select([0, 1, 2, 3]).take(pa.array(row))
            yield pa.RecordBatch.from_arrays([pa.array(token[on]), *rest.columns, pa.array(pos)], ["token", "grp", "head", "central", "n", "pos"])

    return run


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drops pairs whose bitmaps differ in more bits than a link allows."""
    for batch in batches:
        cols = [batch.column(k).to_pylist() for k in range(2, 6)]
        keep = []
        for na, nb, xa, xb in zip(*cols, strict=True):
            x, y = np.frombuffer(xa, "<u8"), np.frombuffer(xb, "<u8")
            if len(x) < len(y):
                x, y = y, x
            while len(x) > len(y):
                x = x[: len(x) // 2] ^ x[len(x) // 2 :]
            keep.append(int(np.bitwise_count(x ^ y).sum()) <= na + nb - 2 * required(na, nb))
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep))], ["a", "b"])


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keeps pairs of texts whose shingle sets are similar enough."""

    def sets(column: pa.Array) -> Iterator[np.ndarray]:
        for texts in W.chunks(column):
            value, first = W.shingle_sets(texts, SHINGLE_WORDS)
            for r in range(texts.rows):
                yield value[first[r] : first[r + 1]]

    for batch in batches:
        keep = []
        for x, y in zip(sets(batch.column(2)), sets(batch.column(3)), strict=True):
            common = len(x) + len(y) - len(np.union1d(x, y))
            keep.append(100 * common >= 80 * (len(x) + len(y) - common) and common > 0)
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep))], ["a", "b"])


def _texts_of(documents: DataFrame, nodes: DataFrame) -> DataFrame:
    """One text for each of `nodes` (node, doc_id).

    A filter of a fixed size, made of the wanted ids, thins out the documents before any text is shuffled; it lets some
    others through, which the join drops.
    """
    wanted = build(nodes.select(F.xxhash64("doc_id").alias("key")), "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            on = may_hold(wanted, batch.column(1).to_numpy().view(np.uint64))
            batch = batch.select([0, 2]).filter(pa.array(on))
            for texts in W.chunks(batch.column(1)):
                rows = slice(texts.first_row, texts.first_row + texts.rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(rows.start, texts.rows),
                        pa.array(set_hash(*W.shingle_sets(texts, SHINGLE_WORDS)).view(np.int64)),
                        batch.column(1).slice(rows.start, texts.rows).cast(pa.string()),
                    ],
                    ["doc_id", "node", "text"],
                )

    found = documents.select("doc_id", F.xxhash64("doc_id").alias("key"), "text").mapInArrow(run, "doc_id long, node long, text string")
    # rows that repeat id and text are cut to one beside their nodes, where they are few
    return found.join(nodes, (found.node == nodes.node) & found.doc_id.eqNullSafe(nodes.doc_id)).select(found.node, "text").dropDuplicates(["node"])


def _verify(documents: DataFrame, info: DataFrame, pairs: DataFrame) -> DataFrame:
    """The linked ones of node pairs: by bitmap first, then by text."""
    bits = info.select("node", "n", "bitmap")
    left = bits.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("bitmap").alias("xa"))
    right = bits.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("bitmap").alias("xb"))
    near = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "xa", "xb").mapInArrow(_close, _PAIR)
    near = stored(near, "near", "lz4")
    nodes = near.select(F.col("a").alias("node")).union(near.select("b")).distinct().join(info.select("node", "doc_id"), "node")
    texts = _texts_of(documents, stored(nodes, "near-nodes", "lz4"))
    texts = stored(texts, "near-texts")
    both = near.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
    return stored(both.select("a", "b", "ta", "tb").mapInArrow(_linked, _PAIR), "links", "lz4")


def _fits(a: str, b: str) -> str:
    """Sizes and places of one common prefix shingle allow a link."""
    size = f"5 * least({a}.n, {b}.n) >= 4 * greatest({a}.n, {b}.n)"
    return f"{size} and 9 * least({a}.n - {a}.pos, {b}.n - {b}.pos) >= 4 * ({a}.n + {b}.n)"


def similarity_classes(documents: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(doc_id, text_key, n, node) of every row, each node's smallest doc_id (node, least_id), and the classes (node, label) of
    all linked nodes."""
    documents = documents.select("doc_id", "text")
    level = shingle_levels(documents)
    keyed = documents.select("doc_id", text_key(), "text")
    rows = stored(keyed.mapInArrow(_signatures(level), "doc_id long, text_key long, n int, node long, grp long, central float, prefix array<long>, bitmap binary"), "signatures", "lz4")
    info = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("grp").alias("grp"), F.first("bitmap").alias("bitmap"))
    info = stored(info, "nodes", "lz4")
    # one row of each group, by the first of its rows; members of a group meet its first node
    groups = rows.where("n > 0").groupBy("grp").agg(F.min("node").alias("head"), F.first(F.struct("n", "prefix")).alias("p"), F.max("central").alias("central"))
    groups = stored(groups.select("grp", "head", "central", "p.n", "p.prefix"), "groups", "lz4")
    tokens = stored(shared_tokens(groups), "shared-tokens", "lz4")
    index = groups.mapInArrow(_postings(build(tokens, "token")), "token long, grp long, head long, central float, n int, pos int")
    index = stored(index.join(tokens, "token"), "index", "lz4")
    hubs = index.groupBy("token").agg(F.max(F.struct("central", "grp", "head", "n", "pos")).alias("hub"))
    hub = index.join(hubs, "token").where(f"grp <> hub.grp and {_fits('index', 'hub')}".replace("index.", ""))
    heads = hub.select(F.least("head", "hub.head").alias("a"), F.greatest("head", "hub.head").alias("b"))
    same = info.groupBy("grp").agg(F.min("node").alias("head"), F.count("*").alias("members"))
    many = info.join(same.where("members > 1"), "grp").select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b"))
    pairs = stored(heads.union(many).where("a <> b").distinct(), "hub-pairs", "lz4")
    links = _verify(documents, info, pairs)
    classes = stored(components(links), "classes", "lz4")

    # what is left: groups that share a prefix shingle and whose members are not all in one class
    label = F.coalesce("label", "node").alias("label")
    members = info.select("node", "grp").join(classes, "node", "left").select("node", "grp", label)
    spread = members.groupBy("grp").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    mixed = members.join(spread.where("lo <> hi").select("grp"), "grp")
    inside = mixed.alias("x").join(mixed.alias("y"), F.expr("x.grp = y.grp and x.label < y.label")).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    slim = index.select("token", "grp", "n", "pos").join(spread, "grp")
    open_ = slim.groupBy("token").agg(F.min("lo").alias("l"), F.max("hi").alias("h")).where("l <> h").select("token")
    slim = stored(slim.join(open_, "token"), "open", "lz4")
    # groups of one class count as one run of their shingle, so a large class does not meet itself
    key = F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(F.col("grp")).alias("key")
    slim = slim.select("token", "grp", "n", "pos", key)
    runs = slim.groupBy("token", "key").agg(F.min("n").alias("small"), F.max("n").alias("large"), F.min("pos").alias("pos"))
    meet = runs.alias("x").join(
        runs.alias("y"),
        F.expr(
            "x.token = y.token and x.key < y.key and 5 * x.large >= 4 * y.small and 5 * y.large >= 4 * x.small "
            "and 9 * least(x.large - x.pos, y.large - y.pos) >= 4 * (x.small + y.small)"
        ),
    ).select("x.token", F.col("x.key").alias("kx"), F.col("y.key").alias("ky"))
    half = meet.alias("m").join(slim.alias("x"), F.expr("m.token = x.token and m.kx = x.key")).select(
        "m.token", "ky", F.col("x.grp").alias("gx"), F.col("x.n").alias("n"), F.col("x.pos").alias("pos")
    )
    found = half.alias("x").join(slim.alias("y"), F.expr(f"x.token = y.token and x.ky = y.key and {_fits('x', 'y')}")).select("x.gx", F.col("y.grp").alias("gy")).distinct()
    left = members.select(F.col("grp").alias("gx"), F.col("node").alias("a"), F.col("label").alias("la"))
    right = members.select(F.col("grp").alias("gy"), F.col("node").alias("b"), F.col("label").alias("lb"))
    across = found.join(left, "gx").join(right, "gy").where("la <> lb").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = stored(across.union(inside).distinct(), "rest-pairs", "lz4")
    more = _verify(documents, info, rest)
    return rows.select("doc_id", "text_key", "n", "node"), info.select("node", F.col("doc_id").alias("least_id")), merged(classes, more)


def _with_component(documents: DataFrame) -> DataFrame:
    """Rows with shingles (doc_id, text_key, n, node, label, component_id), and the others with their own doc_id."""
    rows, nodes, classes = similarity_classes(documents)
    named = nodes.join(classes, "node", "left").select("node", F.coalesce("label", "node").alias("label"), "least_id")
    named = named.join(named.groupBy("label").agg(F.min("least_id").alias("component_id")), "label").select("node", "label", "component_id")
    empty = rows.where("n = 0").select("doc_id", "text_key", "n", "node", F.lit(None).cast("long").alias("label"), F.col("doc_id").alias("component_id"))
    return rows.where("n > 0").join(named, "node").select("doc_id", "text_key", "n", "node", "label", "component_id").union(empty)


def similar_documents(documents: DataFrame) -> DataFrame:
    """One row per document: its number of shingles, and the smallest doc_id that links lead to from it."""
    return _with_component(documents).select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")


def one_of_each(documents: DataFrame) -> DataFrame:
    """`documents` with one row of each class, the one of the smallest doc_id; rows without shingles stay.

    Of rows alike in doc_id and text one stays.
    """
    found = stored(_with_component(documents).where("n > 0").groupBy("label", "doc_id", "text_key").agg(F.count("*").alias("rows")), "classes-by-row", "lz4")
    kept = found.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("k")).select("label", "k.doc_id", "k.text_key")
    same = ["label", "doc_id", "text_key"]
    rest = found.alias("f").join(kept.alias("k"), F.expr(" and ".join(f"f.{c} <=> k.{c}" for c in same)), "left_anti")
    again = found.where("rows > 1").select("doc_id", "text_key").distinct()
    once = without(documents, rest.select("doc_id", "text_key"))
    if again.isEmpty():
        return once
    same = (F.col("_doc_id").eqNullSafe(F.col("doc_id"))) & (F.col("_text_key") == F.xxhash64("text"))
    twice = once.join(again.select(F.col("doc_id").alias("_doc_id"), F.col("text_key").alias("_text_key")), same, "left_semi")
    return without(once, again).union(twice.dropDuplicates(["doc_id", "text"]))
