"""Prefix trie of conversations, its subtree figures by the Euler-tour technique.

Every turn becomes a code of 128 bits of its place, role and text; the XOR of the codes up to a place names the prefix, so
prefixes are found by running XORs and one grouping. The tour enters and leaves every node: an enter arc leads to the first
child's enter arc or to the node's own exit, an exit arc to the next sibling's enter arc or to the parent's exit.
The tour is ranked as a linked list: in each round about a quarter of the arcs, chosen by coins, is taken out of the list and
remembered with the arc before, until a list of bounded size is left for one task; then the arcs come back in reverse
order. Prefix sums over the ranks, taken in bins, give a subtree's sum as the difference between its exit and its enter arc.

No conversation, node or group of copies is held whole by a task: turns and children are ranked in ranges, a node's ends are
joined to texts of bounded size before one task hashes them in order. Two different prefixes share a code with odds of about
n * n / 2**129.

Cases: a null role or text is empty, a null turn comes first; turns alike in number are ordered by the MD5 of role and text,
and rows that repeat are turns of their own. Rows without a conversation id belong to no conversation and are left out.
Texts and conversations of any length are read whole. Extra columns are dropped; an empty table has no node, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.ranks import ranked
from marketlake.llm.scratch import stored

#: Conversations of one hundred begin with turns of the first of them, SHARED_TURNS - 1 at most.
GROUP, SHARED_TURNS = 100, 6
#: Arcs that one task ranks in the end.
LIST_BLOCK = 20_000
#: Arcs of a bin of prefix sums, and bins of a bin above.
SUM_BLOCK = 4_096
#: Conversation ids of one piece of text on the way to a node's hash.
END_BLOCK = 1_000

NODE = ["depth", "a", "b"]


def _ranges(df: DataFrame, *order: Column | str) -> DataFrame:
    """`df` written in ranges of `order`, with the number of the range, ascending, as `bin`; rows alike are split too."""
    dealt = df.withColumn("_deal", F.monotonically_increasing_id()).repartitionByRange(*order, "_deal").drop("_deal")
    return stored(dealt.withColumn("bin", F.spark_partition_id()), "ranges")


def original_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 0), digest and chars of each turn, and the range it was ranked in."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long"), "turn", digest.alias("digest"), F.length(text).cast("long").alias("chars"))
    order = [F.col("turn").asc_nulls_first(), F.col("digest")]
    rows = ranked(_ranges(rows, "conv_id", *order), ["conv_id"], F.col("bin"), order, "place")
    return stored(rows.select("conv_id", "place", "digest", "chars", "bin"), "turns")


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations (depth from 1), and all conversations with their rebuilt length."""
    parts = turns.groupBy("conv_id", "bin").agg(F.count("*").alias("n"))
    convs = parts.groupBy("conv_id").agg(F.sum("n").alias("n"))
    convs = convs.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"), (F.crc32(F.col("conv_id").cast("string")) % SHARED_TURNS).alias("h"))
    first = convs.where(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = convs.join(first, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = stored(convs.withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "conversations")
    lent = turns.where((F.col("conv_id") % GROUP == 0) & (F.col("place") < SHARED_TURNS)).withColumnRenamed("conv_id", "base")
    lent = lent.drop("bin").join(convs.select("conv_id", "base", "h", "length"), "base").where("place < h")  # GROUP conversations at most, on both sides of 0
    lent = lent.select("conv_id", "length", F.lit(-1).alias("bin"), (F.col("place") + 1).alias("depth"), "digest", "chars")
    kept = parts.select("conv_id", "bin").join(convs.select("conv_id", "h", "taken", "length"), "conv_id")
    kept = turns.join(kept, ["conv_id", "bin"]).where("place >= h")
    kept = kept.select("conv_id", "length", "bin", (F.col("place") - F.col("h") + F.col("taken") + 1).alias("depth"), "digest", "chars")
    return lent.union(kept), convs.select("conv_id", "length")


def members(rebuilt: DataFrame) -> DataFrame:
    """Each rebuilt turn with the code (a, b) of the prefix that ends with it, and that of the prefix before."""
    rows = rebuilt.select("*", F.xxhash64(F.lit(1), "depth", "digest").alias("x"), F.xxhash64(F.lit(2), "digest", "depth").alias("y"))
    rows = stored(rows.drop("digest"), "rebuilt")
    parts = rows.groupBy("conv_id", "bin").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    earlier = Window.partitionBy("conv_id").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    parts = parts.select("conv_id", "bin", *[F.coalesce(F.bit_xor(c).over(earlier), none).alias(f"{c}0") for c in "xy"])
    inside = Window.partitionBy("conv_id", "bin").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.join(parts, ["conv_id", "bin"])
    rows = rows.select("*", *[F.bit_xor(c).over(inside).bitwiseXOR(F.col(f"{c}0")).alias(n) for c, n in zip("xy", "ab", strict=True)])
    before = [F.col(n).bitwiseXOR(F.col(c)).alias(f"{n}_before") for c, n in zip("xy", "ab", strict=True)]
    rows = rows.select("conv_id", "depth", "a", "b", *before, "chars", (F.col("depth") == F.col("length")).alias("last"))
    return stored(rows, "members")


def trie_nodes(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """node (an id), depth, a, b, the code before, smallest member, members, and code points saved at the node."""
    saved = (F.count("*") - 1) * F.max("chars")
    nodes = rows.groupBy(*NODE).agg(F.min("a_before").alias("a_before"), F.min("b_before").alias("b_before"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), saved.alias("saved"))
    none = F.lit(0).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(none.alias("depth"), none.alias("a"), none.alias("b"), none.alias("a_before"), none.alias("b_before"), "conv_id", "n_convs", none.alias("saved"))
    return stored(nodes.union(root).select(F.monotonically_increasing_id().alias("node"), "*"), "nodes")


def siblings(nodes: DataFrame) -> DataFrame:
    """node, parent, the parent's conv_id, place among its siblings, and the next sibling (null for the last)."""
    upper = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("a_before"), F.col("b").alias("b_before"), F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    lower = nodes.select("node", "depth", "a_before", "b_before", "conv_id")
    join = ["depth", "a_before", "b_before"]
    first = lower.where("depth = 1").join(F.broadcast(upper.where("depth = 1")), join)  # the root alone
    rows = first.union(lower.where("depth > 1").join(upper.where("depth > 1"), join)).select("node", "conv_id", "parent", "parent_conv_id")
    rows = ranked(_ranges(rows, "parent", "conv_id"), ["parent"], F.col("bin"), ["conv_id"], "place")
    rows = stored(rows.select("node", "parent", "parent_conv_id", "place"), "siblings")
    after = rows.select("parent", (F.col("place") - 1).alias("place"), F.col("node").alias("next"))
    return stored(rows.join(after, ["parent", "place"], "left"), "siblings")


def tour(nodes: DataFrame, family: DataFrame) -> DataFrame:
    """The arcs (2 * node enters, 2 * node + 1 leaves) and the arc after each; null after the root's exit."""
    enter, leave = lambda c: 2 * F.col(c), lambda c: 2 * F.col(c) + 1
    down = family.where("place = 0").select(enter("parent").alias("arc"), enter("node").alias("next"))
    on = family.select(leave("node").alias("arc"), F.coalesce(enter("next"), leave("parent")).alias("next"))
    turn = nodes.join(family.where("place = 0").select(F.col("parent").alias("node")), "node", "left_anti").select(enter("node").alias("arc"), leave("node").alias("next"))
    end = nodes.where("depth = 0").select(leave("node").alias("arc"), F.lit(None).cast("long").alias("next"))
    return down.union(on).union(turn).union(end)


def _rank_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranks of the arcs of one short list."""
    rows = [r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
    after = {arc: (next_, gap) for arc, next_, gap in rows}
    at, place, arcs, places = next(iter(after.keys() - {n for n, _ in after.values()}), None), 0, [], []
    while at is not None:
        arcs.append(at)
        places.append(place)
        at, gap = after[at]
        place += gap
    yield pa.RecordBatch.from_arrays([pa.array(arcs, pa.int64()), pa.array(places, pa.int64())], ["arc", "place"])


def list_ranks(arcs: DataFrame, block: int = LIST_BLOCK) -> DataFrame:
    """(arc, place from 0) of a linked list (arc, next; null after the last).

    A round takes out every arc with coin 1 that follows an arc with coin 0, which then leads on over the gap. Work adds up to
    a few times the list; rounds grow with the logarithm of its length over `block`.
    """
    live, taken = stored(arcs.withColumn("gap", F.lit(1).cast("long")), "arcs", "lz4"), []
    while live.count() > block:
        coin = lambda c, k=len(taken): F.xxhash64(F.lit(k), c).bitwiseAND(1) == 1
        leads = ~coin("arc") & F.col("next").isNotNull() & coin("next")
        before = live.where(leads).select(F.col("next").alias("arc"), F.col("arc").alias("before"), F.col("gap").alias("gap_before"))
        met = stored(live.where(coin("arc")).join(before, "arc", "left"), "met", "lz4")
        out = met.where("before is not null")
        taken.append(out.select("arc", "before", "gap_before"))
        led = out.select(F.col("before").alias("arc"), "next", (F.col("gap_before") + F.col("gap")).alias("gap"))
        live = stored(live.where(~coin("arc") & ~leads).union(met.where("before is null").select("arc", "next", "gap")).union(led), "arcs", "lz4")
    places = stored(live.repartition(1).mapInArrow(_rank_block, "arc long, place long"), "places", "lz4")  # `block` arcs at most
    for out in reversed(taken):
        known = places.select(F.col("arc").alias("before"), "place")
        back = out.join(known, "before").select("arc", (F.col("place") + F.col("gap_before")).alias("place"))
        places = places.union(stored(back, "places", "lz4"))
    return places


def prefix_sums(rows: DataFrame, values: list[str], levels: int = 2) -> DataFrame:
    """`rows` with each of `values` replaced by its sum up to the row's `place`; bins of bins, so that no task sees all rows."""
    rows = rows.withColumn("_bin", F.expr(f"place div {SUM_BLOCK}"))
    sums = rows.groupBy("_bin").agg(*[F.sum(v).alias(v) for v in values])
    if levels:
        above = prefix_sums(sums.withColumnRenamed("_bin", "place"), values, levels - 1).withColumnRenamed("place", "_bin")
    else:
        above = sums.select("_bin", *[F.sum(v).over(Window.orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)).alias(v) for v in values])
    above = above.select((F.col("_bin") + 1).alias("_bin"), *[F.col(v).alias(f"_{v}") for v in values])
    inside = Window.partitionBy("_bin").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.join(above, "_bin", "left")
    kept = [c for c in rows.columns if c not in values and c != "_bin" and c not in [f"_{v}" for v in values]]
    return rows.select(*kept, *[(F.sum(v).over(inside) + F.coalesce(f"_{v}", F.lit(0))).alias(v) for v in values])


def subtree_sums(places: DataFrame, values: DataFrame, names: list[str]) -> DataFrame:
    """node, and the sums of `names` over its subtree, from the values of the nodes and the places of their arcs."""
    enters = F.col("arc") % 2 == 0
    rows = places.withColumn("node", F.shiftright("arc", 1)).join(values, "node")
    rows = rows.select("node", "place", enters.alias("enters"), *[F.when(enters, F.col(v)).otherwise(0).alias(v) for v in names], *[F.col(v).alias(f"own_{v}") for v in names])
    rows = prefix_sums(stored(rows, "tour"), names)
    return rows.groupBy("node").agg(*[(F.max(v) - F.max(F.when(F.col("enters"), F.col(v) - F.col(f"own_{v}")))).alias(v) for v in names])


def _joined_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of sorted ids of one node, as comma-joined texts of at most END_BLOCK ids."""
    node, ids = None, []
    for batch in batches:
        out = []
        for *key, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != node or len(ids) == END_BLOCK:
                if ids:
                    out.append((*node, ids[0], ",".join(map(str, ids))))
                node, ids = key, []
            ids.append(conv)
        yield _end_rows(out)
    if ids:
        yield _end_rows([(*node, ids[0], ",".join(map(str, ids)))])


def _end_rows(rows: list) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], [*NODE, "first", "ids"])


def _hashed_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's texts, fed one after the other."""
    node, digest = None, None
    for batch in batches:
        out = []
        for *key, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key == node:
                digest.update(b",")
            else:
                if node:
                    out.append((*node, digest.hexdigest()))
                node, digest = key, hashlib.sha256()
            digest.update(ids.encode())
        yield _hash_rows(out)
    if node:
        yield _hash_rows([(*node, digest.hexdigest())])


def _hash_rows(rows: list) -> pa.RecordBatch:
    kinds = [pa.int64()] * 3 + [pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], [*NODE, "ends_sha256"])


def end_hashes(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """depth, a, b and the SHA-256 of the ids of the conversations that end there, ascending and comma-joined."""
    none = F.lit(0).cast("long")
    ends = rows.where("last").select(*NODE, "conv_id").union(convs.where("length = 0").select(none, none, none, "conv_id"))
    order = [*NODE, "conv_id"]
    pieces = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_joined_ends, "depth long, a long, b long, first long, ids string")
    pieces = stored(pieces, "ends").repartition(*NODE).sortWithinPartitions(*NODE, "first").select(*NODE, "ids")
    return pieces.mapInArrow(_hashed_ends, "depth long, a long, b long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, block: int = LIST_BLOCK) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rebuilt, convs = rebuilt_turns(original_turns(conversations))
    rows = members(rebuilt)
    nodes = trie_nodes(rows, convs)
    family = siblings(nodes)
    places = list_ranks(tour(nodes, family), block)
    children = family.where("next is null").select(F.col("parent").alias("node"), (F.col("place") + 1).alias("n_children"))
    figures = nodes.join(children, "node", "left").join(family.select("node", "parent_conv_id"), "node", "left")
    figures = stored(figures.select("node", *NODE, "conv_id", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "saved"), "figures")
    values = figures.select("node", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    sums = subtree_sums(places, values, ["n_leaves", "saved_tokens"])
    out = figures.join(sums, "node").join(end_hashes(rows, convs), NODE, "left")
    ends = F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest()))
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", ends.alias("ends_sha256"))
