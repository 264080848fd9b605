"""Scores of a smoothed n-gram language model, held in Elias-Fano tries with quantised values.

With h the words before w, nearest first, a count of the longest context weighs 1, that of each shorter one KEEP times the
next longer one's: A2 = c(h1 w) + MU * p(w), A3 = KEEP * A2 + c(h2 h1 w) and so on; D2 = c(h1) + MU, D3 = KEEP * D2 + c(h2 h1).
The probability is An / Dn, which adds up to 1 over w; p(w) = (c(w) + 0.1) / (N + 0.1 * (V + 1)). Counts cover all training
documents. So a text's score is the sum of log10 p(w) over its tokens, and of what each n-gram seen in training adds: as the
end of a text read so far (a gain, log10 A / (A without its count)) and as the context of the next word (a loss, the same of
D). These two are what a trie's nodes store, in 8 bits each.

A level's 256 values lie evenly from 0 to the largest that can occur, which follows from N, MU and KEEP alone. So a stored
value is at most half a step off (log10(1 + (N + 0.1 * (V + 1)) / MU) / 510 at pairs, log10(1 + 1 / KEEP) / 510 elsewhere), and a text's
score does not depend on how many shards there are.

No table of the vocabulary or of the n-grams is held whole. Blocks of documents send each shard the words that fall to it:
each distinct word, the words before it, and in which documents they stand. A shard counts what training documents hold,
builds its trie (words; then level by level monotone pointers and each node's predecessors, searched by successor within the
range of their parent), maps it from an unlinked file, scores all its blocks' words and sends back sums by document. The
HOT_WORDS commonest words, whose counts are known from a first pass, are dealt to all shards by pair; counts of a shard are
added up by block before they are sent, so a word or pair of any frequency costs a shard a few bytes for a document that
holds it. A shard is a partition of its own, so no task holds two.

Cases: a null or empty text is one end token. Without training documents every probability is that of an unknown word.
Repeated rows are scored, and learned from, each. Extra columns are dropped; an empty table gives an empty result. Words are
told apart by 64-bit hashes, predecessors of a node by 32 bits.
"""

from __future__ import annotations

import math
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm import words as W
from marketlake.llm.elias_fano import EliasFano, encode
from marketlake.llm.scratch import cores

MU, KEEP = 8.0, 0.05
ORDER = 3
HOT_WORDS = 4096
BLOCK_TOKENS = 2_000_000
BLOCK_DOCS = 8192
WORD_SHARDS_A_TASK = 4
LEVELS = 256
SHARD_TOKENS = 2_000_000
ADDED = 0.1
END, BEGIN = np.uint64(0x5E5E5E5E5E5E5E5E), np.uint64(0x1B1B1B1B1B1B1B1B)
_SCORE = "doc_id long, learned boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


@dataclass
class Totals:
    tokens: int
    distinct: int
    documents: int
    hot: np.ndarray  # ascending hashes
    hot_count: np.ndarray

    @property
    def mass(self) -> float:
        return self.tokens + ADDED * (self.distinct + 1)


@dataclass
class Block:
    """Some documents: `word` holds each one's words and then END; a document's begin at `first`. Named by its first row."""

    row: int
    doc: list
    learned: np.ndarray
    word: np.ndarray
    first: np.ndarray


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    """Documents (row, doc_id, learned, text) in runs of bounded size, cut alike whenever a task is repeated."""
    rows, docs, flags, parts, sizes = [], [], [], [], []

    def block() -> Block:
        first = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        out = Block(rows[0], list(docs), np.array(flags, bool), np.concatenate(parts), first)
        for x in (rows, docs, flags, parts, sizes):
            x.clear()
        return out

    for batch in batches:
        for texts in W.chunks(batch.column(3)):
            found = W.words(texts)
            words = np.insert(W.hashes(texts, found), found.first[1:], END)
            if docs and (sum(map(len, parts)) + len(words) > BLOCK_TOKENS or len(docs) + texts.rows > BLOCK_DOCS):
                yield block()
            for part in range(0, texts.rows, BLOCK_DOCS):  # many empty texts
                own = slice(part, min(part + BLOCK_DOCS, texts.rows))
                if docs and len(docs) + own.stop - own.start > BLOCK_DOCS:
                    yield block()
                at = texts.first_row + part
                for k, x in enumerate((rows, docs, flags)):
                    x += batch.column(k).slice(at, own.stop - own.start).to_pylist()
                begin = found.first + np.arange(texts.rows + 1)
                parts.append(words[begin[own.start] : begin[own.stop]])
                sizes.append(np.diff(begin)[own])
    if docs:
        yield block()


def _shard(key: np.ndarray, shards: int) -> np.ndarray:
    return (W.mix(key ^ W.U64(0x7F4A7C159E3779B9)) % W.U64(shards)).astype(np.int32)


def _learned_words(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            word, count = np.unique(block.word, return_counts=True)
            shard = _shard(word, shards)
            order = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[order], np.arange(shards + 1))
            for k in np.flatnonzero(np.diff(cuts)):
                at = order[cuts[k] : cuts[k + 1]]
                yield pa.RecordBatch.from_arrays([pa.array([int(k)], pa.int32()), pa.array([W.pack_sorted(word[at])], pa.binary()), pa.array([count[at].astype("<u4").tobytes()], pa.binary())], ["shard", "words", "counts"])

    return run


def _word_counts(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _counted(batches, 16 + 4 * HOT_WORDS // shards)

    return run


def _counted(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Sums of each shard (word null), its `most` commonest words, and END."""
    own: dict[int, list] = {}
    for batch in batches:
        for k, words, counts in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            own.setdefault(k, []).append((W.unpack_sorted(words), np.frombuffer(counts, "<u4")))
    for parts in own.values():
        word, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        count = np.bincount(inverse, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)
        top = np.argsort(-count, kind="stable")[:most]
        top = np.union1d(top, np.flatnonzero(word == END))
        words = [None, *word[top].view(np.int64).tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.int64()), pa.array([int(count.sum()), *count[top].tolist()], pa.int64()), pa.array([len(word)] + [0] * len(top), pa.int64())], ["word", "count", "distinct"])


def corpus_totals(rows: DataFrame) -> Totals:
    """Sums over all training documents, and HOT_WORDS of the commonest words with their counts, at most a few of each shard."""
    shards = cores(rows.sparkSession) * WORD_SHARDS_A_TASK
    sent = rows.mapInArrow(_learned_words(shards), "shard int, words binary, counts binary").repartitionById(shards, F.col("shard"))
    found = sent.mapInArrow(_word_counts(shards), "word long, count long, distinct long")
    end = int(END.view(np.int64))
    top = found.where(f"word is not null and word <> {end}").orderBy(F.desc("count"), "word").limit(HOT_WORDS)
    got = found.where(f"word is null or word = {end}").groupBy("word").agg(F.sum("count").alias("count"), F.sum("distinct").alias("distinct")).union(top).collect()
    sums = next((r for r in got if r["word"] is None), None)
    hot = sorted((int(np.int64(r["word"]).view(np.uint64)), r["count"]) for r in got if r["word"] is not None)
    words, counts = np.array([h[0] for h in hot], np.uint64), np.array([h[1] for h in hot], np.int64)
    documents = int(counts[words == END].sum())
    return Totals(sums["count"] or 0 if sums else 0, sums["distinct"] or 0 if sums else 0, documents, words, counts)


def _hot_place(words: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """The place of each word among the hot ones, or -1."""
    if not len(hot):
        return np.full(len(words), -1)
    at = np.minimum(np.searchsorted(hot, words), len(hot) - 1)
    return np.where(hot[at] == words, at, -1)


_DEALT = "shard int, block long, docs int, learned binary, words binary, kids array<binary>, before array<binary>, rows binary, at binary, times binary"
_SUMS = "block long, own binary, at binary, base binary, more binary, new binary"


def _one_row(schema: str, *values) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<binary>": pa.list_(pa.binary())}
    fields = [x.split() for x in schema.split(", ")]
    columns = [pa.array([v.tobytes() if isinstance(v, np.ndarray) else v], kinds[kind]) for v, (_, kind) in zip(values, fields, strict=True)]
    return pa.RecordBatch.from_arrays(columns, [name for name, _ in fields])


def _narrow(counts: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest needs; the first byte says how many."""
    width = 1 if not len(counts) or counts.max() < 1 << 8 else 2 if counts.max() < 1 << 16 else 4
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def _wide(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def _own_rows(block: Block) -> bytes:
    table = pa.table({"doc": pa.array(block.doc, pa.int64()), "learned": pa.array(block.learned), "tokens": pa.array(np.diff(block.first))})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


def _changes(x: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    return np.flatnonzero(new)


def _children(start: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places from each start on, as many as its size."""
    return np.repeat(start - _starts(sizes), sizes) + np.arange(int(sizes.sum()))


def _deal(totals: Totals, shards: int, order: int):
    """From a block to each shard: distinct words, level by level what stands before, and documents with counts; and the block's rows once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            hashes, place = np.unique(np.append(block.word, BEGIN), return_inverse=True)
            place = place.astype(np.uint64)
            gram, start = place[:-1], place[-1]
            before, code, kids = gram, [], []
            for level in range(1, order):
                before = np.concatenate([[start], before[:-1]])
                before[block.first[:-1]] = start
                key, gram = np.unique((gram << W.U64(32)) | before, return_inverse=True)
                gram = gram.astype(np.uint64)
                parent, last = key >> W.U64(32), hashes[key & W.U64(0xFFFFFFFF)]
                if level == 1:
                    word = hashes[parent]
                    shard = _shard(np.where(_hot_place(word, totals.hot) >= 0, word ^ W.mix(last), word), shards)
                else:
                    kids.append(np.bincount(parent.astype(np.int64), minlength=len(code[-1])))
                code.append((last >> W.U64(32)).astype("<u4"))
            doc = np.repeat(np.arange(len(block.doc), dtype=np.uint64), np.diff(block.first))
            key = (gram << W.U64(16)) | doc
            key.sort()
            first = _changes(key)
            times = np.diff(np.append(first, len(key)))
            key = key[first]
            at = (key & W.U64(0xFFFF)).astype("<u2")
            kids.append(np.bincount((key >> W.U64(16)).astype(np.int64), minlength=len(code[-1])))
            starts = [_starts(n) for n in kids]
            by_shard = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[by_shard], np.arange(shards + 1))
            learned = np.packbits(block.learned)
            for k in np.flatnonzero(np.diff(cuts)):
                node = by_shard[cuts[k] : cuts[k + 1]]
                own = _changes(word[node])
                sent_kids, sent_code = [_narrow(np.diff(np.append(own, len(node))))], [code[0][node].tobytes()]
                for level in range(order - 1):
                    sent_kids.append(_narrow(kids[level][node]))
                    node = _children(starts[level][node], kids[level][node])
                    if level < order - 2:
                        sent_code.append(code[level + 1][node].tobytes())
                words = W.pack_sorted(word[by_shard[cuts[k] : cuts[k + 1]]][own])
                yield _one_row(_DEALT, int(k), block.row, len(block.doc), learned, words, sent_kids[:-1], sent_code, sent_kids[-1], at[node], _narrow(times[node]))
            yield _one_row(_DEALT, int(block.row % shards), block.row, len(block.doc), _own_rows(block), *[None] * 6)

    return run


def steps(totals: Totals, order: int) -> list[float]:
    """How far apart the 256 values lie of the gains at pairs, and of all others."""
    widest = [math.log10(1 + totals.mass / MU)] + [math.log10(1 + 1 / KEEP)] * (order - 2)
    return [x / (LEVELS - 1) for x in widest]


def _quantised(x: np.ndarray, step: float) -> bytes:
    return np.minimum(np.rint(x / step), LEVELS - 1).astype(np.uint8).tobytes()


def build_trie(words: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], step: list[float]) -> bytes:
    """A trie of `words` (ascending hashes) and, for each level, (parent, before, gain, loss) of its nodes in order.

    `parent` is a place in the level above, `before` has 32 bits.
    """
    parts, above = [encode(words, 1 << 64)], len(words)
    for (parent, before, gain, loss), width in zip(levels, step, strict=True):
        pointers = np.concatenate([[0], np.cumsum(np.bincount(parent, minlength=above))])
        parts += [
            encode(pointers, len(parent) + 1),
            encode((parent.astype(np.uint64) << W.U64(32)) | before.astype(np.uint64), max(1, above) << 32),
            _quantised(gain, width),
            _quantised(loss, math.log10(1 + 1 / KEEP) / (LEVELS - 1)),
        ]
        above = len(parent)
    parts = [x + bytes(-len(x) % 8) for x in parts]
    return np.array([len(parts), *map(len, parts)], "<u8").tobytes() + b"".join(parts)


class Trie:
    """Reads `build_trie`'s bytes from mapped memory."""

    def __init__(self, memory: np.ndarray, step: list[float]):
        n = int(memory[:8].view("<u8")[0])
        ends = 8 * (n + 1) + np.cumsum(memory[8 : 8 * (n + 1)].view("<u8").astype(np.int64))
        parts = [memory[a:b] for a, b in zip([8 * (n + 1), *ends[:-1]], ends, strict=True)]
        self.words, self.step, self.loss_step = EliasFano(parts[0]), step, math.log10(1 + 1 / KEEP) / (LEVELS - 1)
        self.levels = [(EliasFano(parts[k]), EliasFano(parts[k + 1]), parts[k + 2], parts[k + 3]) for k in range(1, n, 4)]

    def find(self, level: int, parent: np.ndarray, kids: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Places of nodes below each parent (a place in the level above, -1 for none): `kids` of them each, in a row. -1 for those not held."""
        pointers, nodes = self.levels[level][:2]
        known = np.flatnonzero((parent >= 0) & (kids > 0))
        above, sizes = parent[known], kids[known]
        flat = _children(_starts(kids)[known], sizes)
        begin, end = (np.repeat(pointers.access(above + k), sizes) for k in (0, 1))
        begin, end = begin.astype(np.int64), end.astype(np.int64)
        out = np.full(len(before), -1)
        out[flat] = nodes.index((np.repeat(above, sizes).astype(np.uint64) << W.U64(32)) | before[flat].astype(np.uint64), begin, end)
        return out

    def values(self, level: int, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gain and loss of nodes; 0 for those not held."""
        held, at = place >= 0, np.maximum(place, 0)
        if not self.levels[level][1].n:
            return np.zeros(len(place)), np.zeros(len(place))
        gain, loss = self.levels[level][2], self.levels[level][3]
        return np.where(held, gain[at] * self.step[level], 0.0), np.where(held, loss[at] * self.loss_step, 0.0)


def _mapped(data: bytes) -> np.ndarray:
    """The bytes as memory mapped from a file that goes with the mapping."""
    with tempfile.TemporaryFile() as file:
        file.write(data)
        file.flush()
        return np.memmap(file, np.uint8, mode="r")


def _entries(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each longest n-gram of a block, how many documents hold it; these documents, and how often they do."""
    return _wide(row["rows"]), np.frombuffer(row["at"], "<u2"), _wide(row["times"]).astype(np.float64)


def _level(parent: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct nodes, as parents and what stands before, in order; and which one each row is."""
    key, of = np.unique((parent.astype(np.uint64) << W.U64(32)) | before, return_inverse=True)
    return (key >> W.U64(32)).astype(np.int64), (key & W.U64(0xFFFFFFFF)).astype("<u4"), of


def _score_shard(rows: list[dict], totals: Totals, order: int) -> Iterator[pa.RecordBatch]:
    own = [W.unpack_sorted(r["words"]) for r in rows]
    words, of = np.unique(np.concatenate(own), return_inverse=True)
    kids = [np.concatenate([_wide(r["kids"][k]) for r in rows]) for k in range(order - 1)]
    before = [np.concatenate([np.frombuffer(r["before"][k], "<u4") for r in rows]) for k in range(order - 1)]
    seen, first = [], [0]
    for r in rows:
        held, at, times = _entries(r)
        learned = np.unpackbits(np.frombuffer(r["learned"], np.uint8), count=r["docs"])
        seen.append(np.add.reduceat(times * learned[at], _starts(held)))
        first.append(first[-1] + len(held))
    sums = [np.concatenate(seen)]  # of every row of a level what training documents hold, longest n-grams first
    for n in kids[:0:-1]:
        sums.append(np.add.reduceat(sums[-1], _starts(n)))
    sums.reverse()
    del seen

    # levels between the words and the longest n-grams: distinct nodes, with the rows that they are
    parts, nodes, root = [of], [], of
    for k in range(order - 2):
        parent, code, which = _level(np.repeat(parts[-1], kids[k]), before[k])
        nodes.append((parent, code, np.bincount(which, weights=sums[k], minlength=len(parent))))
        parts.append(which)
        root = np.repeat(root, kids[k])
    root = np.repeat(root, kids[-1]).astype(np.int32)
    held = np.repeat(parts[-1], kids[-1]).astype(np.int32)
    some = np.flatnonzero(sums[-1] > 0)
    parent, code, which = _level(held[some], before[-1][some])
    nodes.append((parent, code, np.bincount(which, weights=sums[-1][some], minlength=len(parent))))

    count = np.bincount(np.repeat(of, kids[0]), weights=sums[0], minlength=len(words))
    hot = _hot_place(words, totals.hot)
    count = np.where(hot >= 0, totals.hot_count[hot] if len(totals.hot) else 0, count)
    del some, which, sums

    step = steps(totals, order)
    a, d, levels = MU * (count + ADDED) / totals.mass, count + MU, []
    kept = np.bincount(nodes[0][0], weights=nodes[0][2], minlength=len(words)) > 0
    trie_words, place = words[kept], np.cumsum(kept) - 1
    for k, (parent, code, n) in enumerate(nodes):
        prior = a[parent] * (KEEP if k else 1)
        context = KEEP * d[parent]
        a, d, kept = prior + n, context + n, n > 0
        levels.append((place[parent[kept]], code[kept], np.log10(a / prior)[kept], np.log10(d / context)[kept]))
        place = np.cumsum(kept) - 1
    trie = Trie(_mapped(build_trie(trie_words, levels, step)), step)
    del a, d, kept, levels, prior, context

    base, new = np.log10(count + ADDED), count == 0
    more = np.where(words == END, 0.0, np.log10(MU / (count + MU)))
    place, word = trie.words.index(words), np.arange(len(words))
    for k, (parent, code, _) in enumerate(nodes[:-1]):
        place = trie.find(k, place, np.bincount(parent, minlength=len(place)), code)
        word = word[parent]
        gain, loss = trie.values(k, place)
        more = more[parent] + gain - np.where(words[word] == END, 0.0, loss)
    del nodes
    parents = np.concatenate([[0], np.cumsum([len(_wide(r["kids"][-1])) for r in rows])])
    for r, a, z, p, q in zip(rows, first, first[1:], parents, parents[1:], strict=False):
        held_by, at, times = _entries(r)
        own = trie.find(order - 2, place[parts[-1][p:q]], kids[-1][p:q], before[-1][a:z])
        gain = more[held[a:z]] + trie.values(order - 2, own)[0]
        total = lambda x: np.bincount(at, weights=times * np.repeat(x, held_by), minlength=r["docs"])  # noqa: B023, E731
        touched = np.bincount(at, minlength=r["docs"]) > 0
        docs = np.flatnonzero(touched)
        index = None if touched.all() else docs.astype("<u2")
        yield _one_row(_SUMS, r["block"], None, index, total(base[root[a:z]])[docs], total(gain)[docs], total(new[root[a:z]])[docs].astype("<u4"))


def _score(totals: Totals, order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards: dict[int, list[dict]] = {}
        for batch in batches:
            for r in batch.to_pylist():
                if r["words"] is None:
                    yield _one_row(_SUMS, r["block"], r["learned"], None, None, None, None)
                else:
                    shards.setdefault(r["shard"], []).append(r)
        for k in sorted(shards):
            yield from _score_shard(sorted(shards.pop(k), key=lambda r: r["block"]), totals, order)

    return run


def _begin(totals: Totals, order: int) -> float:
    """What the context of a text's first word adds."""
    d, out = totals.documents + MU, math.log10(MU / (totals.documents + MU))
    for _ in range(order - 2):
        out -= math.log10(1 + totals.documents / (KEEP * d))
        d = KEEP * d + totals.documents
    return out


def _finish(totals: Totals, order: int):
    """Rows of each block, with the sums that the shards sent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, bytes] = {}
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for r in batch.to_pylist():
                if r["own"] is not None:
                    own[r["block"]] = r["own"]
                    continue
                total = sums.setdefault(r["block"], np.zeros((3, BLOCK_DOCS)))
                at = slice(0, len(r["base"]) // 8) if r["at"] is None else np.frombuffer(r["at"], "<u2")
                for k, (name, kind) in enumerate((("base", "<f8"), ("more", "<f8"), ("new", "<u4"))):
                    total[k, at] += np.frombuffer(r[name], kind)
        for block, data in own.items():
            table = pa.ipc.open_stream(data).read_all().combine_chunks()
            tokens = table.column("tokens").to_numpy()
            base, more, new = sums[block][:, : len(tokens)]
            base = base - tokens * np.log10(totals.mass)
            score = base + more + _begin(totals, order)
            columns = [table.column("doc"), table.column("learned"), tokens, tokens - new.astype(np.int64), np.full(len(tokens), totals.tokens, np.int64), base, score]
            names = [x.split()[0] for x in _SCORE.split(", ")]
            yield pa.RecordBatch.from_arrays([x.combine_chunks() if isinstance(x, pa.ChunkedArray) else pa.array(x) for x in columns], names)

    return run


def score_texts(rows: DataFrame, order: int = ORDER, shards: int | None = None) -> DataFrame:
    """Scores of (doc_id, learned, text), from a model of order 2 or more of the rows whose `learned` is true.

    `shards` bounds the memory of a task, not the result; by default a shard has about SHARD_TOKENS training tokens.
    """
    if order < 2:
        raise ValueError("the order is 2 at least")
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "learned", "text")
    totals = corpus_totals(rows.where("learned"))
    # sums come back by document and shard, so shards are as few as their memory allows
    shards = shards or max(rows.sparkSession.sparkContext.defaultParallelism, totals.tokens // SHARD_TOKENS)
    dealt = rows.mapInArrow(_deal(totals, shards, order), _DEALT).repartitionById(shards, F.col("shard"))
    sums = dealt.mapInArrow(_score(totals, order), _SUMS).repartition(shards, "block")
    return sums.mapInArrow(_finish(totals, order), _SCORE)
