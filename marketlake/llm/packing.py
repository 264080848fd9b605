"""Best-fit packing of token sequences by a configuration linear program over the histogram of lengths.

Pieces have at most `capacity` tokens, so the histogram has at most `capacity` entries whatever the number of documents.
The covering program (ways to fill a sequence, so that every length is covered as often as it occurs) is solved
approximately by multiplicative weights: lengths covered more lose price, and a knapsack table by dynamic programming
finds the best-priced ways. The ways' counts are rounded down, and what they leave is packed best-fit decreasing, also by
whole classes of equal sequences. The program is solved with ways that leave next to nothing free, and again with more
slack as long as the plan needs more sequences than a lower bound by over MAX_GAP; the best plan is taken. Only the histogram and the plan pass the driver; each piece finds its place from its
rank among the pieces of its length.

Cases: a null or empty text is one piece of the end id alone. Repeated rows are packed each; a null doc_id is carried. A
longer document is cut into pieces of `capacity` from its end, so its first piece may be shorter. Extra columns are
dropped; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.ranks import bins, hash_bin, ranked
from marketlake.llm.scratch import stored

CAPACITY = 2048
END_ID = 0
ROUNDS = 16
TABLES_A_ROUND = 12
WEIGHT_RATE = 1.0
#: Shares of a sequence that ways may leave free, one try after the other, and the gap to the lower bound that ends the tries.
SLACKS = (0.001, 0.01, 0.1)
MAX_GAP = 0.001
_encoders: dict[str, tuple] = {}


def _encoder(path: str, pattern: str):
    """Ids of a text, by the vocabulary of a byte-level BPE file.

    The file's vocabulary is also given to a faster encoder of the same merges; texts with a special token's string stay
    with the file's own library.
    """
    if path not in _encoders:
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        special = [t["content"] for t in spec["added_tokens"]]
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(plain)))}
        ranks = {bytes(byte[c] for c in token): k for token, k in spec["model"]["vocab"].items() if token not in special}
        fast = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        _encoders[path] = (special, fast, Tokenizer.from_file(path))
    special, fast, own = _encoders[path]

    def encode(text: str) -> np.ndarray:
        if any(s in text for s in special):
            return np.array(own.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return np.array(fast.encode_ordinary(text), dtype="<u4")

    return encode


def tokenize(documents: DataFrame, path: str, pattern: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every piece."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path, pattern)
        for batch in batches:
            out = []
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.append(encode(text.as_py() or ""), np.uint32(END_ID)).astype("<u4")
                first = len(ids) % capacity or capacity
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    part = ids[a:b]
                    out.append((doc.as_py(), k, a, b - a, zlib.crc32(part.tobytes())) + ((part,) if with_ids else ()))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int64())] * with_ids
            columns = zip(*out, strict=True) if out else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)], names)

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids)


def _knapsack(sizes: np.ndarray, price: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best price for each capacity, and the size (its index) to put in first; -1 for none."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        n = np.searchsorted(sizes, c, side="right")
        best[c], pick[c] = best[c - 1], -2
        if n:
            value = best[c - sizes[:n]] + price[:n]
            k = int(value.argmax())
            if value[k] > best[c]:
                best[c], pick[c] = value[k], k
    return best, pick


def _ways(counts: np.ndarray, capacity: int, rounds: int, slack: float) -> dict[tuple[int, ...], float]:
    """Fractional counts of ways to fill a sequence (each a descending tuple of lengths), by multiplicative weights.

    A length's dual price is its share of a sequence times a weight that falls by its coverage. Round t covers lengths up
    to the share t / rounds of their counts, so that what is left at any time is like the whole. A round ends when all are
    covered, when no way is left within `slack`, or after TABLES_A_ROUND tables; what it leaves open is priced higher in
    the next, and what the last leaves goes to the rest.
    """
    sizes = np.flatnonzero(counts)
    need = counts[sizes].astype(float)
    done = np.zeros(len(sizes))
    use: dict[tuple[int, ...], float] = defaultdict(float)
    for t in range(1, rounds + 1):
        for _ in range(TABLES_A_ROUND):
            behind = t / rounds - done / need
            open_ = np.flatnonzero(behind > 1e-6)
            if not len(open_):
                break
            own = sizes[open_]
            best, pick = _knapsack(own, own * np.exp(WEIGHT_RATE * behind[open_]), capacity)
            moved = False
            for first in np.argsort(-behind[open_], kind="stable"):
                way, c = [int(first)], capacity - int(own[first])
                while c > 0 and pick[c] != -1:
                    if pick[c] == -2:
                        c -= 1
                    else:
                        way.append(int(pick[c]))
                        c -= int(own[pick[c]])
                if capacity - int(own[way].sum()) > slack * capacity:
                    continue
                kinds, times = np.unique(open_[way], return_counts=True)
                step = float(((need * t / rounds - done)[kinds] / times).min())
                if step > 1e-6:
                    use[tuple(sorted(sizes[open_[way]].tolist(), reverse=True))] += step
                    done[kinds] += step * times
                    moved = True
            if not moved:
                break
    return use


def _best_fit(counts: np.ndarray, capacity: int, classes: list[list]) -> list[list]:
    """Puts the counted lengths, longest first, into the fullest sequences that have room; [way, space, times] classes."""
    spaces: dict[int, list[list]] = defaultdict(list)
    for item in classes:
        spaces[item[1]].append(item)
    open_ = sorted(s for s in spaces if spaces[s])
    for size in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[size])
        while left:
            at = int(np.searchsorted(open_, size))
            if at == len(open_):
                each = capacity // size
                for n, times in ((each, left // each), (left % each, 1)):
                    if n and times:
                        item = [(size,) * n, capacity - n * size, times]
                        spaces[item[1]].append(item)
                left = 0
            else:
                space = open_[at]
                way, _, times = spaces[space].pop()
                take = min(times, left)
                if times > take:
                    spaces[space].append([way, space, times - take])
                spaces[space - size].append([(*way, size), space - size, take])
                left -= take
            open_ = sorted(s for s in spaces if spaces[s])
    return [item for own in spaces.values() for item in own]


def least_sequences(counts: np.ndarray, capacity: int = CAPACITY) -> int:
    """A lower bound: no two lengths over half a sequence share one, and above a threshold k nothing over capacity - k
    shares one with the lengths from k on; the best of all thresholds."""
    length = np.arange(capacity + 1)
    number, tokens = (np.concatenate([[0], np.cumsum(c)]) for c in (counts, counts * length))
    best, half = -(-int(tokens[-1]) // capacity), capacity // 2
    for k in range(1, half + 1):
        alone, pairing = int(number[-1] - number[capacity - k + 1]), int(number[capacity - k + 1] - number[half + 1])
        room = pairing * capacity - int(tokens[capacity - k + 1] - tokens[half + 1])
        small = int(tokens[half + 1] - tokens[k])
        best = max(best, alone + pairing + max(0, -(-(small - room) // capacity)))
    return best


def plan(counts: np.ndarray, capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[tuple[tuple[int, ...], int]]:
    """Ways to fill a sequence and how often, covering exactly `counts` (by length, from 0 to `capacity`)."""
    enough = (1 + MAX_GAP) * least_sequences(counts, capacity)
    best: dict[tuple[int, ...], int] = {}
    for slack in (*SLACKS, None):  # at last the rest alone: the program's plan is never worse than best fit
        if best and sum(best.values()) <= enough:
            break
        found = _plan(counts, capacity, _ways(counts, capacity, rounds, slack) if slack else {})
        if not best or sum(found.values()) < sum(best.values()):
            best = found
    return sorted(best.items())


def _plan(counts: np.ndarray, capacity: int, ways: dict[tuple[int, ...], float]) -> dict[tuple[int, ...], int]:
    """The ways' counts rounded down, and best fit for what they leave."""
    left = counts.astype(np.int64).copy()
    classes = []
    for way, times in sorted(ways.items(), key=lambda x: (-x[1], x[0])):
        kinds, many = np.unique(way, return_counts=True)
        n = int(min(int(times + 1e-6), (left[kinds] // many).min()))
        if n:
            left[kinds] -= n * many
            classes.append([way, capacity - sum(way), n])
    merged: dict[tuple[int, ...], int] = defaultdict(int)
    for way, _, times in _best_fit(left, capacity, classes):
        merged[tuple(sorted(way, reverse=True))] += times
    return merged


def places(ways: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: first rank, first sequence, pieces of the length in a sequence, and their first offset, of each way."""
    out: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    ranks: dict[int, int] = defaultdict(int)
    sequence = 0
    for way, times in ways:
        offset = 0
        for size in dict.fromkeys(way):
            many = way.count(size)
            out[size].append((ranks[size], sequence, many, offset))
            ranks[size] += many * times
            offset += many * size
        sequence += times
    return {size: tuple(np.array(c, np.int64) for c in zip(*own, strict=True)) for size, own in out.items()}


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`pieces` with sequence_id and offset; `pieces` should be a written table, as it is read three times. Its column
    `spread` tells rows that are alike apart, so that they do not meet in one bin."""
    counts = np.zeros(capacity + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():  # `capacity` rows at most
        counts[row["length"]] = row["count"]
    table = places(plan(counts, capacity))
    names = [c for c in pieces.columns if c != "spread"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for size in np.unique(length):
                at = np.flatnonzero(length == size)
                first, base, many, begin = table[int(size)]
                seg = np.searchsorted(first, rank[at], side="right") - 1
                nth = rank[at] - first[seg]
                sequence[at] = base[seg] + nth // many[seg]
                offset[at] = begin[seg] + nth % many[seg] * size
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    apart = ["spread"] if "spread" in pieces.columns else []
    drawn = pieces.withColumn("h", F.xxhash64("doc_id", "piece", "ids_crc32", *apart))
    drawn = ranked(drawn, ["length"], hash_bin("h", bins(int(counts.sum()))), ["h", "doc_id", "piece"], "rank")
    kinds = ", ".join(f"`{c}` {t}" for c, t in pieces.dtypes if c in names)
    return drawn.select(*names, "rank").mapInArrow(run, f"{kinds}, sequence_id long, offset long")


def pack_documents(documents: DataFrame, path: str, pattern: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    pieces = tokenize(documents, path, pattern, capacity, with_ids).withColumn("spread", F.monotonically_increasing_id())
    return pack(stored(pieces, "pieces"), capacity)
