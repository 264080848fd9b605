"""Words of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow column.

Words are told apart byte by byte, so a class of bytes (all of 0x80 and above, say) decides. Lower-casing covers A-Z.
Hashes have 64 bits; two different words or shingles of one table share a hash with odds of about n * n / 2**65.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19
U64 = np.uint64

_bytes = np.arange(256)
SPACES = np.isin(_bytes, [0x20, 9, 10, 11, 12, 13])
NOT_SPACE = ~SPACES
#: Digits, letters and every byte beyond ASCII; capitals count, as they are lower-cased.
WORDLIKE = ((_bytes >= 0x30) & (_bytes <= 0x39)) | ((_bytes >= 0x41) & (_bytes <= 0x5A)) | ((_bytes >= 0x61) & (_bytes <= 0x7A)) | (_bytes >= 0x80)

_BASE = 0x9E3779B97F4A7C15 | 1
_CODES = np.random.default_rng(20240601).integers(1, 2**63, 256, dtype=np.int64).astype(U64)
_LOWER = _CODES[np.where((_bytes >= 0x41) & (_bytes <= 0x5A), _bytes + 32, _bytes)]
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over all output bits."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, n of each at least."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        _powers[:] = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            out = np.full(size, base, dtype=U64)
            out[0] = 1
            _powers.append(np.multiply.accumulate(out))
    return _powers[0], _powers[1]


@dataclass
class Texts:
    """Some rows of a column: their bytes end to end, and where each begins (one more entry than rows)."""

    first_row: int
    data: np.ndarray
    begin: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.begin) - 1

    def text(self, row: int) -> bytes:
        return self.data[self.begin[row] : self.begin[row + 1]].tobytes()


@dataclass
class Words:
    """Byte ranges of the words of some texts; `first` tells where each text's words begin (one more entry than rows)."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The column in runs of rows of about `limit` bytes; a longer text is a run of its own. Null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    begin = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        last = max(row + 1, int(np.searchsorted(begin, begin[row] + limit, side="right")) - 1)
        last = min(last, len(column))
        yield Texts(row, data[begin[row] : begin[last]], begin[row : last + 1] - begin[row])
        row = last


def words(texts: Texts, kind: np.ndarray = NOT_SPACE) -> Words:
    """Maximal runs of bytes of `kind` within each text."""
    inside = np.zeros(len(texts.data) + 2, dtype=bool)
    inside[1:-1] = kind[texts.data]
    here, before, after = inside[1:-1], inside[:-2].copy(), inside[2:].copy()
    cuts = texts.begin[:-1]
    cuts = cuts[cuts < len(texts.data)]
    before[cuts] = False
    after[cuts[cuts > 0] - 1] = False
    start = np.flatnonzero(here & ~before)
    end = np.flatnonzero(here & ~after) + 1
    return Words(start, end, np.searchsorted(start, texts.begin))


def hashes(texts: Texts, found: Words, lower: bool = True) -> np.ndarray:
    """A hash of each word."""
    power, inverse = _powers_to(len(texts.data) + 1)
    total = np.zeros(len(texts.data) + 1, dtype=U64)
    np.cumsum((_LOWER if lower else _CODES)[texts.data] * power[: len(texts.data)], out=total[1:])
    return mix((total[found.end] - total[found.start]) * inverse[found.start] + (found.end - found.start).astype(U64))


def grams(codes: np.ndarray, size: int) -> np.ndarray:
    """A hash of the `size` codes from each place on; the last size - 1 places hold none of use."""
    out = np.zeros(len(codes), dtype=U64)
    n = len(codes) - size + 1
    if n > 0:
        for k in range(size):
            out[:n] = out[:n] * U64(_BASE) + codes[k : k + n]
        out[:n] = mix(out[:n])
    return out


def whole(found: Words, size: int) -> np.ndarray:
    """Whether the `size` words from each place on lie in one text."""
    left = np.repeat(found.first[1:], np.diff(found.first)) - np.arange(len(found.start))
    return left >= size


def shingle_sets(texts: Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct `size`-word shingles of each text, sorted; and where each text's begin.

    A text of fewer words has one shingle of all of them; a text without words has none.
    """
    found = words(texts)
    codes = hashes(texts, found)
    keep = whole(found, size)
    value, row = grams(codes, size)[keep], found.row[keep]
    counts = np.diff(found.first)
    few = np.flatnonzero((counts > 0) & (counts < size))
    if len(few):
        value = np.concatenate([value, [grams(codes[found.first[r] : found.first[r + 1]], counts[r])[0] for r in few]])
        row = np.concatenate([row, few])
        order = np.argsort(row, kind="stable")
        value, row = value[order], row[order]
    for a, b in zip(*[np.searchsorted(row, np.arange(texts.rows) + k) for k in (0, 1)], strict=True):
        value[a:b].sort()
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    value, row = value[new], row[new]
    return value, np.searchsorted(row, np.arange(texts.rows + 1))


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending 64-bit values as differences of as many bytes as the largest needs."""
    if not len(values):
        return b""
    steps = np.diff(values, prepend=U64(0))
    width = max(1, (int(steps.max()).bit_length() + 7) // 8)
    return bytes([width]) + np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def unpack_sorted(blob: bytes) -> np.ndarray:
    if not blob:
        return np.zeros(0, U64)
    width = blob[0]
    steps = np.zeros(((len(blob) - 1) // width, 8), np.uint8)
    steps[:, :width] = np.frombuffer(blob, np.uint8, offset=1).reshape(-1, width)
    return np.cumsum(steps.view("<u8").ravel().astype(U64), dtype=U64)


def lists(values: np.ndarray, first: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow column of lists from flat values and where each list begins."""
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values, kind))
