"""Elias-Fano sequences: ascending numbers in about 2 + log2(universe / n) bits each, read from mapped memory.

Beside the two halves stand, for each 64 bits of the upper half, how many ones and zeros come before: a place is found from
them and the one number it falls into, so nothing is unpacked on loading.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
_RUN = 1 << 16  # values spread to bits at a time; a multiple of 8, so runs end at a byte
_HEADER = 3  # numbers of 8 bytes: count, low bits, numbers of the upper half


def _padded(data: bytes) -> bytes:
    return data + bytes(-len(data) % 8)


def encode(values: np.ndarray, universe: int) -> bytes:
    """`values` ascending (repeats allowed), each below `universe` (at most 2**64); below 2**31 of them."""
    n = len(values)
    low_bits = max(0, min(56, (universe // max(n, 1)).bit_length() - 1))
    values = values.astype(U64)
    high = (values >> U64(low_bits)).astype(np.int64) + np.arange(n)
    bits = np.zeros(-(-(int(high[-1]) + 2 if n else 1) // 64) * 64, dtype=bool)
    bits[high] = True
    upper = np.packbits(bits, bitorder="little").view("<u8")
    ones = np.concatenate([[0], np.cumsum(np.bitwise_count(upper), dtype=np.int64)])
    zeros = np.arange(len(ones)) * 64 - ones
    lower = np.zeros(0, np.uint8)
    if low_bits and n:
        places = np.arange(low_bits, dtype=U64)
        runs = (values[k : k + _RUN] for k in range(0, n, _RUN))
        lower = np.concatenate([np.packbits(((x[:, None] >> places) & U64(1)).astype(bool).ravel(), bitorder="little") for x in runs])
    head = np.array([n, low_bits, len(upper)], "<u8")
    return b"".join([head.tobytes(), *(_padded(x.astype("<u4").tobytes()) for x in (ones, zeros)), upper.tobytes(), lower.tobytes(), bytes(8)])


def _nth_one(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The place of the n-th (from 0) one among the 64 bits of x."""
    place = np.zeros(len(x), np.int64)
    for size in (32, 16, 8, 4, 2, 1):
        ones = np.bitwise_count(x & U64((1 << size) - 1)).astype(np.int64)
        on = n >= ones
        n = n - ones * on
        place += size * on
        x = np.where(on, x >> U64(size), x)
    return place


class EliasFano:
    """Reads `encode`'s bytes where they are."""

    def __init__(self, memory: np.ndarray):
        self.n, self.bits, size = (int(x) for x in memory[: 8 * _HEADER].view("<u8"))
        at, counts = 8 * _HEADER, -(-(size + 1) // 2) * 8
        self._ones, self._zeros = (memory[at + k * counts : at + (k + 1) * counts].view("<u4")[: size + 1] for k in (0, 1))
        at += 2 * counts
        self._upper = memory[at : at + 8 * size].view("<u8")
        lower = memory[at + 8 * size :]
        self._low = np.ndarray((max(0, len(lower) - 7),), "<u8", buffer=lower, strides=(1,)) if self.bits else None

    def low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), U64)
        at = i.astype(np.int64) * self.bits
        return (self._low[at >> 3] >> (at & 7).astype(U64)) & U64((1 << self.bits) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        """The values at places i."""
        k = np.searchsorted(self._ones, i.astype("<u4"), side="right") - 1
        high = k * 64 + _nth_one(self._upper[k], i - self._ones[k].astype(np.int64)) - i
        return (high.astype(U64) << U64(self.bits)) | self.low(i)

    def bucket(self, high: np.ndarray) -> np.ndarray:
        """How many values have an upper part below each `high`: the ones before the zero that ends the part before it."""
        last = int(self._zeros[-1])
        out = np.where(high > last, self.n, 0)
        some = np.flatnonzero((high > 0) & (high <= last))
        zero = high[some] - 1
        k = np.searchsorted(self._zeros, zero.astype("<u4"), side="right") - 1
        out[some] = k * 64 + _nth_one(~self._upper[k], zero - self._zeros[k].astype(np.int64)) - zero
        return out

    def _search(self, x: np.ndarray, begin, end) -> tuple[np.ndarray, np.ndarray]:
        high = (x >> U64(self.bits)).astype(np.int64)
        lo = np.maximum(self.bucket(high), begin)
        last = np.maximum(np.minimum(self.bucket(high + 1), end), lo)
        hi = last.copy()
        want = x & U64((1 << self.bits) - 1)
        live = np.flatnonzero(lo < hi)
        while len(live):
            mid = (lo[live] + hi[live]) >> 1
            less = self.low(mid) < want[live]
            lo[live[less]] = mid[less] + 1
            hi[live[~less]] = mid[~less]
            live = live[lo[live] < hi[live]]
        return lo, last

    def successor(self, x: np.ndarray) -> np.ndarray:
        """The first place whose value is at least x (n if there is none): a jump to x's bucket, then halving within it."""
        return self._search(x, 0, self.n)[0]

    def index(self, x: np.ndarray, begin=0, end=None) -> np.ndarray:
        """The place of x from `begin` to before `end`, or -1."""
        at, last = self._search(x, begin, self.n if end is None else end)
        some = np.flatnonzero(at < last)
        held = some[self.low(at[some]) == x[some] & U64((1 << self.bits) - 1)]
        out = np.full(len(x), -1)
        out[held] = at[held]
        return out
