"""Bloom filters of a fixed size over 64-bit values, made by Spark and sent along with a task's code."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 1 << 24
_SHIFTS = (0, 32)


def build(values: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """The filter's words; at most bits / 64 rows come back, whatever the number of values."""
    bit = F.explode(F.array(*[F.shiftrightunsigned(column, s).bitwiseAND(bits - 1) for s in _SHIFTS]))
    found = values.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def may_hold(filter_: np.ndarray, values: np.ndarray) -> np.ndarray:
    """False only for values that were not put in."""
    out = np.ones(len(values), dtype=bool)
    for s in _SHIFTS:
        bit = (values >> np.uint64(s)) & np.uint64(64 * len(filter_) - 1)
        out &= (filter_[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
    return out
