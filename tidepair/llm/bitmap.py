"""A filter of fixed size for a set of keys, to leave out most other rows before a shuffle.

It lets through every key of the set and some others, so an exact join follows.
Its size is bounded by ``MOST_BITS`` whatever the number of keys.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS_FOR_KEY = 64
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 27


def key_bits(keys: DataFrame, column: str) -> np.ndarray:
    """64-bit words with one bit set for each key (a bigint whose high bits are random)."""
    wanted = max(LEAST_BITS, BITS_FOR_KEY * keys.count())
    bits = min(MOST_BITS, 1 << (wanted - 1).bit_length())
    slot = F.shiftrightunsigned(column, 64 - bits.bit_length() + 1)
    words = (
        keys.select(slot.alias("slot"))
        .groupBy(F.shiftright("slot", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 AS int))")).alias("bits"))
        .toArrow()
    )
    out = np.zeros(bits // 64, np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out


def may_hold(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = keys.astype(np.uint64, copy=False) >> np.uint64(64 - (len(bits) * 64).bit_length() + 1)
    return (bits.view(np.uint64)[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


class Held:
    """A filter that tasks read, until it is let go of."""

    def __init__(self, keys: DataFrame, column: str):
        self.shared = keys.sparkSession.sparkContext.broadcast(key_bits(keys, column))

    def filter(self, rows: DataFrame, column: str) -> DataFrame:
        """The rows whose key may be in the set."""
        shared = self.shared

        def hold(batches):
            for batch in batches:
                yield batch.filter(pa.array(may_hold(shared.value, batch.column(column).to_numpy())))

        return rows.mapInArrow(hold, rows.schema)

    def close(self) -> None:
        self.shared.destroy()
