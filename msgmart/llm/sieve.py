"""A filter of fixed size for the keys of rows that some later join needs.

It is a bitmap, collected and broadcast: 8 MB, whatever the input. No key it was made of fails it. The more keys,
the more others pass too; the exact join behind it then gets more rows, never other results.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 26


def sieve(keys: DataFrame, key: str | Column):
    """A broadcast bitmap of the 64-bit hashes `key`."""
    cell = F.shiftrightunsigned(F.col(key) if isinstance(key, str) else key, 64 - BITS)
    words = keys.select(cell.alias("cell")).groupBy(F.expr("cast(shiftright(cell, 6) as int)").alias("word"))
    words = words.agg(F.bit_or(F.expr("shiftleft(1L, cast(cell & 63 as int))")).alias("bits")).toArrow()
    table = np.zeros(1 << (BITS - 6), dtype="<i8")
    table[words["word"].to_numpy()] = words["bits"].to_numpy()
    return keys.sparkSession.sparkContext.broadcast(table.tobytes())


def passes(bitmap: bytes, hashes: np.ndarray) -> np.ndarray:
    """Which of the 64-bit hashes pass."""
    cell = hashes.view(np.uint64) >> np.uint64(64 - BITS)
    return (np.frombuffer(bitmap, np.uint8)[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 == 1


def passes_one(bitmap: bytes, h: int) -> bool:
    cell = (h >> (64 - BITS)) & ((1 << BITS) - 1)
    return bool(bitmap[cell >> 3] >> (cell & 7) & 1)
