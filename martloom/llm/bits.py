"""Filters of fixed size for 64-bit hashes: what was put in always passes, other hashes pass as often as bits are set."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bit_filter(hashes: DataFrame, size: int) -> np.ndarray:
    """Bits set at the low ends of the 64-bit hashes in the one column of a table. `size`, in bits, is a power of two."""
    spot = F.col(hashes.columns[0])
    words = hashes.select(
        F.shiftright(spot.bitwiseAND(F.lit(size - 1)), 6).cast("int").alias("at"),
        F.call_function("shiftleft", F.lit(1).cast("long"), spot.bitwiseAND(F.lit(63)).cast("int")).alias("bit"),
    )
    held = words.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most size / 64 rows
    bits = np.zeros(size // 64, dtype=np.int64)
    bits[held.column("at").to_numpy()] = held.column("bits").to_numpy()
    return bits


def in_filter(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    low = hashes & (64 * len(bits) - 1)
    return (bits[low >> 6] >> (low & 63) & 1).astype(bool)
