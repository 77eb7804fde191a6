"""A bit map over well-mixed 64-bit keys, made by built-in aggregates and tested in Arrow tasks.

It lets a second pass over the texts drop most rows that have no partner before anything is shuffled. Each key has two
bits, from its low and its high end. The map has about ``BITS_PER_KEY`` bits per key, so about one other key in seventy
passes, but never more than ``MOST_BITS`` (64 MB): beyond 33 million keys it fills up, at 180 million one other key in four
passes. Every user of it joins exactly afterwards, so that costs time and space and never changes a result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 16
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 29
BUCKET_BITS = 32768


def build(keys: DataFrame, column: str, most_bits: int = MOST_BITS) -> np.ndarray:
    """Bit map of a long column; the driver gets ``most_bits / 8`` bytes at most. ``keys`` is read twice."""
    keys = keys.filter(F.col(column).isNotNull())
    wanted = max(LEAST_BITS, BITS_PER_KEY * keys.count())
    width = min(most_bits, 1 << (wanted - 1).bit_length()).bit_length() - 1
    low = F.col(column).bitwiseAND(F.lit((1 << width) - 1))
    high = F.shiftrightunsigned(column, 64 - width)
    rows = (
        keys.select(F.explode(F.array(low + 1, high + 1)).alias("place"))
        .groupBy(F.bitmap_bucket_number("place").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
        .collect()
    )
    out = np.zeros((1 << width) // 8, np.uint8)
    for row in rows:
        start = (row.bucket - 1) * (BUCKET_BITS // 8)
        out[start : start + BUCKET_BITS // 8] = np.frombuffer(bytes(row.bits), np.uint8)
    return out


def holds(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key may be in the map."""
    key = keys.astype(np.int64).view(np.uint64)
    width = (len(bitmap) * 8).bit_length() - 1
    found = np.ones(len(key), bool)
    for place in (key & np.uint64((1 << width) - 1), key >> np.uint64(64 - width)):
        found &= (bitmap[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return found
