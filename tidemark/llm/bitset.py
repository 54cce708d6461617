"""A fixed-size Bloom filter of 64-bit hashes, built by Spark.

The filter has ``2 ** bits`` bits whatever the number of hashes, so what is
gathered and broadcast has a proven bound.  It only ever spares work: a hash
that was put in is always found, one that was not may be found too.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 27          # 16 MB
_BUCKET = 1 << 15  # bits of one of Spark's bitmaps


def _places(bits: int) -> list[str]:
    top = (1 << bits) - 1
    return [f"h & {top}L", f"shiftrightunsigned(h, {64 - bits})"]


def bloom(rows: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """The filter of all values of ``column`` (long) as bytes."""
    places = (rows.select(F.col(column).alias("h"))
              .select(F.explode(F.array(*map(F.expr, _places(bits)))).alias("p")))
    maps = (places.groupBy(F.expr("bitmap_bucket_number(p + 1)").alias("bucket"))
            .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(p + 1))").alias("map")))
    out = np.zeros((1 << bits) // 8, dtype=np.uint8)
    for r in maps.collect():  # at most 2 ** bits bits
        lo = (r.bucket - 1) * _BUCKET // 8
        out[lo:lo + _BUCKET // 8] = np.frombuffer(r.map, dtype=np.uint8)
    return out


def found(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes (uint64) the filter holds."""
    bits = int(len(table) * 8).bit_length() - 1
    out = np.ones(len(hashes), dtype=bool)
    for p in (hashes & np.uint64((1 << bits) - 1), hashes >> np.uint64(64 - bits)):
        out &= (table[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 > 0
    return out
