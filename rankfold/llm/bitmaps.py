"""Fixed-size bitmaps of hashed keys: a broadcast whose size never grows.

A bit is set for every key of a table, so a lookup has no false negatives;
false positives only let a row through that a later exact step removes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 26  # 8 MB
_CHUNK_BITS = 15  # bits of one row of bitmap_construct_agg


def bitmap(keys: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """uint8 array of ``2**bits`` bits with the low bits of every 64-bit key set."""
    place = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    rows = keys.select(F.shiftright(place, _CHUNK_BITS).alias("chunk"), place.bitwiseAND(F.lit((1 << _CHUNK_BITS) - 1)).alias("bit"))
    out = np.zeros((1 << bits) >> 3, np.uint8)
    size = (1 << _CHUNK_BITS) >> 3
    for r in rows.groupBy("chunk").agg(F.bitmap_construct_agg("bit").alias("data")).collect():  # 2^11 rows of 4 KB at most; one job
        out[r["chunk"] * size:(r["chunk"] + 1) * size] = np.frombuffer(r["data"], np.uint8)
    return out


def holds(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which 64-bit ``keys`` have their bit set."""
    place = keys.astype(np.uint64) & np.uint64(len(table) * 8 - 1)
    return (table[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
