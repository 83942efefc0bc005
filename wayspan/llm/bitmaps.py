"""Sets of 64-bit hashes as bitmaps of a fixed size, made by Spark and read with numpy.

A bitmap never misses a member; what it wrongly holds grows with the set, its size does not.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bitmap(keys: DataFrame, key: str, size: int) -> bytes:
    """The bits at the first and the last ``size`` bits of every key, ``2 ** size`` bits in all; at
    most ``2 ** (size - 6)`` longs are fetched."""
    spots = F.array(F.shiftrightunsigned(key, 64 - size), F.col(key).bitwiseAND(F.lit((1 << size) - 1)))
    longs = keys.select(F.explode(spots).alias("spot")).selectExpr("shiftright(spot, 6) AS long", "shiftleft(1L, cast(spot & 63 AS int)) AS bit")
    held = longs.groupBy("long").agg(F.bit_or("bit").alias("bits")).toPandas()
    out = np.zeros(1 << (size - 6), np.int64)
    out[held["long"].to_numpy(np.int64)] = held["bits"].to_numpy(np.int64)
    return out.tobytes()


def held(bits: bytes, keys: np.ndarray) -> np.ndarray:
    """Which of the unsigned keys the bitmap may hold; those it does not are in no case in the set."""
    data = np.frombuffer(bits, np.uint8)
    size = np.uint64((len(data) * 8).bit_length() - 1)
    out = np.ones(len(keys), bool)
    for spot in (keys >> (np.uint64(64) - size), keys & ((np.uint64(1) << size) - np.uint64(1))):
        out &= (data[(spot >> np.uint64(3)).astype(np.int64)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return out
