"""A bitmap of hashes for Python tasks: which may be wanted."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F


class Bitmap:
    """One bit per hash; a hash that was put in is always found, others seldom."""

    def __init__(self, bits: int, data: np.ndarray):
        self.bits, self.data = bits, data

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & np.uint64(self.bits - 1)
        byte = self.data[(at >> np.uint64(3)).astype(np.int64)]
        return (byte >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bitmap(hashes: DataFrame, wanted: int, *, bits_each: int, least: int, most: int) -> Bitmap:
    """Of a frame of 64-bit ``hash``, ``wanted`` rows of them: ``bits_each`` bits for each, between
    ``least`` and ``most`` bits together, powers of two. That is what reaches the driver."""
    bits = least
    while bits < min(most, wanted * bits_each):
        bits *= 2
    place = F.col("hash").bitwiseAND(F.lit(bits - 1)) + 1
    pieces = (
        hashes.select(place.alias("bit"))
        .groupBy(F.bitmap_bucket_number("bit").alias("piece"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bytes"))
        .toArrow()
    )
    data = np.zeros(bits // 8, dtype=np.uint8)
    for piece, held in zip(pieces["piece"].to_pylist(), pieces["bytes"].to_pylist(), strict=True):
        part = np.frombuffer(held, dtype=np.uint8)
        start = (piece - 1) * len(part)
        data[start : start + len(part)] = part[: len(data) - start]
    return Bitmap(bits, data)
