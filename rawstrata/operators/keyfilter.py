"""A bitmap of a batch's keys, to keep rows that cannot match out of a shuffle.

Ranges prune a target whose keys are ordered; keys such as hashes or random ids lie all over
every range. The bitmap has one bit per key hash and is sized from the measured number of keys,
up to a bound, beyond which it lets more rows pass and stays right.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

BITS_PER_KEY = 16
LEAST_BITS = 1 << 15  # one piece of Spark's bitmap functions
MOST_BITS = 1 << 29  # 64 MB


def bits_for(keys: int) -> int:
    """A power of two with ``BITS_PER_KEY`` bits for each key, as far as the bound lets."""
    wanted = min(MOST_BITS, max(LEAST_BITS, keys * BITS_PER_KEY))
    return 1 << (wanted - 1).bit_length()


def _place(keys: Sequence[str], bits: int) -> Column:
    """Bit of a row's keys, from 1. NULL keys hash like any other value."""
    nulls = [F.col(key).isNull() for key in keys]
    return F.xxhash64(*keys, *nulls).bitwiseAND(F.lit(bits - 1)) + 1


def key_bitmap(rows: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """Pieces (``piece``, ``bits``) of the bitmap of all rows' keys: ``bits`` bits at most."""
    place = rows.select(_place(keys, bits).alias("place"))
    return place.groupBy(F.bitmap_bucket_number("place").alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")
    )


def likely_members(rows: DataFrame, bitmap: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """The rows whose keys the bitmap may hold: all that it holds, few others.

    The bitmap's size is bounded by ``bits``, so it is broadcast and the rows stay where they are.
    """
    return _tested(rows, bitmap, keys, bits, "inner", lambda is_set: is_set)


def certain_strangers(
    rows: DataFrame, bitmap: DataFrame, keys: Sequence[str], bits: int
) -> DataFrame:
    """The other rows: their keys are none of the bitmap's."""
    return _tested(
        rows, bitmap, keys, bits, "left", lambda is_set: ~F.coalesce(is_set, F.lit(False))
    )


def _tested(
    rows: DataFrame,
    bitmap: DataFrame,
    keys: Sequence[str],
    bits: int,
    how: str,
    passes: Callable[[Column], Column],
) -> DataFrame:
    place = _place(keys, bits)
    at = F.bitmap_bit_position(place)
    byte_at = F.floor(at / 8).cast("int") + 1
    byte = F.conv(F.hex(F.substring("_bitmap_bits", byte_at, F.lit(1))), 16, 10)
    is_set = F.call_function("shiftright", byte.cast("int"), (at % 8).cast("int")) % 2 == 1
    pieces = F.broadcast(
        bitmap.select(F.col("piece").alias("_bitmap_piece"), F.col("bits").alias("_bitmap_bits"))
    )
    joined = rows.join(pieces, F.bitmap_bucket_number(place) == F.col("_bitmap_piece"), how)
    return joined.filter(passes(is_set)).drop("_bitmap_piece", "_bitmap_bits")
