"""Compare an incoming batch with a target table on their merge keys.

The comparison never pairs rows up. A key that holds a third of both sides would give
more pairs than any cluster can emit, so rows are counted per key and payload hash, and
the number of pairs follows from the counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StringType

from rawstrata.contracts import RECORD_HASH, SOURCE_RECORD_ID, SOURCE_SYSTEM
from rawstrata.functions.predicates import keys_equal
from rawstrata.operators.keyfilter import (
    bits_for,
    certain_strangers,
    key_bitmap,
    likely_members,
)

# The default row identity.
DEFAULT_KEYS = (SOURCE_SYSTEM, SOURCE_RECORD_ID)

# Pair counts are products of row counts and may pass 64 bits on the way to a sum.
WIDE = "decimal(38,0)"

# The keys of a batch may be broadcast up to this size, counted with a row's fixed costs.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD_BYTES = 64


def validate_merge_keys(df: DataFrame, merge_keys: Sequence[str]) -> None:
    """Refuse an empty key list and keys the frame does not have."""
    if len(merge_keys) == 0:
        raise ValueError("At least one merge key is required")
    absent = tuple(key for key in merge_keys if key not in df.columns)
    if absent:
        raise ValueError(f"Merge key columns are missing from source: {absent}")


def _with_usable_keys(df: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    """Under plain equality a NULL key matches nothing, so those rows can go early."""
    return df if null_safe else df.dropna(subset=list(keys))


class KeyBounds(NamedTuple):
    """What a batch's keys are known to be: rows, memory, and the range of each key."""

    keys: tuple[str, ...]
    rows: int
    key_bytes: int
    ranges: tuple[tuple[object, object, bool], ...]

    @property
    def may_broadcast(self) -> bool:
        return self.key_bytes <= MAX_BROADCAST_BYTES

    def covers(self) -> Column:
        """Whether a target row's keys lie in the batch's ranges; a scan can push this down."""
        inside = F.lit(True)
        for key, (low, high, has_null) in zip(self.keys, self.ranges, strict=True):
            column = F.col(key)
            test = F.lit(False) if low is None else column.between(F.lit(low), F.lit(high))
            inside &= (test | column.isNull()) if has_null else test
        return inside


def bounds_of(keys: Sequence[str]) -> list[Column]:
    """Aggregates from which :func:`key_bounds` makes the bounds of a batch, so that they can
    be observed while the batch is written."""
    width = F.lit(ROW_OVERHEAD_BYTES)
    for key in keys:
        width += F.coalesce(F.octet_length(F.col(key).cast("string")), F.lit(0))
    ranges = []
    for place, key in enumerate(keys):
        ranges += [
            F.min(key).alias(f"low_{place}"),
            F.max(key).alias(f"high_{place}"),
            F.coalesce(F.max(F.col(key).isNull()), F.lit(False)).alias(f"null_{place}"),
        ]
    total = F.coalesce(F.sum(width.cast("bigint")), F.lit(0))
    return [F.count(F.lit(1)).alias("rows"), total.alias("key_bytes"), *ranges]


def key_bounds(found: Mapping[str, object], keys: Sequence[str]) -> KeyBounds:
    """The bounds from the values of the aggregates."""
    ranges = tuple(
        (found[f"low_{place}"], found[f"high_{place}"], bool(found[f"null_{place}"]))
        for place in range(len(keys))
    )
    return KeyBounds(tuple(keys), found["rows"], found["key_bytes"], ranges)


def target_hits(
    incoming: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    *,
    null_safe: bool = True,
    broadcast_keys: bool = False,
    batch_rows: int | None = None,
) -> DataFrame:
    """Key and hash of the target rows whose key occurs in the batch.

    This is the one pass over the target, and it reads its key and hash columns only. With
    the batch's keys broadcast it needs no shuffle; ask for that only when they are known
    to be small. Otherwise both sides shuffle, but of the target only rows that a bitmap of the
    batch's keys lets pass, where the number of the batch's rows is known; ids in no order then
    cost a target no shuffle either. The batch has each key once by then, and adaptive execution
    splits a hot key of the target.
    """
    named = _with_usable_keys(incoming.select(*keys), keys, null_safe)
    wanted = named.distinct()
    columns = [*keys, RECORD_HASH] if RECORD_HASH in target.columns else list(keys)
    held = target.select(*columns)
    on_keys = keys_equal("tgt", "src", keys, null_safe=null_safe)
    if broadcast_keys or batch_rows is None:
        wanted = F.broadcast(wanted) if broadcast_keys else wanted
        return held.alias("tgt").join(wanted.alias("src"), on_keys, "left_semi")
    bits = bits_for(batch_rows)
    likely = likely_members(held, key_bitmap(named, keys, bits), keys, bits)
    # Each key is there once, so this is the semi-join; that one would move below the bitmap.
    return likely.alias("tgt").join(wanted.alias("src"), on_keys).select("tgt.*")


def matched_keys(
    incoming: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    *,
    null_safe: bool = True,
    broadcast_keys: bool = False,
    batch_rows: int | None = None,
    unmatched_too: bool = False,
) -> DataFrame:
    """One row per key that both sides hold, with its counts; if asked, also one per key that
    only the batch holds, with no ``target_rows``.

    ``incoming_rows`` and ``target_rows`` count rows; ``replay_pairs`` and
    ``conflict_pairs`` count the pairs a join on the key would give, split by whether the
    payload hashes agree (NULL agrees with NULL). Without a hash column on both sides every
    match is a replay.

    Without the keys broadcast, target rows are not joined first: the counts tell which keys the
    batch lacks, so both sides are shuffled once, the target by what a bitmap lets pass.
    """
    hashed = RECORD_HASH in incoming.columns and RECORD_HASH in target.columns
    batch = _with_usable_keys(incoming, keys, null_safe)
    if broadcast_keys:
        hits = target_hits(incoming, target, keys, null_safe=null_safe, broadcast_keys=True)
    else:
        held = target.select(*keys, RECORD_HASH) if hashed else target.select(*keys)
        hits = _with_usable_keys(held, keys, null_safe)
        if batch_rows is not None:
            bits = bits_for(batch_rows)
            hits = likely_members(hits, key_bitmap(batch, keys, bits), keys, bits)
    of_text = hashed and all(
        df.schema[RECORD_HASH].dataType == StringType() for df in (incoming, target)
    )

    def narrow(df: DataFrame, from_batch: int) -> DataFrame:
        payload = F.col(RECORD_HASH) if hashed else F.lit(None).cast("string")
        parts = _packed(payload) if of_text else (payload, F.lit(None).cast("string"))
        named = [part.alias(name) for part, name in zip(parts, ("payload", "payload_text"))]
        return df.select(*keys, *named, F.lit(from_batch).alias("from_batch"))

    both = narrow(batch, 1).unionByName(narrow(hits, 0))
    per_payload = both.groupBy(*keys, "payload", "payload_text").agg(
        F.count_if(F.col("from_batch") == 1).alias("n_in"),
        F.count_if(F.col("from_batch") == 0).alias("n_tgt"),
    )
    same_payload = F.col("n_in").cast(WIDE) * F.col("n_tgt")
    per_key = per_payload.groupBy(*keys).agg(
        F.sum("n_in").alias("incoming_rows"),
        F.sum("n_tgt").alias("target_rows"),
        F.sum(same_payload.cast(WIDE)).cast(WIDE).alias("replay_pairs"),
    )
    all_pairs = (F.col("incoming_rows").cast(WIDE) * F.col("target_rows")).cast(WIDE)
    held_by = "incoming_rows > 0" if unmatched_too else "incoming_rows > 0 AND target_rows > 0"
    return per_key.filter(held_by).select(
        *keys,
        "incoming_rows",
        "target_rows",
        F.col("replay_pairs").cast("bigint"),
        (all_pairs - F.col("replay_pairs")).cast("bigint").alias("conflict_pairs"),
    )


def _packed(text: Column) -> tuple[Column, Column]:
    """Two columns that are equal where a text is: lower-case hex digits, as hashes have them, as
    half as many bytes, and what is no such text as it is."""
    as_bytes = F.unhex(text)
    is_hex = F.coalesce(F.lower(F.hex(as_bytes)) == text, F.lit(False))
    return F.when(is_hex, as_bytes), F.when(~is_hex, text)


def match_counts() -> list[Column]:
    """Aggregates over compared keys: replay, conflict and matched-row counts."""

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value.cast(WIDE)), F.lit(0)).cast("bigint")

    matched_rows = F.when(F.col("target_rows") > 0, F.col("incoming_rows"))
    return [
        total(F.col("replay_pairs")).alias("replay_existing_row_count"),
        total(F.col("conflict_pairs")).alias("hash_conflict_count"),
        total(matched_rows).alias("matched_row_count"),
    ]


def classify(matched: DataFrame) -> DataFrame:
    """Sum a frame of matched keys into one row of counts."""
    return matched.agg(*match_counts())


def hash_conflicts(matched: DataFrame) -> DataFrame:
    """Matched keys under which some payload differs from the target's."""
    return matched.filter("conflict_pairs > 0")


def first_conflict(matched: DataFrame, keys: Sequence[str] = DEFAULT_KEYS) -> DataFrame:
    """At most one conflicting key: the smallest, so a repeated run names the same one."""
    return hash_conflicts(matched).select(*keys).orderBy(*keys).limit(1)


def new_rows(
    incoming: DataFrame,
    held: DataFrame,
    keys: Sequence[str],
    *,
    null_safe: bool = True,
    fresh_keys: DataFrame | None = None,
    batch_rows: int = 0,
) -> DataFrame:
    """Incoming rows whose key ``held`` lacks: the rows an insert-only merge adds.

    ``held`` is the target or, cheaper, the keys already known to match. Its keys are made
    distinct first, which combines before the shuffle, so a hot key of it is one row per task.
    Under plain equality rows with a NULL key match nothing: they stay out of the join, where
    they would all meet in one task.

    Where the batch's other keys are known too (``fresh_keys``, each once), bitmaps of both, sized
    by the batch's rows, tell for nearly every row on which side it is. Only rows that both
    bitmaps let pass are shuffled, and of the fresh keys those that the held ones' lets pass.
    """
    wanted = _with_usable_keys(held.select(*keys), keys, null_safe).distinct()
    on_keys = keys_equal("src", "held", keys, null_safe=null_safe)

    def unmatched(rows: DataFrame) -> DataFrame:
        if fresh_keys is None:
            return rows.alias("src").join(wanted.alias("held"), on_keys, "left_anti")
        bits = bits_for(batch_rows)
        old, fresh = key_bitmap(held, keys, bits), key_bitmap(fresh_keys, keys, bits)
        unsure = likely_members(likely_members(rows, old, keys, bits), fresh, keys, bits)
        named = likely_members(fresh_keys.select(*keys), old, keys, bits)
        # Each key is there once, so this is the semi-join; that one would move below the bitmaps.
        found = unsure.alias("src").join(named.alias("held"), on_keys).select("src.*")
        return certain_strangers(rows, old, keys, bits).unionByName(found)

    if null_safe:
        return unmatched(incoming)
    complete = reduce(Column.__and__, [F.col(key).isNotNull() for key in keys])
    return unmatched(incoming.filter(complete)).unionByName(incoming.filter(~complete))


def reduce_to_one_per_key(
    df: DataFrame,
    keys: Sequence[str] = DEFAULT_KEYS,
    order: Sequence[str] = ("_ingested_timestamp", RECORD_HASH),
) -> DataFrame:
    """Keep the first row of each key in the given order. Opt-in: no write calls it.

    Columns outside ``order`` break ties. Spark keeps one candidate per key and task before
    it shuffles, so a hot key reaches its reducer as a handful of rows.
    """
    validate_merge_keys(df, keys)
    rest = [name for name in df.columns if name not in keys and name not in order]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, *rest))
    return df.withColumn("_place", place).filter("_place = 1").drop("_place")
