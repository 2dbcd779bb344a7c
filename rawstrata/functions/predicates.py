"""Row predicates as column expressions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, functions as F

# Log levels and their rank; a level not listed ranks as INFO.
LEVEL_RANK = {"DEBUG": 0, "INFO": 1, "WARN": 2, "ERROR": 3}


def is_blank(column: Column) -> Column:
    """NULL or the empty string. Spaces are not trimmed."""
    return column.isNull() | (column == "")


def keys_equal(left: str, right: str, keys: Iterable[str], *, null_safe: bool = True) -> Column:
    """Conjunction over the keys of two aliased frames; ``null_safe`` lets NULL match NULL."""
    pairs = ((F.col(f"{left}.{key}"), F.col(f"{right}.{key}")) for key in keys)
    tests = (a.eqNullSafe(b) if null_safe else a == b for a, b in pairs)
    return reduce(Column.__and__, tests)


def level_rank(level: Column) -> Column:
    """Rank of a log level, for minimum-level filters."""
    ranks = F.create_map(*[F.lit(x) for pair in LEVEL_RANK.items() for x in pair])
    return F.coalesce(ranks[level], F.lit(LEVEL_RANK["INFO"]))
