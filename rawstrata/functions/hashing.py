"""Payload hashes as column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

SHA_BITS = 256


def json_hash(columns: Iterable[str]) -> Column:
    """Hash of the row as JSON. NULL fields stay in, so a NULL cannot move unnoticed."""
    document = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return F.sha2(document, SHA_BITS)


def piped_hash(columns: Iterable[str]) -> Column:
    """Older variant: values joined by two pipes. NULLs are skipped, so rows that differ
    only in where a NULL stands hash alike; kept for tables written that way."""
    return F.sha2(F.concat_ws("||", *columns), SHA_BITS)
