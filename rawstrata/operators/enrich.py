"""Add the payload hash and run metadata to a raw frame."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime, timezone
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from rawstrata.contracts import RECORD_HASH
from rawstrata.functions.hashing import json_hash, piped_hash


class MetadataNames(NamedTuple):
    """Names of the run columns."""

    batch: str = "_source_batch_id"
    run: str = "_pipeline_run_id"
    system: str = "_source_system"
    ingested: str = "_ingested_timestamp"


STANDARD_NAMES = MetadataNames()
SHORT_NAMES = MetadataNames(batch="_batch_id", run="_run_id")


def add_record_hash(
    df: DataFrame, expression: Callable[[Iterable[str]], Column] = json_hash
) -> DataFrame:
    """Hash every column the frame has now, in order; call it before adding metadata."""
    return df.withColumn(RECORD_HASH, expression([f"`{name}`" for name in df.columns]))


def add_ingestion_metadata(
    df: DataFrame,
    source_batch_id: str,
    run_id: str,
    source_system: str,
    *,
    ingested_at: datetime | None = None,
    names: MetadataNames = STANDARD_NAMES,
) -> DataFrame:
    """Add batch, run, source system and one ingestion time for the entire frame.

    The time is a literal taken when the plan is built: however often the plan runs, and
    whichever tasks run again, all rows of a run carry the same value.
    """
    ingested_at = ingested_at or datetime.now(timezone.utc)
    values = (source_batch_id, run_id, source_system, ingested_at)
    return df.withColumns({name: F.lit(value) for name, value in zip(names, values)})


def add_metadata_columns(
    df: DataFrame,
    source_batch_id: str,
    pipeline_run_id: str,
    source_system: str,
    *,
    ingested_at: datetime | None = None,
) -> DataFrame:
    """Hash the raw payload, then add the run metadata."""
    return df.transform(add_record_hash).transform(
        add_ingestion_metadata,
        source_batch_id,
        pipeline_run_id,
        source_system,
        ingested_at=ingested_at,
    )


def add_short_metadata_columns(
    df: DataFrame,
    batch_id: str,
    run_id: str,
    source_system: str,
    *,
    ingested_at: datetime | None = None,
) -> DataFrame:
    """Older layout: the piped hash and the short batch and run column names."""
    return add_record_hash(df, piped_hash).transform(
        add_ingestion_metadata,
        batch_id,
        run_id,
        source_system,
        ingested_at=ingested_at,
        names=SHORT_NAMES,
    )
