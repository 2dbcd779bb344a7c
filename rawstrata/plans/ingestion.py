"""Land entities of a batch: load, enrich, validate, write, audit."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession

from rawstrata.operators import matching
from rawstrata.operators.audit import IngestionAuditRecord, append_audit_record
from rawstrata.operators.enrich import add_metadata_columns, add_short_metadata_columns
from rawstrata.operators.quality import (
    apply_validation_policy,
    check_required_columns,
    validate_bronze_data,
)
from rawstrata.operators.quarantine import write_with_quarantine
from rawstrata.operators.tables import (
    DEFAULT_FORMAT,
    WriteMetrics,
    quoted,
    sql_text,
    write_bronze_data,
    write_named_table,
)
from rawstrata.session import sized_shuffles, staged
from rawstrata.sources import storage
from rawstrata.sources.delimited import load_entity_data, resolve_source_path
from rawstrata.sources.storage import PathLike, child

# Fixed value: folder of the audit table below the bronze root.
AUDIT_TABLE = "ingestion_audit"

# Folder of the rows set aside, by entity and batch.
QUARANTINE = "quarantine"

# Fixed value: how a blocked batch is reported.
CONFLICT_MESSAGE = "Found {count} hash conflicts for entity '{entity}'"


@dataclass(frozen=True)
class BronzeIngestionConfig:
    """Where a batch comes from and where it goes.

    ``records_span_lines=False`` declares that no quoted field of the extracts holds a line break;
    files of any size are then read in splits. ``quarantine`` lands the rows without defects and
    sets the others aside, instead of refusing their whole batch.
    """

    data_root: PathLike
    bronze_root: PathLike
    source_batch_id: str
    source_system: str
    table_format: str = DEFAULT_FORMAT
    records_span_lines: bool = True
    quarantine: bool = False

    def source_path(self, entity: str) -> str:
        return resolve_source_path(self.data_root, self.source_batch_id, entity)

    def target_path(self, entity: str) -> str:
        return child(self.bronze_root, entity)

    def quarantine_path(self, entity: str) -> str:
        return child(self.bronze_root, QUARANTINE, entity)


def _load(spark: SparkSession, config: BronzeIngestionConfig, entity: str) -> DataFrame:
    return load_entity_data(
        spark,
        config.data_root,
        config.source_batch_id,
        entity,
        records_span_lines=config.records_span_lines,
    )


def load_and_enrich(
    spark: SparkSession, config: BronzeIngestionConfig, entity: str, pipeline_run_id: str
) -> DataFrame:
    """The entity's extract with hash and run metadata."""
    raw = _load(spark, config, entity)
    return raw.transform(
        add_metadata_columns, config.source_batch_id, pipeline_run_id, config.source_system
    )


class _EntityRun:
    """One entity on its way through the stages, with the audit record they fill."""

    def __init__(
        self, spark: SparkSession, config: BronzeIngestionConfig, entity: str, run_id: str
    ) -> None:
        self.spark, self.config, self.entity, self.run_id = spark, config, entity, run_id
        self.target = config.target_path(entity)
        self.audit = IngestionAuditRecord.start(
            source_batch_id=config.source_batch_id,
            pipeline_run_id=run_id,
            source_system=config.source_system,
            entity=entity,
            source_file_path=config.source_path(entity),
            target_table=self.target,
        )

    def land(self) -> None:
        """Run all stages. The parsed and hashed extract is written out once; validation,
        matching and the append each read only the columns they need from there."""
        enriched = load_and_enrich(self.spark, self.config, self.entity, self.run_id)
        seen = Observation()
        observed = enriched.observe(seen, *matching.bounds_of(matching.DEFAULT_KEYS))
        with staged(observed, self.entity) as extract:
            if self.config.quarantine:
                has_warnings = self.set_aside(extract)
            else:
                has_warnings = self.validate(extract)
                self.write(extract, matching.key_bounds(seen.get, matching.DEFAULT_KEYS))
        self.audit = self.audit.succeeded(has_warnings=has_warnings)

    def validate(self, extract: DataFrame) -> bool:
        report = validate_bronze_data(extract, self.entity)
        self.audit = self.audit.with_validation(report.metrics)
        apply_validation_policy(report)
        return bool(report.metrics.corrupt_record_count)

    def set_aside(self, extract: DataFrame) -> bool:
        """Land the rows without defects; the counts are those of the whole extract. Missing
        columns still refuse the batch."""
        report = validate_bronze_data(extract, self.entity)
        self.audit = self.audit.with_validation(report.metrics)
        missing = check_required_columns(extract, self.entity)
        if missing:
            apply_validation_policy(report)
        found = write_with_quarantine(
            self.spark,
            extract,
            self.target,
            self.config.quarantine_path(self.entity),
            self.config.source_batch_id,
            fmt=self.config.table_format,
        )
        self.take(found.written)
        return bool(report.metrics.corrupt_record_count or found.quarantined_row_count)

    def write(self, extract: DataFrame, bounds: matching.KeyBounds) -> None:
        self.take(
            write_bronze_data(
                self.spark, extract, self.target, fmt=self.config.table_format, bounds=bounds
            )
        )

    def take(self, metrics: WriteMetrics) -> None:
        self.audit = self.audit.with_write(metrics)
        conflicts = metrics.hash_conflict_count
        if conflicts:
            raise ValueError(CONFLICT_MESSAGE.format(count=conflicts, entity=self.entity))

    def input_bytes(self) -> int:
        paths = (self.audit.source_file_path, self.target)
        return sum(storage.size_bytes(self.spark, path) for path in paths)

    def append_audit(self) -> None:
        self.audit = self.audit.completed()
        append_audit_record(
            self.spark,
            self.audit,
            child(self.config.bronze_root, AUDIT_TABLE),
            self.config.table_format,
        )


def ingest_entity(
    spark: SparkSession, config: BronzeIngestionConfig, entity: str, pipeline_run_id: str
) -> IngestionAuditRecord:
    """Land one entity. Its audit row is written whatever happens; an error is raised again,
    and stays the error raised even if the audit row cannot be written."""
    run = _EntityRun(spark, config, entity, pipeline_run_id)
    try:
        with sized_shuffles(spark, run.input_bytes()):
            run.land()
    except Exception as error:
        run.audit = run.audit.failed(error)
        try:
            run.append_audit()
        except Exception as audit_error:
            error.add_note(f"The audit row could not be written: {audit_error}")
        raise
    run.append_audit()
    return run.audit


def ingest_batch(
    spark: SparkSession, config: BronzeIngestionConfig, entities: Sequence[str]
) -> tuple[IngestionAuditRecord, ...]:
    """Land entities one after another under one run id; the first failure ends the batch."""
    land = partial(ingest_entity, spark, config, pipeline_run_id=str(uuid.uuid4()))
    return tuple(map(land, entities))


def ingest_named_entity(
    spark: SparkSession,
    config: BronzeIngestionConfig,
    entity: str,
    pipeline_run_id: str,
    database: str = "bronze",
) -> DataFrame:
    """Older flow: land one entity in a catalog table, without validation or audit.

    Uses the older hash and column names and plain key equality. The database is created
    at the bronze root if it is missing. Returns a scan of the table.
    """
    root = sql_text(storage.qualified(spark, config.bronze_root))
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)} LOCATION {root}")
    raw = _load(spark, config, entity)
    enriched = add_short_metadata_columns(
        raw, config.source_batch_id, pipeline_run_id, config.source_system
    )
    table, target = f"{database}.{entity}", config.target_path(entity)
    paths = (config.source_path(entity), target)
    with sized_shuffles(spark, sum(storage.size_bytes(spark, path) for path in paths)):
        seen = Observation()
        observed = enriched.observe(seen, *matching.bounds_of(matching.DEFAULT_KEYS))
        with staged(observed, entity) as extract:
            bounds = matching.key_bounds(seen.get, matching.DEFAULT_KEYS)
            write_named_table(
                spark, extract, table, target, fmt=config.table_format, bounds=bounds
            )
    return spark.table(table)
