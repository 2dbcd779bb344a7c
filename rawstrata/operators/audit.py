"""One audit row per entity and run."""

from __future__ import annotations

import json
import re
from dataclasses import asdict, make_dataclass, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from rawstrata.contracts import AUDIT_SCHEMA
from rawstrata.operators.quality import ValidationMetrics
from rawstrata.operators.tables import (
    DEFAULT_FORMAT,
    WriteMetrics,
    append_rows,
    create_table,
    in_target_layout,
)
from rawstrata.sources import storage
from rawstrata.sources.storage import PathLike, PathState

# Run states.
IN_PROGRESS = "IN_PROGRESS"
SUCCESS = "SUCCESS"
SUCCESS_WITH_WARNINGS = "SUCCESS_WITH_WARNINGS"
FAILED = "FAILED"


_Row = make_dataclass(
    "_Row", [(name, object, None) for name in AUDIT_SCHEMA.names], frozen=True
)


class IngestionAuditRecord(_Row):
    """State of one entity's run, in the audit table's columns. A count of ``None`` means its
    stage was not reached."""

    @classmethod
    def start(
        cls,
        *,
        source_batch_id: str,
        pipeline_run_id: str,
        source_system: str,
        entity: str,
        source_file_path: str,
        target_table: str,
    ) -> IngestionAuditRecord:
        """A run that has just begun; it ends when it starts until told otherwise."""
        now = datetime.now(timezone.utc)
        return cls(
            source_batch_id=source_batch_id,
            pipeline_run_id=pipeline_run_id,
            source_system=source_system,
            entity=entity,
            source_file_name=source_file_path.rsplit("/", 1)[-1],
            source_file_path=source_file_path,
            target_table=target_table,
            status=IN_PROGRESS,
            started_at=now,
            completed_at=now,
        )

    def with_validation(self, metrics: ValidationMetrics) -> IngestionAuditRecord:
        return replace(
            self,
            source_row_count=metrics.row_count,
            corrupt_record_count=metrics.corrupt_record_count,
            null_business_key_count=metrics.null_or_blank_source_record_id_count,
            duplicate_business_key_count=metrics.distinct_duplicated_source_record_id_count,
            duplicate_rows_beyond_first=metrics.duplicate_rows_beyond_first_count,
        )

    def with_write(self, metrics: WriteMetrics) -> IngestionAuditRecord:
        return replace(self, **asdict(metrics))

    def succeeded(self, *, has_warnings: bool) -> IngestionAuditRecord:
        return replace(self, status=SUCCESS_WITH_WARNINGS if has_warnings else SUCCESS)

    def failed(self, error: BaseException) -> IngestionAuditRecord:
        return replace(self, status=FAILED, error_message=f"{type(error).__name__}: {error}")

    def completed(self) -> IngestionAuditRecord:
        return replace(self, completed_at=datetime.now(timezone.utc))


# The audit table's layout, beside its files and hidden from scans of them.
LAYOUT_FILE = "_layout.json"

# How Spark's writers name files.
WRITTEN_FILE = re.compile(r"part-\d{5,}-[0-9a-f-]{36}[-.].*")


def append_audit_record(
    spark: SparkSession,
    record: IngestionAuditRecord,
    audit_target: PathLike,
    fmt: str = DEFAULT_FORMAT,
) -> None:
    """Add one row to the audit table, creating it first if need be. Anything else at the path,
    a table with other columns included, is refused before a byte is written.

    The table's layout stands in a small file, made by the append that first sees the table, so an
    append opens that file and no other, however many rows there are. Only names are looked at
    then: a file no writer of Spark's would name so is refused. A table that has no layout file
    yet is judged by all its files, once.
    """
    row = spark.createDataFrame([asdict(record)], AUDIT_SCHEMA).coalesce(1)
    state = storage.path_state(spark, audit_target, fmt)
    if state is PathState.FOREIGN:
        raise ValueError(f"Audit path exists but is not a {fmt} table: {audit_target}")
    if state is PathState.TABLE:
        append_rows(in_target_layout(row, _layout(spark, audit_target, fmt)), audit_target, fmt)
    else:
        create_table(row, audit_target, fmt, repeated=state is PathState.UNFINISHED)
        _keep_layout(spark, row.schema, audit_target, fmt)


def _keep_layout(spark: SparkSession, schema: StructType, audit_target: PathLike, fmt: str) -> None:
    if fmt != "delta":
        storage.create_exclusively(spark, storage.child(audit_target, LAYOUT_FILE), schema.json())


def _layout(spark: SparkSession, audit_target: PathLike, fmt: str) -> DataFrame:
    """An empty frame in the table's layout."""
    if fmt == "delta":
        return spark.read.format(fmt).load(str(audit_target)).limit(0)
    kept = storage.child(audit_target, LAYOUT_FILE)
    if storage.exists(spark, kept):
        foreign = [
            name
            for name, _ in storage.entries(spark, audit_target)
            if not name.startswith(("_", ".")) and not WRITTEN_FILE.fullmatch(name)
        ]
        if foreign:
            raise ValueError(f"Audit path exists but cannot be read: {audit_target}: {foreign[:3]}")
        return spark.createDataFrame([], StructType.fromJson(json.loads(storage.read_text(spark, kept))))
    schema = _stored(spark, audit_target, fmt).schema
    in_target_layout(spark.createDataFrame([], AUDIT_SCHEMA), spark.createDataFrame([], schema))
    _keep_layout(spark, schema, audit_target, fmt)
    return spark.createDataFrame([], schema)


def _stored(spark: SparkSession, audit_target: PathLike, fmt: str) -> DataFrame:
    """A scan of the audit table that looks into every file of it, one row each."""
    try:
        return spark.read.format(fmt).option("mergeSchema", True).load(str(audit_target))
    except Exception as error:
        raise ValueError(f"Audit path exists but cannot be read: {audit_target}") from error
