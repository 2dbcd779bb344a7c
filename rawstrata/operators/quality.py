"""Data-quality counts, the report made from them, and the policy that acts on it."""

from __future__ import annotations

import warnings
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, functions as F

from rawstrata.contracts import CORRUPT_RECORD, RECORD_HASH, SOURCE_RECORD_ID, required_columns
from rawstrata.functions.predicates import is_blank


@dataclass(frozen=True)
class ValidationMetrics:
    """Counts over one frame. ``None``: the column the count needs is absent."""

    row_count: int
    null_or_blank_source_record_id_count: int | None
    distinct_duplicated_source_record_id_count: int | None
    corrupt_record_count: int | None
    null_record_hash_count: int | None
    duplicate_rows_beyond_first_count: int | None = 0


METRIC_NAMES = tuple(field.name for field in fields(ValidationMetrics))


@dataclass(frozen=True)
class ValidationReport:
    """Metrics of an entity and the errors that block it."""

    entity: str
    metrics: ValidationMetrics
    errors: tuple[str, ...]

    @property
    def is_valid(self) -> bool:
        return len(self.errors) == 0


def blank_id_rows(df: DataFrame) -> DataFrame:
    """Rows whose id is NULL or empty."""
    return df.filter(is_blank(F.col(SOURCE_RECORD_ID)))


def corrupt_rows(df: DataFrame) -> DataFrame:
    """Rows read from malformed lines."""
    return df.filter(F.col(CORRUPT_RECORD).isNotNull())


def unhashed_rows(df: DataFrame) -> DataFrame:
    """Rows without a payload hash."""
    return df.filter(F.col(RECORD_HASH).isNull())


def duplicated_ids(df: DataFrame) -> DataFrame:
    """Non-blank ids that occur more than once, with their row count."""
    return (
        df.filter(~is_blank(F.col(SOURCE_RECORD_ID)))
        .groupBy(SOURCE_RECORD_ID)
        .agg(F.count("*").alias("row_count"))
        .filter("row_count > 1")
    )


def validation_metrics(df: DataFrame) -> DataFrame:
    """All quality counts as a one-row frame, from one scan and one shuffle of the ids.

    Rows are counted per id first, with blanks folded into one NULL group, and the groups
    are then summed. Both steps combine before they shuffle, so an id (or the blank) that
    holds a large part of all rows arrives as one partial count per task.
    """
    has_ids, has_corrupt, has_hash = (
        name in df.columns for name in (SOURCE_RECORD_ID, CORRUPT_RECORD, RECORD_HASH)
    )
    no_count = F.lit(None).cast("bigint")
    raw_id = F.col(SOURCE_RECORD_ID).cast("string") if has_ids else F.lit(None).cast("string")
    narrow = df.select(
        F.nullif(raw_id, F.lit("")).alias("id"),
        (F.col(CORRUPT_RECORD).isNotNull() if has_corrupt else F.lit(False)).alias("corrupt"),
        (F.col(RECORD_HASH).isNull() if has_hash else F.lit(False)).alias("unhashed"),
    )
    per_id = narrow.groupBy("id").agg(
        F.count("*").alias("n"),
        F.count_if("corrupt").alias("corrupt"),
        F.count_if("unhashed").alias("unhashed"),
    )

    def total(value: Column, available: bool) -> Column:
        return F.coalesce(F.sum(value), F.lit(0)).cast("bigint") if available else no_count

    repeated = F.col("id").isNotNull() & (F.col("n") > 1)
    counts = (
        total(F.col("n"), True),
        total(F.when(F.col("id").isNull(), F.col("n")), has_ids),
        total(F.when(repeated, 1), has_ids),
        total(F.col("corrupt"), has_corrupt),
        total(F.col("unhashed"), has_hash),
        total(F.when(repeated, F.col("n") - 1), has_ids),
    )
    return per_id.agg(*[count.alias(name) for count, name in zip(counts, METRIC_NAMES)])


def check_required_columns(df: DataFrame, entity: str) -> tuple[str, ...]:
    """Required columns the frame lacks. Extra columns are fine; case matters."""
    present = set(df.columns)
    return tuple(name for name in required_columns(entity) if name not in present)


def with_errors(metrics: DataFrame, missing: tuple[str, ...] = ()) -> DataFrame:
    """Add the ordered list of blocking errors to a metrics frame.

    Malformed lines are counted but do not block.
    """
    # The error texts.
    texts = {
        "null_or_blank_source_record_id_count": (
            "Found %d rows with null or blank source_record_id values"
        ),
        "distinct_duplicated_source_record_id_count": (
            "Found %d distinct duplicated source_record_id values"
        ),
        "null_record_hash_count": "Found %d rows with null _record_hash",
    }
    found = [
        F.when(F.col(name) > 0, F.format_string(text, F.col(name)))
        for name, text in texts.items()
    ]
    absent = [F.lit(f"Missing required column: {name}") for name in missing]
    return metrics.withColumn("errors", F.array_compact(F.array(*found, *absent)))


def error_rows(report: DataFrame) -> DataFrame:
    """One row per blocking error, numbered from 1."""
    return report.select(F.posexplode("errors").alias("position", "error")).select(
        (F.col("position") + 1).alias("position"), "error"
    )


def collect_validation_metrics(df: DataFrame) -> ValidationMetrics:
    """Run the aggregation and return its one row."""
    return ValidationMetrics(**validation_metrics(df).first().asDict())


def validate_bronze_data(df: DataFrame, entity: str) -> ValidationReport:
    """Check shape and content of an enriched frame in one job. Applies no policy."""
    missing = check_required_columns(df, entity)
    row = with_errors(validation_metrics(df), missing).first().asDict()
    errors = tuple(row.pop("errors"))
    return ValidationReport(entity=entity, metrics=ValidationMetrics(**row), errors=errors)


def apply_validation_policy(report: ValidationReport) -> None:
    """Warn about malformed lines, then refuse the entity if any error blocks it."""
    corrupt = report.metrics.corrupt_record_count
    if corrupt:
        message = f"Bronze validation found {corrupt} corrupt records for entity '{report.entity}'"
        warnings.warn(message, UserWarning, stacklevel=2)
    if not report.is_valid:
        lines = [f"Bronze validation failed for entity '{report.entity}':"]
        raise ValueError("\n- ".join(lines + list(report.errors)))
