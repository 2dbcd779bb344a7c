"""Read an entity's delimited extract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from rawstrata.contracts import CORRUPT_RECORD, resolve_entity_schema
from rawstrata.sources.storage import PathLike, child, data_files, exists, literal

# How extracts are written. Everything else is the CSV reader's default.
CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT_RECORD,
}


def resolve_source_path(data_root: PathLike, source_batch_id: str, entity: str) -> str:
    """Where a batch keeps an entity's extract: a file, or a folder of part files."""
    return child(data_root, source_batch_id, f"{entity}_{source_batch_id}.csv")


def multi_line_scan(spark: SparkSession, schema: StructType, paths: list[str]) -> DataFrame:
    """The CSV reader with line breaks allowed in quoted fields: one task per file."""
    return spark.read.schema(schema).options(**CSV_OPTIONS, multiLine=True).csv(paths)


def line_scan(spark: SparkSession, schema: StructType, paths: list[str]) -> DataFrame:
    """The CSV reader with one record a line: files are read in splits."""
    return spark.read.schema(schema).options(**CSV_OPTIONS).csv(paths)


def read_source_csv(
    spark: SparkSession,
    schema: StructType,
    path: PathLike,
    *,
    records_span_lines: bool = True,
) -> DataFrame:
    """Scan an extract under a declared schema. Columns bind by position; a malformed line is
    kept whole in the corrupt-record column.

    Quoted fields may hold line breaks, and a file is then one task, so a large extract should
    come as a folder of part files. An extract declared to have no such fields is read in splits
    whatever its files' sizes. The extract is a file, a folder or a pattern. Its files are listed
    once and named one by one, so names are never patterns and folder names never become columns.
    """
    scan = multi_line_scan if records_span_lines else line_scan
    files = data_files(spark, path)
    if not files:
        if exists(spark, path):
            return spark.createDataFrame([], schema)
        return scan(spark, schema, [literal(path)])  # fails, naming the path
    return scan(spark, schema, sorted(literal(name) for name, _ in files))


def load_entity_data(
    spark: SparkSession,
    data_root: PathLike,
    source_batch_id: str,
    entity: str,
    *,
    records_span_lines: bool = True,
) -> DataFrame:
    """Scan one entity of one batch."""
    return read_source_csv(
        spark,
        resolve_entity_schema(entity),
        resolve_source_path(data_root, source_batch_id, entity),
        records_span_lines=records_span_lines,
    )
