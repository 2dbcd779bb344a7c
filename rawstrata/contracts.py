"""Declared schemas: source entities, metadata columns, audit rows and log rows."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT_RECORD = "_corrupt_record"
RECORD_HASH = "_record_hash"
SOURCE_SYSTEM = "_source_system"
SOURCE_RECORD_ID = "source_record_id"

# The columns of each source entity, in file order, and the order in
# which a full run lands the entities.
ENTITY_COLUMNS = {
    "address": """
        source_record_id address_id customer_id address_type address_line_1
        address_line_2 city state_region postal_code country_code is_primary
        created_at updated_at
    """,
    "category": """
        source_record_id category_id parent_category_id category_name category_code
        is_active created_at updated_at
    """,
    "customer": """
        source_record_id customer_id first_name last_name email phone date_of_birth
        loyalty_status marketing_opt_in created_at updated_at
    """,
    "order": """
        source_record_id order_id customer_id billing_address_id shipping_address_id
        order_timestamp channel order_status currency_code subtotal_amount
        discount_amount tax_amount shipping_amount order_total_amount created_at
        updated_at
    """,
    "order_item": """
        source_record_id order_item_id order_id product_id quantity unit_price
        discount_amount tax_amount line_total_amount created_at updated_at
    """,
    "payment": """
        source_record_id payment_id order_id customer_id payment_timestamp
        payment_method payment_status amount currency_code transaction_reference
        created_at updated_at
    """,
    "product": """
        source_record_id product_id sku product_name brand unit_price currency_code
        is_active created_at updated_at
    """,
    "product_category": """
        source_record_id product_category_id product_id category_id is_primary
        active_from active_to created_at updated_at
    """,
    "return": """
        source_record_id return_id order_id customer_id return_timestamp
        return_status return_reason total_refund_amount created_at updated_at
    """,
    "return_item": """
        source_record_id return_item_id return_id order_item_id product_id quantity
        refund_amount return_reason created_at updated_at
    """,
}

# The columns enrichment adds, in order.
METADATA_COLUMNS = (
    RECORD_HASH,
    "_source_batch_id",
    "_pipeline_run_id",
    SOURCE_SYSTEM,
    "_ingested_timestamp",
)

# The audit row.
AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("source_batch_id", T.StringType(), False),
        T.StructField("pipeline_run_id", T.StringType(), False),
        T.StructField("source_system", T.StringType(), False),
        T.StructField("entity", T.StringType(), False),
        T.StructField("source_file_name", T.StringType(), False),
        T.StructField("source_file_path", T.StringType(), False),
        T.StructField("target_table", T.StringType(), False),
        T.StructField("source_row_count", T.LongType()),
        T.StructField("corrupt_record_count", T.LongType()),
        T.StructField("null_business_key_count", T.LongType()),
        T.StructField("duplicate_business_key_count", T.LongType()),
        T.StructField("duplicate_rows_beyond_first", T.LongType()),
        T.StructField("replay_existing_row_count", T.LongType()),
        T.StructField("inserted_row_count", T.LongType()),
        T.StructField("hash_conflict_count", T.LongType()),
        T.StructField("target_total_row_count", T.LongType()),
        T.StructField("status", T.StringType(), False),
        T.StructField("error_message", T.StringType()),
        T.StructField("started_at", T.TimestampType(), False),
        T.StructField("completed_at", T.TimestampType(), False),
    ]
)


def _logged(name: str, kind: T.DataType, nullable: bool, comment: str) -> T.StructField:
    return T.StructField(name, kind, nullable, {"comment": comment})


# The log row, with the comment each column carries in the catalog.
LOG_SCHEMA = T.StructType(
    [
        _logged("log_id", T.StringType(), False, "UUID per log entry"),
        _logged("batch_id", T.StringType(), False, "Unique identifier for this pipeline execution batch"),
        _logged("entity_name", T.StringType(), True, "Which entity (customer, order, etc.), null for pipeline-level events"),
        _logged("log_level", T.StringType(), False, "Severity level of the log entry"),
        _logged("log_category", T.StringType(), False, "Functional area that produced the log entry"),
        _logged("message", T.StringType(), False, "Human-readable log message"),
        _logged("details", T.StringType(), True, "JSON blob for structured metadata (row counts, file paths, durations, etc.)"),
        _logged("logged_at", T.TimestampType(), False, "UTC timestamp of when the event was logged"),
    ]
)


def text_schema(columns: str) -> T.StructType:
    """Nullable string fields for whitespace-separated column names."""
    return T.StructType([T.StructField(name, T.StringType()) for name in columns.split()])


SCHEMAS: dict[str, T.StructType] = {
    entity: text_schema(columns) for entity, columns in ENTITY_COLUMNS.items()
}
ENTITIES = tuple(SCHEMAS)


def resolve_entity_schema(entity: str) -> T.StructType:
    """Read schema of an entity: its contract plus one column for malformed lines."""
    contract = SCHEMAS[entity]
    if CORRUPT_RECORD in contract.names:
        return contract
    return T.StructType([*contract.fields, T.StructField(CORRUPT_RECORD, T.StringType())])


def required_columns(entity: str) -> list[str]:
    """Columns an enriched frame of the entity must have, in reporting order."""
    if entity not in SCHEMAS:
        raise ValueError(f"Unknown entity: {entity}")
    return [*METADATA_COLUMNS, CORRUPT_RECORD, *SCHEMAS[entity].names]
