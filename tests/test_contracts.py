import pytest
from pyspark.sql.types import StringType, StructField, StructType

from rawstrata import contracts
from rawstrata.contracts import AUDIT_SCHEMA, ENTITIES, LOG_SCHEMA, SCHEMAS, resolve_entity_schema

COLUMN_COUNTS = {
    "address": 13,
    "category": 8,
    "customer": 11,
    "order": 16,
    "order_item": 11,
    "payment": 12,
    "product": 10,
    "product_category": 9,
    "return": 10,
    "return_item": 10,
}


def test_every_entity_has_its_columns():
    assert {entity: len(schema) for entity, schema in SCHEMAS.items()} == COLUMN_COUNTS
    assert ENTITIES == tuple(COLUMN_COUNTS)


@pytest.mark.parametrize("entity", ENTITIES)
def test_contract_is_nullable_text_between_shared_columns(entity):
    schema = SCHEMAS[entity]
    assert schema.names[0] == "source_record_id"
    assert schema.names[-2:] == ["created_at", "updated_at"]
    assert len(set(schema.names)) == len(schema.names)
    assert all(field.nullable and field.dataType == StringType() for field in schema)


@pytest.mark.parametrize("entity", ENTITIES)
def test_read_schema_ends_with_the_corrupt_record(entity):
    before = list(SCHEMAS[entity].fields)
    wanted = StructType([*before, StructField("_corrupt_record", StringType(), True)])
    assert resolve_entity_schema(entity) == wanted
    assert SCHEMAS[entity].fields == before


def test_read_schema_does_not_repeat_the_corrupt_record(monkeypatch):
    schema = resolve_entity_schema("customer")
    monkeypatch.setitem(contracts.SCHEMAS, "with_corrupt", schema)
    assert resolve_entity_schema("with_corrupt") == schema


def test_unknown_entity_has_no_read_schema():
    with pytest.raises(KeyError):
        resolve_entity_schema("nothing")


def test_audit_row_types():
    required = {"status", "started_at", "completed_at", *AUDIT_SCHEMA.names[:7]}
    assert len(AUDIT_SCHEMA) == 20
    assert {field.name for field in AUDIT_SCHEMA if not field.nullable} == required
    counts = AUDIT_SCHEMA.names[7:16]
    assert {AUDIT_SCHEMA[name].dataType.simpleString() for name in counts} == {"bigint"}


def test_log_row_types():
    assert [field.name for field in LOG_SCHEMA if field.nullable] == ["entity_name", "details"]
    assert all(field.metadata["comment"] for field in LOG_SCHEMA)
