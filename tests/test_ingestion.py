import uuid
import warnings

import pytest
from pyspark.errors import AnalysisException

from rawstrata.contracts import AUDIT_SCHEMA, ENTITIES, SCHEMAS
from rawstrata.operators.tables import read_table
from rawstrata.plans.ingestion import (
    BronzeIngestionConfig,
    ingest_batch,
    ingest_entity,
    ingest_named_entity,
)
from rawstrata.sources.storage import child

ADA = "source-1,customer-1,Ada,Lovelace,ada@example.com,555-0101,1815-12-10,gold,true,t1,t2"
ALAN = "source-2,customer-2,Alan,Turing,alan@example.com,555-0102,1912-06-23,silver,true,t1,t2"


@pytest.fixture
def config(tmp_path):
    def build(batch_id):
        return BronzeIngestionConfig(tmp_path / "source", tmp_path / "bronze", batch_id, "crm")

    return build


@pytest.fixture
def extract(tmp_path):
    def write(batch_id, *lines, entity="customer", encoding="utf-8", newline="\n"):
        path = tmp_path / "source" / batch_id / f"{entity}_{batch_id}.csv"
        path.parent.mkdir(parents=True, exist_ok=True)
        text = newline.join([",".join(SCHEMAS[entity].names), *lines, ""])
        path.write_bytes(text.encode(encoding))
        return path

    return write


def audit_rows(spark, config):
    rows = read_table(spark, child(config.bronze_root, "ingestion_audit"))
    return rows.orderBy("started_at").collect()


def test_success_is_returned_and_persisted(spark, config, extract):
    path = extract("B1", ADA)
    audit = ingest_entity(spark, config("B1"), "customer", "run-1")
    assert (audit.source_batch_id, audit.pipeline_run_id, audit.source_system) == ("B1", "run-1", "crm")
    assert (audit.source_file_name, audit.source_file_path) == (path.name, str(path))
    assert (audit.source_row_count, audit.corrupt_record_count) == (1, 0)
    assert (audit.null_business_key_count, audit.duplicate_business_key_count) == (0, 0)
    assert audit.duplicate_rows_beyond_first == 0
    assert (audit.replay_existing_row_count, audit.inserted_row_count) == (0, 1)
    assert (audit.hash_conflict_count, audit.target_total_row_count) == (0, 1)
    assert (audit.status, audit.error_message) == ("SUCCESS", None)
    assert audit.started_at <= audit.completed_at
    table = read_table(spark, child(config("B1").bronze_root, "ingestion_audit"))
    assert table.dtypes == [(f.name, f.dataType.simpleString()) for f in AUDIT_SCHEMA]
    (row,) = table.collect()
    assert (row.entity, row.inserted_row_count, row.status) == ("customer", 1, "SUCCESS")
    landed = read_table(spark, config("B1").target_path("customer")).first()
    assert (landed.first_name, landed._source_batch_id, landed._source_system) == ("Ada", "B1", "crm")
    assert landed._corrupt_record is None and len(landed._record_hash) == 64


def test_duplicates_fail_with_their_counts_and_create_no_target(spark, config, extract, tmp_path):
    extract("B1", ADA, ALAN.replace("source-2", "source-1"))
    with pytest.raises(ValueError, match="duplicated source_record_id"):
        ingest_entity(spark, config("B1"), "customer", "run-1")
    (row,) = audit_rows(spark, config("B1"))
    assert (row.status, row.source_row_count) == ("FAILED", 2)
    assert (row.duplicate_business_key_count, row.duplicate_rows_beyond_first) == (1, 1)
    assert row.inserted_row_count is None and row.target_total_row_count is None
    assert row.error_message.startswith("ValueError: Bronze validation failed")
    assert not (tmp_path / "bronze" / "customer").exists()


def test_replay_and_growth(spark, config, extract):
    extract("B1", ADA)
    extract("B2", ADA, ALAN)
    ingest_entity(spark, config("B1"), "customer", "run-1")
    replay = ingest_entity(spark, config("B1"), "customer", "run-2")
    grown = ingest_entity(spark, config("B2"), "customer", "run-3")

    def counts(audit):
        return (
            audit.replay_existing_row_count,
            audit.inserted_row_count,
            audit.hash_conflict_count,
            audit.target_total_row_count,
        )

    assert counts(replay) == (1, 0, 0, 1)
    assert counts(grown) == (1, 1, 0, 2)
    rows = read_table(spark, config("B1").target_path("customer")).collect()
    assert sorted((row.first_name, row._source_batch_id) for row in rows) == [
        ("Ada", "B1"),
        ("Alan", "B2"),
    ]


def test_conflict_fails_and_leaves_the_target_alone(spark, config, extract):
    extract("B1", ADA)
    extract("B2", ADA.replace("Ada,Lovelace", "Augusta,King"), ALAN)
    ingest_entity(spark, config("B1"), "customer", "run-1")
    with pytest.raises(ValueError, match="Found 1 hash conflicts for entity 'customer'"):
        ingest_entity(spark, config("B2"), "customer", "run-2")
    row = audit_rows(spark, config("B2"))[-1]
    assert (row.status, row.hash_conflict_count) == ("FAILED", 1)
    assert (row.inserted_row_count, row.target_total_row_count) == (0, 1)
    (kept,) = read_table(spark, config("B1").target_path("customer")).collect()
    assert kept.first_name == "Ada"


def test_malformed_lines_land_with_a_warning(spark, config, extract):
    broken = "source-3,customer-3,only"
    extract("B1", ADA, broken)
    with pytest.warns(UserWarning, match="1 corrupt records for entity 'customer'"):
        audit = ingest_entity(spark, config("B1"), "customer", "run-1")
    assert (audit.status, audit.corrupt_record_count) == ("SUCCESS_WITH_WARNINGS", 1)
    assert audit.inserted_row_count == 2
    landed = read_table(spark, config("B1").target_path("customer")).collect()
    assert {row.source_record_id: row._corrupt_record for row in landed} == {
        "source-1": None,
        "source-3": broken,
    }


def test_blank_ids_fail(spark, config, extract):
    extract("B1", ADA, ADA.replace("source-1", "", 1))
    with pytest.raises(ValueError, match="Found 1 rows with null or blank source_record_id"):
        ingest_entity(spark, config("B1"), "customer", "run-1")


def test_missing_extract_and_unknown_entity_are_audited_without_counts(spark, config):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        ingest_entity(spark, config("B9"), "customer", "run-1")
    with pytest.raises(KeyError):
        ingest_entity(spark, config("B9"), "nothing", "run-1")
    rows = audit_rows(spark, config("B9"))
    assert [row.error_message.split(":")[0] for row in rows] == ["AnalysisException", "KeyError"]
    assert {(row.status, row.source_row_count, row.inserted_row_count) for row in rows} == {
        ("FAILED", None, None)
    }


def test_foreign_target_fails(spark, config, extract, tmp_path):
    extract("B1", ADA)
    keep = tmp_path / "bronze" / "customer" / "keep.txt"
    keep.parent.mkdir(parents=True)
    keep.write_text("mine")
    with pytest.raises(ValueError, match="not a parquet table"):
        ingest_entity(spark, config("B1"), "customer", "run-1")
    assert keep.read_text() == "mine"


def test_foreign_audit_path_fails_a_good_run(spark, config, extract, tmp_path):
    extract("B1", ADA)
    (tmp_path / "bronze" / "ingestion_audit").mkdir(parents=True)
    with pytest.raises(ValueError, match="Audit path exists but is not a parquet table"):
        ingest_entity(spark, config("B1"), "customer", "run-1")


def test_first_error_stays_when_the_audit_fails_too(spark, config, tmp_path):
    (tmp_path / "bronze" / "ingestion_audit").mkdir(parents=True)
    with pytest.raises(KeyError) as caught:
        ingest_entity(spark, config("B1"), "nothing", "run-1")
    assert any("audit row could not be written" in note for note in caught.value.__notes__)


def test_batch_shares_a_run_id(spark, config, extract):
    extract("B1", ADA)
    columns = SCHEMAS["category"].names
    extract("B1", ",".join("v" for _ in columns), entity="category")
    audits = ingest_batch(spark, config("B1"), ["category", "customer"])
    assert [audit.entity for audit in audits] == ["category", "customer"]
    assert len({audit.pipeline_run_id for audit in audits}) == 1
    assert [row.status for row in audit_rows(spark, config("B1"))] == ["SUCCESS", "SUCCESS"]


def test_batch_stops_at_the_first_failure(spark, config, extract, tmp_path):
    extract("B1", ADA)
    with pytest.raises(AnalysisException):
        ingest_batch(spark, config("B1"), ENTITIES)
    assert [(row.entity, row.status) for row in audit_rows(spark, config("B1"))] == [
        ("address", "FAILED")
    ]
    assert not (tmp_path / "bronze" / "customer").exists()


def test_odd_business_values_pass_through(spark, config, extract):
    """Byte order mark, CRLF, literal NULL, empty parents, prices that are no prices."""
    extract(
        "B1",
        "r1,CAT1,NULL,Tools,T,1,2025-01-01 10:00:00.1234567,2025-01-01",
        "r2,CAT2,,Parts,P,0,2025-01-01,2025-01-01",
        "r3,CAT3,CAT3,Loop,L,1,2025-01-01,2025-01-01",
        entity="category",
        encoding="utf-8-sig",
        newline="\r\n",
    )
    extract(
        "B1",
        "p1,P1,SKU,Saw,Brand,-19.99,EUR,1,t,t",
        "p2,P2,SKU,Axe,Brand,NOT_AVAILABLE,EUR,1,t,t",
        entity="product",
    )
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        audits = ingest_batch(spark, config("B1"), ["category", "product"])
    assert [audit.inserted_row_count for audit in audits] == [3, 2]
    categories = read_table(spark, config("B1").target_path("category")).collect()
    assert sorted((row.source_record_id, row.parent_category_id) for row in categories) == [
        ("r1", "NULL"),
        ("r2", None),
        ("r3", "CAT3"),
    ]
    prices = read_table(spark, config("B1").target_path("product")).collect()
    assert sorted(row.unit_price for row in prices) == ["-19.99", "NOT_AVAILABLE"]


def test_older_flow_lands_in_catalog_tables(spark, config, extract):
    database = f"db_{uuid.uuid4().hex}"
    extract("B1", ADA, ADA)
    extract("B2", ADA, ALAN)
    extract("B3", ADA.replace("Ada", "Augusta"))
    try:
        ingest_named_entity(spark, config("B1"), "customer", "run-1", database)
        landed = ingest_named_entity(spark, config("B2"), "customer", "run-2", database)
        rows = sorted((row.first_name, row._batch_id, row._run_id) for row in landed.collect())
        # Nothing validates here, so the repeated row of the first batch is kept.
        assert rows == [("Ada", "B1", "run-1")] * 2 + [("Alan", "B2", "run-2")]
        with pytest.raises(ValueError, match="source_record_id=source-1"):
            ingest_named_entity(spark, config("B3"), "customer", "run-3", database)
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")
