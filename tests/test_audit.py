"""What the audit table refuses, and that nothing is written then."""

import pytest

from rawstrata.operators.audit import IngestionAuditRecord, append_audit_record
from rawstrata.operators.tables import read_table


@pytest.fixture
def record():
    return IngestionAuditRecord.start(
        source_batch_id="B1",
        pipeline_run_id="run",
        source_system="crm",
        entity="customer",
        source_file_path="in/customer.csv",
        target_table="customer",
    )


@pytest.fixture
def target(tmp_path):
    return tmp_path / "audit"


def test_rows_are_added(spark, record, target):
    for _ in range(3):
        append_audit_record(spark, record, target)
    rows = read_table(spark, target).collect()
    assert [r.status for r in rows] == ["IN_PROGRESS"] * 3


def test_a_crashed_first_write_can_be_repeated(spark, record, target):
    (target / "_temporary").mkdir(parents=True)
    append_audit_record(spark, record, target)
    assert read_table(spark, target).count() == 1


@pytest.mark.parametrize("good_rows_too", [False, True])
def test_a_file_that_is_no_table_is_refused(spark, record, target, good_rows_too):
    if good_rows_too:
        append_audit_record(spark, record, target)
    target.mkdir(exist_ok=True)
    (target / "x.parquet").write_text("mine")
    before = sorted(target.rglob("*"))
    with pytest.raises(ValueError, match="cannot be read"):
        append_audit_record(spark, record, target)
    assert sorted(target.rglob("*")) == before


def test_a_table_with_other_columns_is_refused(spark, record, target):
    spark.range(3).write.parquet(str(target))
    before = sorted(target.rglob("*"))
    with pytest.raises(ValueError, match="Columns differ"):
        append_audit_record(spark, record, target)
    assert sorted(target.rglob("*")) == before


def test_appends_open_no_file_of_the_table(spark, record, target):
    """Files that cannot be opened show it: they pass when only their names are looked at."""
    append_audit_record(spark, record, target)
    (written,) = target.glob("part-*.parquet")
    content = written.read_bytes()
    written.write_bytes(b"")
    for crc in target.glob(".*.crc"):
        crc.unlink()
    append_audit_record(spark, record, target)
    written.write_bytes(content)
    assert read_table(spark, target, schema=None).count() == 2


def test_a_table_without_layout_file_gets_one(spark, record, target):
    append_audit_record(spark, record, target)
    (target / "_layout.json").unlink()
    append_audit_record(spark, record, target)
    assert (target / "_layout.json").exists()
    assert read_table(spark, target).count() == 2
