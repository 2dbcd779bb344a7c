"""Accepted and quarantined rows together are the batch, each row once."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from rawstrata.operators import quarantine, tables
from rawstrata.operators.quality import duplicated_ids
from rawstrata.plans.ingestion import AUDIT_TABLE, BronzeIngestionConfig, ingest_batch
from rawstrata.contracts import SCHEMAS

SCHEMA = (
    "source_record_id string, _source_system string, _corrupt_record string, _record_hash string, "
    "part string"
)
ROWS = [
    ("a", "erp", None, "h1", "x"),
    ("b", "erp", None, "h1", "x"),
    ("b", "erp", None, None, "x"),
    ("b", "erp", None, None, "x"),
    ("", "erp", "bad", "h2", None),
    (None, "erp", None, "h3", "x"),
    ("c", "erp", "bad", "h4", "x"),
    ("d", None, None, "h5", "x"),
]


@pytest.fixture
def batch(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def judged(df, **options):
    rows = quarantine.row_verdicts(df, duplicated_ids(df), **options)
    return Counter((tuple(r[:-1]), tuple(r[-1])) for r in rows.collect())


@pytest.mark.parametrize("broadcast_ids", [True, False])
def test_every_row_lists_its_defects(batch, broadcast_ids):
    want = {
        ROWS[0]: (), ROWS[1]: ("duplicated id",), ROWS[2]: ("duplicated id", "no hash"),
        ROWS[4]: ("blank id",), ROWS[5]: ("blank id",), ROWS[6]: (), ROWS[7]: (),
    }
    assert judged(batch, broadcast_ids=broadcast_ids) == Counter((row, want[row]) for row in ROWS)
    strict = judged(batch, broadcast_ids=broadcast_ids, malformed=True)
    assert strict[ROWS[4], ("blank id", "malformed line")] == 1
    assert strict[ROWS[6], ("malformed line",)] == 1


def test_missing_columns_give_no_reason(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",)], "source_record_id string")
    assert judged(df, malformed=True) == {(("a",), ()): 1, (("b",), ("duplicated id",)): 2}
    assert judged(df.limit(0)) == {}


def test_a_hot_duplicated_id_meets_in_many_parts(spark):
    hot = spark.range(6000).selectExpr(
        "IF(id % 3 = 0, 'hot', CAST(id AS string)) AS source_record_id", "id AS n"
    )
    judged_rows = quarantine.row_verdicts(hot, duplicated_ids(hot))
    assert quarantine.quarantined(judged_rows).count() == 2000
    plan = judged_rows._jdf.queryExecution().optimizedPlan().toString()
    assert "salt" in plan


def test_two_sinks_hold_the_batch(spark, batch, tmp_path):
    target, aside = str(tmp_path / "orders"), str(tmp_path / "quarantine" / "orders")
    for _ in range(2):  # a repeated run replaces what it set aside
        found = quarantine.write_with_quarantine(spark, batch, target, aside, "B/1")
        assert (found.accepted_row_count, found.quarantined_row_count) == (3, 5)
    assert (found.written.inserted_row_count, found.written.replay_existing_row_count) == (0, 3)
    landed = tables.read_table(spark, target)
    kept = tables.read_table(spark, f"{aside}/B%2F1")
    assert landed.columns == batch.columns
    both = [tuple(r) for r in landed.collect()] + [tuple(r)[:-1] for r in kept.collect()]
    assert Counter(both) == Counter(ROWS)


def test_a_conflicting_batch_lands_nothing(spark, batch, tmp_path):
    target, aside = str(tmp_path / "orders"), str(tmp_path / "quarantine")
    quarantine.write_with_quarantine(spark, batch, target, aside, "B1")
    changed = batch.withColumn("_record_hash", F.lit("other"))
    found = quarantine.write_with_quarantine(spark, changed, target, aside, "B2")
    assert (found.written.hash_conflict_count, found.written.inserted_row_count) == (3, 0)


def test_an_entity_with_defects_lands_the_rest(spark, tmp_path):
    names = SCHEMAS["category"].names
    lines = [",".join(names)] + [f"{i},{','.join('v' * (len(names) - 1))}" for i in ("1", "2", "2", "", "3")]
    source = tmp_path / "in" / "B1" / "category_B1.csv"
    source.parent.mkdir(parents=True)
    source.write_text("\n".join(lines) + "\n")
    config = BronzeIngestionConfig(tmp_path / "in", tmp_path / "out", "B1", "erp")
    with pytest.raises(ValueError, match="null or blank"):
        ingest_batch(spark, config, ["category"])
    lenient = BronzeIngestionConfig(tmp_path / "in", tmp_path / "out", "B1", "erp", quarantine=True)
    (audit,) = ingest_batch(spark, lenient, ["category"])
    assert audit.status == "SUCCESS_WITH_WARNINGS"
    assert (audit.source_row_count, audit.inserted_row_count, audit.null_business_key_count) == (5, 2, 1)
    aside = tables.read_table(spark, lenient.quarantine_path("category") + "/B1")
    assert sorted(tuple(r[quarantine.REASONS]) for r in aside.collect()) == [
        ("blank id",), ("duplicated id",), ("duplicated id",)
    ]
    assert tables.read_table(spark, tmp_path / "out" / AUDIT_TABLE).count() == 2
