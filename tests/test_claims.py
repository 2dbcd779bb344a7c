"""One writer per target, also when runs interleave or die."""

import pytest

from rawstrata.operators import matching, tables
from rawstrata.sources import claims, storage
from rawstrata.sources.claims import TargetClaimedError, claim, claimed, claims_folder


@pytest.fixture
def target(tmp_path):
    return str(tmp_path / "bronze" / "orders")


def rows(spark, *ids):
    return spark.createDataFrame([("erp", i) for i in ids], "_source_system string, source_record_id string")


def test_a_claim_is_beside_the_target_and_goes_with_its_run(spark, target):
    assert claims_folder("s3a://bronze/orders/") == "s3a://bronze/_claims-orders"
    assert claims_folder("orders") == "_claims-orders"
    with claimed(spark, target, "run-1"):
        with pytest.raises(TargetClaimedError, match="run-1"):
            claim(spark, target)
    assert not storage.exists(spark, claims_folder(target))
    claim(spark, target).release()


def test_two_interleaved_runs_cannot_both_append(spark, target, monkeypatch):
    tables.write_bronze_data(spark, rows(spark, "a"), target)
    refused = []

    def second_run(*args, **kwargs):
        """The other run starts while this one has matched its rows and not yet appended."""
        with pytest.raises(TargetClaimedError) as error:
            tables.write_bronze_data(spark, rows(spark, "b"), target)
        refused.append(error)
        return new_rows(*args, **kwargs)

    new_rows = matching.new_rows
    monkeypatch.setattr(matching, "new_rows", second_run)
    counts = tables.write_bronze_data(spark, rows(spark, "a", "b"), target)
    assert len(refused) == 1
    assert (counts.inserted_row_count, counts.target_total_row_count) == (1, 2)
    monkeypatch.undo()
    again = tables.write_bronze_data(spark, rows(spark, "b"), target)
    assert (again.inserted_row_count, again.target_total_row_count) == (0, 2)


def test_a_claim_is_released_when_a_write_fails(spark, target):
    with pytest.raises(ValueError, match="missing"):
        tables.write_bronze_data(spark, rows(spark, "a").drop("source_record_id"), target)
    assert not storage.exists(spark, claims_folder(target))


def test_a_stale_claim_is_taken_over_and_its_owner_stopped(spark, target, monkeypatch):
    tables.write_bronze_data(spark, rows(spark, "a"), target)

    def taken_over(*args, **kwargs):
        """This run is thought dead; another one takes over, adds b and ends."""
        with claimed(spark, target, "run-2", stale_after=-1) as other:
            tables.append_rows(rows(spark, "b"), target)
            other.renew()
        return new_rows(*args, **kwargs)

    new_rows = matching.new_rows
    monkeypatch.setattr(matching, "new_rows", taken_over)
    with pytest.raises(TargetClaimedError, match="took over"):
        tables.write_bronze_data(spark, rows(spark, "a", "b"), target)
    ids = [r.source_record_id for r in tables.read_table(spark, target).collect()]
    assert sorted(ids) == ["a", "b"]


def test_of_two_runs_that_see_the_same_stale_claim_one_goes_on(spark, target, monkeypatch):
    claim(spark, target, "dead")
    held = storage.entries(spark, claims_folder(target))
    won = claim(spark, target, "run-1", stale_after=-1)
    monkeypatch.setattr(claims.storage, "entries", lambda *_: held)  # what the other saw before
    with pytest.raises(TargetClaimedError, match="run-1"):
        claim(spark, target, "run-2", stale_after=-1)
    monkeypatch.undo()
    won.renew()
    won.release()
    assert not storage.exists(spark, claims_folder(target))


def test_renewing_keeps_a_claim_from_going_stale(spark, target):
    held = claim(spark, target, "run-1")
    storage.touch(spark, held.path, 1000)
    held.renew()
    with pytest.raises(TargetClaimedError):
        claim(spark, target, "run-2", stale_after=60)
    held.release()
