import hashlib
import json
from datetime import datetime, timezone

from pyspark.sql import functions as F

from rawstrata.functions.hashing import piped_hash
from rawstrata.operators.enrich import (
    add_ingestion_metadata,
    add_metadata_columns,
    add_record_hash,
    add_short_metadata_columns,
)


def hashes(df):
    return [row["_record_hash"] for row in df.collect()]


def test_hash_is_sha256_of_the_row_as_json(people):
    wanted = [
        hashlib.sha256(
            json.dumps(row.asDict(), separators=(",", ":"), ensure_ascii=False).encode()
        ).hexdigest()
        for row in people.collect()
    ]
    assert hashes(add_record_hash(people)) == wanted


def test_equal_rows_hash_alike_and_others_do_not(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2)], "x string, y bigint")
    first, second, third = hashes(add_record_hash(df))
    assert first == second != third


def test_null_position_matters_to_the_json_hash_only(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    assert len(set(hashes(add_record_hash(df)))) == 2
    assert len(set(hashes(add_record_hash(df, piped_hash)))) == 1
    assert hashes(add_record_hash(df, piped_hash))[0] == hashlib.sha256(b"a||b").hexdigest()


def test_unusual_column_names(spark):
    df = spark.createDataFrame([("v",)], "`a.b` string")
    assert hashes(add_record_hash(df)) == [hashlib.sha256(b'{"a.b":"v"}').hexdigest()]


def test_metadata_values_and_order(people):
    enriched = add_metadata_columns(people, "batch", "run", "system")
    assert enriched.columns == [
        *people.columns,
        "_record_hash",
        "_source_batch_id",
        "_pipeline_run_id",
        "_source_system",
        "_ingested_timestamp",
    ]
    row = enriched.first()
    assert (row._source_batch_id, row._pipeline_run_id, row._source_system) == (
        "batch",
        "run",
        "system",
    )
    assert dict(enriched.dtypes)["_ingested_timestamp"] == "timestamp"


def test_ingestion_time_is_now_and_the_same_for_every_evaluation(spark, people):
    before = spark.sql("SELECT current_timestamp() AS t").first().t
    df = add_ingestion_metadata(people, "b", "r", "s")
    first = {row._ingested_timestamp for row in df.collect()}
    second = {row._ingested_timestamp for row in df.collect()}
    after = spark.sql("SELECT current_timestamp() AS t").first().t
    assert first == second and len(first) == 1
    assert before <= first.pop() <= after


def test_metadata_stays_out_of_the_hash(people):
    plain = sorted(hashes(add_record_hash(people)))
    for run in ("run-1", "run-2"):
        assert sorted(hashes(add_metadata_columns(people, "b", run, "s"))) == plain


def test_fixed_time_and_short_names(people):
    at = datetime(2024, 5, 6, 7, 8, 9, tzinfo=timezone.utc)
    df = add_short_metadata_columns(people, "b", "r", "s", ingested_at=at)
    assert df.columns[-5:] == [
        "_record_hash",
        "_batch_id",
        "_run_id",
        "_source_system",
        "_ingested_timestamp",
    ]
    text = df.select(F.date_format("_ingested_timestamp", "yyyy-MM-dd HH:mm:ss").alias("t"))
    assert {row.t for row in text.collect()} == {"2024-05-06 07:08:09"}
