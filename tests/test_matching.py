from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from pyspark.sql import functions as F

from rawstrata.functions.predicates import is_blank, keys_equal
from rawstrata.operators import matching
from rawstrata.operators.keyfilter import (
    bits_for,
    certain_strangers,
    key_bitmap,
    likely_members,
)

KEYS = ("_source_system", "source_record_id")
SCHEMA = "_source_system string, source_record_id string, _record_hash string"

systems = st.sampled_from(["erp", None])
ids = st.sampled_from(["a", "b", "", None])
payloads = st.sampled_from(["h1", "h2", None])
tables = st.lists(st.tuples(systems, ids, payloads), max_size=12)


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(list(rows), schema)


def by_brute_force(incoming, target, null_safe):
    """Counts from every pair of rows."""

    def match(left, right):
        return left[:2] == right[:2] and (null_safe or None not in left[:2])

    pairs = [(i, t) for i in incoming for t in target if match(i, t)]
    replays = sum(i[2] == t[2] for i, t in pairs)
    matched = sum(any(match(i, t) for t in target) for i in incoming)
    fresh = [i for i in incoming if not any(match(i, t) for t in target)]
    return replays, len(pairs) - replays, matched, Counter(fresh)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(incoming=tables, target=tables, null_safe=st.booleans(), broadcast=st.booleans())
def test_counts_and_new_rows_equal_every_pair_compared(
    spark, incoming, target, null_safe, broadcast
):
    left, right = frame(spark, incoming), frame(spark, target)
    matched = matching.matched_keys(
        left, right, KEYS, null_safe=null_safe, broadcast_keys=broadcast, batch_rows=len(incoming)
    )
    replays, conflicts, matched_rows, fresh = by_brute_force(incoming, target, null_safe)
    assert tuple(matching.classify(matched).first()) == (replays, conflicts, matched_rows)
    for held in (right, matched):
        rows = matching.new_rows(left, held, KEYS, null_safe=null_safe).collect()
        assert Counter(tuple(row) for row in rows) == fresh


def test_a_key_that_holds_everything_is_counted_without_pairing_rows(spark):
    rows = spark.range(100_000).selectExpr(
        "'erp' AS _source_system", "CAST(NULL AS string) AS source_record_id",
        "CAST(id AS string) AS _record_hash",
    )
    counts = matching.classify(matching.matched_keys(rows, rows, KEYS)).first()
    assert counts["replay_existing_row_count"] == 100_000
    assert counts["hash_conflict_count"] == 100_000**2 - 100_000
    assert counts["matched_row_count"] == 100_000


@pytest.mark.parametrize("missing_from", ["incoming", "target"])
def test_without_a_hash_on_both_sides_every_match_is_a_replay(spark, missing_from):
    sides = {
        "incoming": frame(spark, [("erp", "a", "h1")]),
        "target": frame(spark, [("erp", "a", "h2"), ("erp", "b", "h2")]),
    }
    sides[missing_from] = sides[missing_from].drop("_record_hash")
    matched = matching.matched_keys(sides["incoming"], sides["target"], KEYS)
    assert tuple(matching.classify(matched).first()) == (1, 0, 1)


def test_conflicts_are_listed_and_the_smallest_key_is_named_first(spark):
    target = frame(spark, [("erp", key, "old") for key in "abc"])
    incoming = frame(spark, [("erp", "c", "new"), ("erp", "b", "new"), ("erp", "a", "old")])
    matched = matching.matched_keys(incoming, target, KEYS)
    listed = matching.hash_conflicts(matched).collect()
    assert sorted((row.source_record_id, row.conflict_pairs) for row in listed) == [
        ("b", 1),
        ("c", 1),
    ]
    assert [tuple(row) for row in matching.first_conflict(matched, KEYS).collect()] == [
        ("erp", "b")
    ]


def test_key_check(spark):
    df = frame(spark, [])
    matching.validate_merge_keys(df, ("source_record_id",))
    matching.validate_merge_keys(df, KEYS)
    with pytest.raises(ValueError, match="At least one merge key"):
        matching.validate_merge_keys(df, ())
    with pytest.raises(ValueError, match="missing.*'other'"):
        matching.validate_merge_keys(df, ("source_record_id", "other"))


def bounds(df):
    return matching.key_bounds(df.agg(*matching.bounds_of(KEYS)).first().asDict(), KEYS)


def test_bounds_of_the_keys(spark):
    df = frame(spark, [("erp", "abcd", "h"), (None, "é", "h")])
    found = bounds(df)
    assert (found.rows, found.key_bytes) == (2, 2 * matching.ROW_OVERHEAD_BYTES + 3 + 4 + 0 + 2)
    assert found.ranges == (("erp", "erp", True), ("abcd", "é", False))
    assert found.may_broadcast
    assert not found._replace(key_bytes=matching.MAX_BROADCAST_BYTES + 1).may_broadcast
    empty = bounds(df.limit(0))
    assert (empty.rows, empty.key_bytes) == (0, 0)
    assert df.filter(empty.covers()).count() == 0
    assert df.filter(found.covers()).count() == 2
    assert bounds(df.filter("_source_system IS NULL")).covers() is not None


def test_the_range_of_the_keys_is_pushed_into_the_targets_scan(spark, tmp_path):
    path = str(tmp_path / "target")
    frame(spark, [("erp", str(n), "h") for n in range(20)]).write.parquet(path)
    known = bounds(frame(spark, [("erp", "3", "h"), ("erp", "5", "h")]))
    held = spark.read.parquet(path).filter(known.covers())
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    plan = held._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(source_record_id,3), LessThanOrEqual(source_record_id,5)" in plan
    assert held.count() == 3


def test_blank_ids_are_pushed_into_the_scan(spark, tmp_path):
    path = str(tmp_path / "rows")
    frame(spark, [("erp", "", "h"), ("erp", None, "h"), ("erp", "x", "h")]).write.parquet(path)
    blank = spark.read.parquet(path).filter(is_blank(F.col("source_record_id")))
    plan = blank._jdf.queryExecution().executedPlan().toString()
    assert "Or(IsNull(source_record_id),EqualTo(source_record_id,))" in plan
    assert blank.count() == 2


@pytest.mark.parametrize("null_safe", [True, False])
def test_held_keys_are_combined_before_they_are_shuffled(spark, tmp_path, monkeypatch, null_safe):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        path = str(tmp_path / "rows")
        frame(spark, [("erp", None, "h")] * 5 + [("erp", "a", "h")]).write.parquet(path)
        held = spark.read.parquet(path)
        rows = matching.new_rows(held, held, KEYS, null_safe=null_safe)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        right = plan.split("SortMergeJoin")[1].split("Exchange hashpartitioning")[2]
        assert "HashAggregate(keys=" in right
        assert rows.count() == (0 if null_safe else 5)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_target_is_read_by_key_and_hash_and_not_shuffled_when_keys_are_broadcast(spark, tmp_path):
    path = str(tmp_path / "target")
    wide = spark.range(10).selectExpr(
        "'erp' AS _source_system", "CAST(id AS string) AS source_record_id",
        "'h' AS _record_hash", "'payload' AS payload",
    )
    wide.write.parquet(path)
    target = spark.read.parquet(path)
    hits = matching.target_hits(wide, target, KEYS, broadcast_keys=True)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi, BuildRight" in plan
    read = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert len(read) == 1 and "payload" not in read[0]


@pytest.fixture
def random_ids(spark, tmp_path):
    """A target whose ids are in no order, and a batch of a few of them and others."""
    rows = spark.range(20_000).selectExpr(
        "'erp' AS _source_system",
        "IF(id % 5000 = 0, NULL, sha2(CAST(id AS string), 256)) AS source_record_id",
        "CAST(id AS string) AS _record_hash",
    )
    rows.write.parquet(str(tmp_path / "target"))
    target = spark.read.parquet(str(tmp_path / "target"))
    batch = rows.filter("pmod(hash(_record_hash), 100) = 0").unionByName(
        rows.filter("pmod(hash(_record_hash), 100) = 1").withColumn("_source_system", F.lit("crm"))
    )
    return batch, target


def test_a_bitmap_of_keys_in_no_order_lets_few_other_rows_pass(random_ids):
    batch, target = random_ids
    bits = bits_for(batch.count())
    likely = likely_members(target, key_bitmap(batch, KEYS, bits), KEYS, bits)
    on_keys = keys_equal("t", "b", KEYS)
    members = target.alias("t").join(batch.alias("b"), on_keys, "left_semi")
    assert members.exceptAll(likely).count() == 0
    assert likely.count() < members.count() + 0.12 * target.count()
    full = likely_members(target, key_bitmap(batch, KEYS, 2), KEYS, 2)  # every bit is set
    assert full.exceptAll(target).count() == 0 and full.count() == target.count()


def test_large_batches_shuffle_likely_target_rows_only(spark, random_ids):
    batch, target = random_ids
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hits = matching.target_hits(batch, target, KEYS, batch_rows=batch.count())
        plan = hits._jdf.queryExecution().executedPlan().toString()
        target_side = [line for line in plan.splitlines() if line.lstrip().startswith(":")]
        shuffled = [i for i, line in enumerate(target_side) if "Exchange hashpartitioning" in line]
        filtered = [i for i, line in enumerate(target_side) if "BroadcastHashJoin" in line]
        assert shuffled[0] < filtered[0]  # the bitmap, below the target's shuffle
        for null_safe in (True, False):
            plain, pruned = (
                matching.matched_keys(batch, target, KEYS, null_safe=null_safe, batch_rows=rows)
                for rows in (None, batch.count())
            )
            assert pruned.exceptAll(plain).count() == plain.exceptAll(pruned).count() == 0
            assert plain.count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bitmaps_grow_with_the_keys_up_to_a_bound():
    assert bits_for(0) == bits_for(1) == 1 << 15
    assert bits_for(1 << 20) == 1 << 24
    assert bits_for((1 << 20) + 1) == 1 << 25
    assert bits_for(1 << 40) == 1 << 29


def test_reduction_keeps_the_earliest_row_of_each_key(spark):
    df = spark.createDataFrame(
        [
            ("erp", "a", 2, "h1", "late"),
            ("erp", "a", 1, "h2", "early, larger hash"),
            ("erp", "a", 1, "h1", "early"),
            ("erp", None, 3, "h1", "null key"),
            ("erp", None, 3, "h1", "null key, tie"),
            ("crm", "a", 9, "h1", "other system"),
        ],
        "_source_system string, source_record_id string, _ingested_timestamp int, "
        "_record_hash string, note string",
    )
    reduced = matching.reduce_to_one_per_key(df)
    assert reduced.columns == df.columns
    assert sorted(row.note for row in reduced.collect()) == ["early", "null key", "other system"]
    with pytest.raises(ValueError, match="missing"):
        matching.reduce_to_one_per_key(df, keys=("nothing",))


def test_reduction_thins_out_hot_keys_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("IF(id % 3 = 0, 'hot', CAST(id AS string)) AS k", "id AS n")
    reduced = matching.reduce_to_one_per_key(df, ("k",), ("n",))
    plan = reduced._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan.split("Exchange")[1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


@pytest.fixture
def eager_skew_handling(spark):
    """Thresholds small enough for test data."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_hot_keys_are_split_between_tasks(spark, tmp_path, eager_skew_handling):
    hot = "IF(id % 3 = 0, 'hot', CAST(id AS string)) AS source_record_id"
    df = spark.range(60_000).repartition(8).selectExpr(
        "'erp' AS _source_system", hot, "sha2(CAST(id AS string), 256) AS _record_hash"
    )
    df.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    keys = rows.filter("source_record_id <> 'hot'")

    def final_plan(result):
        result.write.format("noop").mode("overwrite").save()
        summed = result.selectExpr("max(_record_hash)")
        summed.collect()
        return summed._jdf.queryExecution().executedPlan().toString()

    assert "SortMergeJoin(skew=true)" in final_plan(matching.target_hits(rows, rows, KEYS))
    assert "SortMergeJoin(skew=true)" in final_plan(matching.new_rows(rows, keys, KEYS))


PAYLOADS = ["abc1", "ABC1", "abc", "0abc", "h1", "", "«c1", None, "\0", "00"]


@pytest.mark.parametrize("batch_rows", [None, len(PAYLOADS) ** 2])
def test_packed_payloads_agree_as_their_texts_do(spark, batch_rows):
    pairs = [(f"{i},{k}", a, b) for i, a in enumerate(PAYLOADS) for k, b in enumerate(PAYLOADS)]
    incoming = frame(spark, [("erp", key, a) for key, a, _ in pairs])
    target = frame(spark, [("erp", key, b) for key, _, b in pairs] + [("erp", "other", "h1")])
    matched = matching.matched_keys(incoming, target, KEYS, batch_rows=batch_rows).collect()
    found = {row.source_record_id: (row.replay_pairs, row.conflict_pairs) for row in matched}
    assert found == {key: (1, 0) if a == b else (0, 1) for key, a, b in pairs}


def test_large_batches_are_shuffled_once_by_payload_and_once_by_key(spark, random_ids):
    batch, target = random_ids
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        matched = matching.matched_keys(batch, target, KEYS, batch_rows=batch.count())
        plan = matched._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len([line for line in shuffles if "source_record_id" in line]) == 2
    assert len(shuffles) == 3 and "SortMergeJoin" not in plan  # the third is the bitmap's


@pytest.mark.parametrize("null_safe", [True, False])
def test_few_rows_are_shuffled_to_find_the_new_ones(spark, random_ids, tmp_path, null_safe):
    batch, target = random_ids
    batch.unionByName(batch.limit(50)).write.parquet(str(tmp_path / "batch"))
    batch = spark.read.parquet(str(tmp_path / "batch"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for keys_seen in (batch.count(), 0):  # the least bits let more rows pass
            compared = matching.matched_keys(
                batch, target, KEYS, null_safe=null_safe, unmatched_too=True
            )
            matched = compared.filter("target_rows > 0")
            others = compared.filter("target_rows = 0")
            assert matched.count() > 0 and others.count() > 0
            plain = matching.new_rows(batch, matched, KEYS, null_safe=null_safe)
            fresh = matching.new_rows(
                batch, matched, KEYS, null_safe=null_safe, fresh_keys=others, batch_rows=keys_seen
            )
            assert fresh.columns == plain.columns
            assert fresh.exceptAll(plain).count() == plain.exceptAll(fresh).count() == 0
        bits = bits_for(batch.count())
        old, new = (key_bitmap(keys, KEYS, bits) for keys in (matched, others))
        unsure = likely_members(likely_members(batch, old, KEYS, bits), new, KEYS, bits)
        assert unsure.count() < 0.15 * batch.count()
        strangers = certain_strangers(batch, old, KEYS, bits)
        likely = likely_members(batch, old, KEYS, bits)
        assert strangers.unionByName(likely).exceptAll(batch).count() == 0
        assert strangers.count() + likely.count() == batch.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_zeros_of_either_sign_are_one_key(spark):
    batch = spark.sql("SELECT -0.0D AS k, 'h' AS _record_hash UNION ALL SELECT 1.0D, 'h'")
    held = spark.sql("SELECT 0.0D AS k, 'h' AS _record_hash")
    compared = matching.matched_keys(batch, held, ["k"], batch_rows=2, unmatched_too=True)
    matched, others = compared.filter("target_rows > 0"), compared.filter("target_rows = 0")
    fresh = matching.new_rows(batch, matched, ["k"], fresh_keys=others, batch_rows=2)
    assert [row.k for row in fresh.collect()] == [1.0]
