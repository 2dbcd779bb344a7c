"""Set rows with defects aside instead of refusing their whole batch. Opt-in.

Every row gets the list of its defects; one staged table then feeds two sinks: rows without
defects go on to the raw table, the others to a quarantine table, which keeps a batch's rows
under the batch's id, so that a repeated run replaces them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from rawstrata.contracts import CORRUPT_RECORD, RECORD_HASH, SOURCE_RECORD_ID
from rawstrata.functions.predicates import is_blank
from rawstrata.operators.matching import MAX_BROADCAST_BYTES, bounds_of, key_bounds
from rawstrata.operators.quality import duplicated_ids
from rawstrata.operators.tables import DEFAULT_FORMAT, WriteMetrics, write_bronze_data
from rawstrata.session import staged
from rawstrata.sources import storage
from rawstrata.sources.claims import claimed
from rawstrata.sources.storage import PathLike, child

REASONS = "_quarantine_reasons"

# The defects, in the order in which a row lists them.
BLANK_ID = "blank id"
DUPLICATED_ID = "duplicated id"
MALFORMED = "malformed line"
NO_HASH = "no hash"

# Rows of one id may be a large part of all; without a broadcast they meet it in so many parts.
SALTS = 32


def row_verdicts(
    df: DataFrame, duplicated: DataFrame, *, broadcast_ids: bool = False, malformed: bool = False
) -> DataFrame:
    """The frame with ``_quarantine_reasons``: an array, empty for a row without defects.

    ``duplicated`` has the ids found more than once, each once (:func:`duplicated_ids`); every row
    of such an id counts as a defect. Malformed lines are landed and counted by default, so they
    are a reason only if asked for. A column the frame lacks gives no reason.
    """
    ids = duplicated.select(F.col(SOURCE_RECORD_ID).alias("id"))
    row_id = F.col(f"row.{SOURCE_RECORD_ID}")
    rows = df.select(F.struct("*").alias("row"))  # so that no name of a column can clash
    if broadcast_ids:
        marked = rows.join(F.broadcast(ids), row_id == F.col("id"), "left")
    else:
        every = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
        part = F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int").alias("part")
        on = (row_id == F.col("id")) & (F.col("part") == F.col("salt"))
        marked = rows.select("row", part).join(ids.select("id", every), on, "left")
    tests = [(is_blank(row_id), BLANK_ID), (F.col("id").isNotNull(), DUPLICATED_ID)]
    if malformed and CORRUPT_RECORD in df.columns:
        tests.append((F.col(f"row.{CORRUPT_RECORD}").isNotNull(), MALFORMED))
    if RECORD_HASH in df.columns:
        tests.append((F.col(f"row.{RECORD_HASH}").isNull(), NO_HASH))
    reasons = F.array_compact(F.array(*[F.when(test, reason) for test, reason in tests]))
    return marked.select("row.*", reasons.alias(REASONS))


def accepted(verdicts: DataFrame) -> DataFrame:
    """Rows without defects, as they came."""
    return verdicts.filter(F.size(REASONS) == 0).drop(REASONS)


def quarantined(verdicts: DataFrame) -> DataFrame:
    """Rows with defects, with their reasons."""
    return verdicts.filter(F.size(REASONS) > 0)


@dataclass(frozen=True)
class QuarantineMetrics:
    """What became of a batch's rows."""

    written: WriteMetrics
    accepted_row_count: int
    quarantined_row_count: int


def write_with_quarantine(
    spark: SparkSession,
    df: DataFrame,
    target: PathLike,
    quarantine: PathLike,
    batch_id: str,
    *,
    fmt: str = DEFAULT_FORMAT,
    malformed: bool = False,
) -> QuarantineMetrics:
    """Land the rows without defects and set the others aside in ``<quarantine>/<batch>``.

    The rows are judged once and staged; accepted and quarantined rows together are the batch. A
    batch that changes a payload the target holds is reported in the counts and lands nothing,
    like any other; what is set aside stays so.
    """
    sized = Observation()
    ids = duplicated_ids(df).select(SOURCE_RECORD_ID)
    with staged(ids.observe(sized, *bounds_of([SOURCE_RECORD_ID])), "duplicated") as duplicated:
        small = key_bounds(sized.get, [SOURCE_RECORD_ID]).key_bytes <= MAX_BROADCAST_BYTES
        judged = row_verdicts(df, duplicated, broadcast_ids=small, malformed=malformed)
        counted = Observation()
        good = F.count_if(F.size(REASONS) == 0).alias("accepted")
        every = F.count(F.lit(1)).alias("rows")
        with staged(judged.observe(counted, good, every), "verdicts") as verdicts:
            place = child(quarantine, storage.literal_name(batch_id))
            with claimed(spark, place):
                aside = quarantined(verdicts)
                aside.write.format(fmt).mode("overwrite").save(place)
            written = write_bronze_data(spark, accepted(verdicts), target, fmt=fmt)
    rows, kept = counted.get["rows"], counted.get["accepted"]
    return QuarantineMetrics(written, kept, rows - kept)
