"""Create raw tables and append the rows they do not hold yet.

Tables are folders of files in one format (``parquet`` unless told otherwise; ``delta``
works where its jar is on the classpath). Rows are only ever added.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from rawstrata.operators import matching
from rawstrata.operators.matching import DEFAULT_KEYS, KeyBounds
from rawstrata.session import staged
from rawstrata.sources import storage
from rawstrata.sources.claims import Claim, claimed
from rawstrata.sources.storage import PathLike, PathState

DEFAULT_FORMAT = "parquet"


@dataclass(frozen=True)
class WriteMetrics:
    """Row counts of one write."""

    replay_existing_row_count: int
    inserted_row_count: int
    hash_conflict_count: int
    target_total_row_count: int


def read_table(
    spark: SparkSession,
    target: PathLike,
    fmt: str = DEFAULT_FORMAT,
    schema: StructType | None = None,
) -> DataFrame:
    """Scan a table by path. A known schema saves looking into a file for it; Delta tables
    know theirs."""
    reader = spark.read.format(fmt)
    if schema is not None and fmt != "delta":
        reader = reader.schema(schema)
    return reader.load(str(target))


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """A few rows to look at."""
    return df.limit(rows)


def create_table(
    df: DataFrame, target: PathLike, fmt: str = DEFAULT_FORMAT, *, repeated: bool = False
) -> None:
    """First write. Fails if anything exists at the path, unless it repeats a first write that
    did not come to its end; an empty frame keeps its schema."""
    df.write.format(fmt).mode("append" if repeated else "errorifexists").save(str(target))


def append_rows(df: DataFrame, target: PathLike, fmt: str = DEFAULT_FORMAT) -> None:
    """Add rows to a table."""
    df.write.format(fmt).mode("append").save(str(target))


def in_target_layout(df: DataFrame, target: DataFrame) -> DataFrame:
    """The frame with the target's column order; refuses other names or types, since file
    formats would accept them and the table would no longer read as one schema."""
    ours, theirs = (
        {field.name: field.dataType.simpleString() for field in frame.schema.fields}
        for frame in (df, target)
    )
    if ours != theirs:
        differing = sorted(
            name for name in ours.keys() | theirs.keys() if ours.get(name) != theirs.get(name)
        )
        raise ValueError(f"Columns differ between source and target: {differing}")
    return df.select(*target.columns)


@contextmanager
def _staged_batch(
    incoming: DataFrame, keys: Sequence[str], bounds: KeyBounds | None
) -> Iterator[tuple[DataFrame, KeyBounds]]:
    """The batch evaluated once, with the bounds observed on the way. With bounds given, the
    batch is a scan of such a table already."""
    if bounds is not None:
        yield incoming, bounds
        return
    seen = Observation()
    with staged(incoming.observe(seen, *matching.bounds_of(keys)), "incoming") as batch:
        yield batch, matching.key_bounds(seen.get, keys)


def merge_new_records(
    spark: SparkSession,
    df: DataFrame,
    target: PathLike,
    merge_keys: Sequence[str] = DEFAULT_KEYS,
    *,
    fmt: str = DEFAULT_FORMAT,
    bounds: KeyBounds | None = None,
    held_claim: Claim | None = None,
) -> WriteMetrics:
    """Append the rows whose key the target lacks, or nothing if any payload conflicts.

    The batch is written out once and its keys' range observed, so the target's scan is
    pruned to it. The matched keys, of a large batch all keys, are written out once and counted on
    the way; what finds the new rows reads that narrow table. The number of inserted rows is
    observed during the append.
    ``bounds`` says that the caller has written the batch out already. A claim the caller holds
    is renewed right before the append, which so does not happen once another run took over.
    """
    matching.validate_merge_keys(df, merge_keys)
    held = read_table(spark, target, fmt)
    incoming = in_target_layout(df, held)
    with _staged_batch(incoming, merge_keys, bounds) as (batch, known):
        matches = matching.matched_keys(
            batch,
            held.filter(known.covers()),
            merge_keys,
            broadcast_keys=known.may_broadcast,
            batch_rows=known.rows,
            unmatched_too=not known.may_broadcast,
        )
        counted, appended = Observation(), Observation()
        with staged(matches.observe(counted, *matching.match_counts()), "matched") as compared:
            counts = counted.get
            inserted = 0
            if not counts["hash_conflict_count"] and known.rows > counts["matched_row_count"]:
                fresh = _new_rows(batch, compared, known)
                rows = F.count(F.lit(1)).alias("rows")
                if held_claim is not None:
                    held_claim.renew()
                append_rows(fresh.observe(appended, rows), target, fmt)
                inserted = appended.get["rows"]
    return WriteMetrics(
        replay_existing_row_count=counts["replay_existing_row_count"],
        inserted_row_count=inserted,
        hash_conflict_count=counts["hash_conflict_count"],
        target_total_row_count=read_table(spark, target, fmt, held.schema).count(),
    )


def _new_rows(
    batch: DataFrame, compared: DataFrame, known: KeyBounds, *, null_safe: bool = True
) -> DataFrame:
    """The batch's rows whose key was not matched."""
    return matching.new_rows(
        batch,
        compared.filter("target_rows > 0"),
        known.keys,
        null_safe=null_safe,
        fresh_keys=None if known.may_broadcast else compared.filter("target_rows = 0"),
        batch_rows=known.rows,
    )


def write_bronze_data(
    spark: SparkSession,
    df: DataFrame,
    target: PathLike,
    merge_keys: Sequence[str] = DEFAULT_KEYS,
    *,
    fmt: str = DEFAULT_FORMAT,
    bounds: KeyBounds | None = None,
) -> WriteMetrics:
    """Create the table on the first write, merge on later ones, refuse a foreign path.

    The target is claimed for the time of the write, so that of two runs one is refused and no
    key is added twice.
    """
    with claimed(spark, target) as held_claim:
        state = storage.path_state(spark, target, fmt)
        if state is PathState.FOREIGN:
            raise ValueError(f"Target path exists but is not a {fmt} table: {target}")
        if state is PathState.TABLE:
            return merge_new_records(
                spark, df, target, merge_keys, fmt=fmt, bounds=bounds, held_claim=held_claim
            )
        matching.validate_merge_keys(df, merge_keys)
        create_table(df, target, fmt, repeated=state is PathState.UNFINISHED)
        written = read_table(spark, target, fmt, df.schema).count()
        return WriteMetrics(0, written, 0, written)


def quoted(name: str) -> str:
    """A table name with every part quoted for SQL."""
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def sql_text(value: str) -> str:
    """A string literal for SQL."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def register_table(
    spark: SparkSession, table: str, location: PathLike, fmt: str = DEFAULT_FORMAT
) -> bool:
    """Make the catalog know a table that already exists as files.

    Returns whether the catalog knows the table now; ``False`` means nothing is there yet.
    Refuses a location that holds something else.
    """
    if spark.catalog.tableExists(table):
        return True
    state = storage.path_state(spark, location, fmt)
    if state is PathState.FOREIGN:
        raise RuntimeError(
            f"Cannot register {table}: location exists but is not a {fmt} table: {location}"
        )
    if state is PathState.TABLE:
        uri = sql_text(storage.qualified(spark, location))
        spark.sql(f"CREATE TABLE {quoted(table)} USING {fmt} LOCATION {uri}")
    return state is PathState.TABLE


def write_named_table(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    location: PathLike,
    merge_keys: Sequence[str] = DEFAULT_KEYS,
    *,
    fmt: str = DEFAULT_FORMAT,
    bounds: KeyBounds | None = None,
) -> None:
    """Older write: a catalog table, keys compared with plain equality.

    Registers or creates the table, raises naming one conflicting key if there is any, and
    otherwise appends the unmatched rows. A row with a NULL key matches nothing and is
    therefore added again by every run.
    """
    matching.validate_merge_keys(df, merge_keys)
    with claimed(spark, location) as held_claim:
        if register_table(spark, table, location, fmt):
            _merge_named(spark, df, table, merge_keys, bounds, held_claim)
        else:
            df.write.format(fmt).option("path", str(location)).saveAsTable(table)


def _merge_named(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    merge_keys: Sequence[str],
    bounds: KeyBounds | None,
    held_claim: Claim,
) -> None:
    held = spark.table(table)
    incoming = in_target_layout(df, held)
    with _staged_batch(incoming, merge_keys, bounds) as (batch, known):
        matches = matching.matched_keys(
            batch,
            held.filter(known.covers()),
            merge_keys,
            null_safe=False,
            broadcast_keys=known.may_broadcast,
            batch_rows=known.rows,
            unmatched_too=not known.may_broadcast,
        )
        with staged(matches, "matched") as compared:
            conflict = matching.first_conflict(compared, merge_keys).first()
            if conflict is not None:
                named = ", ".join(f"{key.lstrip('_')}={conflict[key]}" for key in merge_keys)
                raise ValueError(f"Conflicting content for {table}: {named}")
            fresh = _new_rows(batch, compared, known, null_safe=False)
            held_claim.renew()
            fresh.write.insertInto(table)
