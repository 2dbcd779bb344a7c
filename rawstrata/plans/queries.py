"""The package's operators as queries over a folder of parquet tables.

Each query takes a session and that folder, runs over whole tables and returns a frame.
Tables stand in for extracts: their columns become text, a natural key becomes
``source_record_id``, and an earlier load of ``orders`` is the orders placed before 1998.
"""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rawstrata.contracts import (
    CORRUPT_RECORD,
    RECORD_HASH,
    SCHEMAS,
    SOURCE_RECORD_ID,
    SOURCE_SYSTEM,
    text_schema,
)
from rawstrata.functions.hashing import piped_hash
from rawstrata.operators import enrich, events, matching, quality, quarantine, tables
from rawstrata.operators.audit import IngestionAuditRecord, append_audit_record
from rawstrata.operators.matching import DEFAULT_KEYS
from rawstrata.plans.ingestion import (
    AUDIT_TABLE,
    BronzeIngestionConfig,
    ingest_batch,
    ingest_named_entity,
)
from rawstrata.session import scratch_path, use_utc
from rawstrata.sources.delimited import (
    load_entity_data,
    read_source_csv,
    resolve_source_path,
)
from rawstrata.sources.storage import child

Query = Callable[[SparkSession, str], DataFrame]

SYSTEM = "OLTP"
FIXED_TIME = datetime(2024, 1, 1, tzinfo=timezone.utc)
LOADED_BEFORE = "1998-01-01"
AUDITED = [
    "source_batch_id",
    "entity",
    "source_row_count",
    "corrupt_record_count",
    "null_business_key_count",
    "duplicate_business_key_count",
    "duplicate_rows_beyond_first",
    "replay_existing_row_count",
    "inserted_row_count",
    "hash_conflict_count",
    "target_total_row_count",
    "status",
    "error_message",
]


# ---- frames ----------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text; amounts with two decimals."""

    def text(name: str, kind: str) -> Column:
        value = F.col(name).cast("decimal(18,2)") if kind == "double" else F.col(name)
        return value.cast("string").alias(name)

    return df.select(*[text(name, kind) for name, kind in df.dtypes])


def as_extract(df: DataFrame, key: str) -> DataFrame:
    """A frame as an extract identified by one of its columns."""
    return as_text(df).select(F.col(key).alias(SOURCE_RECORD_ID), "*")


def extract(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    return as_extract(table(spark, sf_dir, name), key)


def orders(spark: SparkSession, sf_dir: str, *, loaded: bool = False) -> DataFrame:
    """All orders, or those an earlier batch brought."""
    df = table(spark, sf_dir, "orders")
    return as_extract(before(df) if loaded else df, "o_orderkey")


def before(df: DataFrame) -> DataFrame:
    """Orders of the earlier batch, by the date itself, so that scans can skip the others."""
    return df.filter(F.col("o_orderdate") < F.lit(LOADED_BEFORE).cast("timestamp"))


def with_former_status(df: DataFrame) -> DataFrame:
    """The orders as they were when those now in status P were still open."""
    former = F.when(F.col("o_orderstatus") == "P", "O").otherwise(F.col("o_orderstatus"))
    return df.withColumn("o_orderstatus", former)


def without_some_ids(df: DataFrame) -> DataFrame:
    """Orders of unspecified priority come without an id."""
    unspecified = F.col("o_orderpriority") == "4-NOT SPECIFIED"
    return df.withColumn(SOURCE_RECORD_ID, F.when(~unspecified, F.col(SOURCE_RECORD_ID)))


def hashed(df: DataFrame) -> DataFrame:
    return enrich.add_record_hash(df).withColumn(SOURCE_SYSTEM, F.lit(SYSTEM))


def in_batch(df: DataFrame, batch_id: str) -> DataFrame:
    return enrich.add_metadata_columns(df, batch_id, "run-1", SYSTEM, ingested_at=FIXED_TIME)


def flawed_line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items identified by their order, some without id, some malformed, some unhashed."""
    kind = F.concat("l_returnflag", "l_linestatus")
    some_ids = F.when(kind == "RF", "").when(kind != "AF", F.col(SOURCE_RECORD_ID))
    hash_failed = F.col("l_discount") == "0.00"
    is_malformed = F.col("l_quantity") == "50.00"
    return (
        extract(spark, sf_dir, "lineitem", "l_orderkey")
        .transform(enrich.add_record_hash)
        .withColumns(
            {
                RECORD_HASH: F.when(~hash_failed, F.col(RECORD_HASH)),
                CORRUPT_RECORD: F.when(is_malformed, F.col("l_shipdate")),
                SOURCE_RECORD_ID: some_ids,
            }
        )
    )


def flawed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of which errors have no id, sign-ups a blank one, and views no hash."""
    kind = F.col("event_type")
    some_ids = F.when(kind == "signup", "").when(kind != "error", F.col(SOURCE_RECORD_ID))
    return (
        extract(spark, sf_dir, "events", "event_id")
        .transform(enrich.add_record_hash)
        .withColumns(
            {
                SOURCE_RECORD_ID: some_ids,
                RECORD_HASH: F.when(kind != "view", F.col(RECORD_HASH)),
            }
        )
    )


def in_contract(df: DataFrame, entity: str, **columns: str) -> DataFrame:
    """Columns, or expressions of them, under the names of an entity's contract; what they leave
    of it is NULL."""
    return df.select(
        *[
            (F.expr(columns[name]) if name in columns else F.lit(None).cast("string")).alias(name)
            for name in SCHEMAS[entity].names
        ]
    )


def customer_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_contract(
        as_text(table(spark, sf_dir, "customer")),
        "customer",
        source_record_id="c_custkey",
        customer_id="c_custkey",
        first_name="c_nationkey",
        last_name="c_name",
        phone="c_acctbal",
        loyalty_status="c_mktsegment",
    )


def order_entity(spark: SparkSession, sf_dir: str, *, loaded: bool = False) -> DataFrame:
    df = table(spark, sf_dir, "orders")
    return in_contract(
        as_text(before(df) if loaded else df),
        "order",
        source_record_id="o_orderkey",
        order_id="o_orderkey",
        customer_id="o_custkey",
        order_timestamp="o_orderdate",
        channel="o_orderpriority",
        order_status="o_orderstatus",
        order_total_amount="o_totalprice",
    )


def product_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_contract(
        as_text(table(spark, sf_dir, "part")),
        "product",
        source_record_id="p_partkey",
        product_id="p_partkey",
        sku="p_size",
        product_name="p_name",
        brand="p_brand",
        unit_price="p_retailprice",
        currency_code="p_type",
    )


def order_item_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_contract(
        as_text(table(spark, sf_dir, "lineitem")),
        "order_item",
        source_record_id="l_orderkey",
        order_item_id="l_linenumber",
        order_id="l_orderkey",
        product_id="l_partkey",
        quantity="l_quantity",
        unit_price="l_suppkey",
        discount_amount="l_discount",
        tax_amount="l_tax",
        line_total_amount="l_extendedprice",
        created_at="l_shipdate",
        updated_at="l_returnflag || l_linestatus",
    )


def add_extract(df: DataFrame, path: str) -> None:
    """Add part files with header to an extract folder."""
    df.write.mode("append").options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


# ---- sources ---------------------------------------------------------------------------


def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = as_text(table(spark, sf_dir, "customer"))
    path = scratch_path(spark, "scan_csv")
    add_extract(customers, path)
    schema = text_schema(" ".join([*customers.columns, CORRUPT_RECORD]))
    return read_source_csv(spark, schema, path)


def scan_csv_corrupt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Machinery customers come with a column too many, furniture with one too few."""
    customers = as_text(table(spark, sf_dir, "customer"))
    segment = F.col("c_mktsegment")
    path = scratch_path(spark, "scan_csv_corrupt")
    add_extract(customers.filter(~segment.isin("MACHINERY", "FURNITURE")), path)
    surplus = customers.filter(segment == "MACHINERY").withColumn("extra", F.lit("extra"))
    add_extract(surplus, path)
    add_extract(customers.filter(segment == "FURNITURE").drop("c_mktsegment"), path)
    schema = text_schema(" ".join([*customers.columns, CORRUPT_RECORD]))
    return read_source_csv(spark, schema, path)


def scan_csv_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, whose texts hold line breaks, as an extract of part files, a task each."""
    documents = as_text(table(spark, sf_dir, "documents"))
    path = scratch_path(spark, "scan_csv_split")
    add_extract(documents.repartition(8), path)
    schema = text_schema(" ".join([*documents.columns, CORRUPT_RECORD]))
    return read_source_csv(spark, schema, path)


def scan_csv_by_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items, declared to hold no line breaks, so that files are read in splits."""
    items = extract(spark, sf_dir, "lineitem", "l_orderkey")
    path = scratch_path(spark, "scan_csv_by_line")
    add_extract(items, path)
    schema = text_schema(" ".join([*items.columns, CORRUPT_RECORD]))
    return read_source_csv(spark, schema, path, records_span_lines=False)


def load_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "load_entity")
    customers = customer_entity(spark, sf_dir)
    add_extract(customers, resolve_source_path(root, "B001", "customer"))
    return load_entity_data(spark, root, "B001", "customer")


# ---- enrichment ------------------------------------------------------------------------


def record_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.add_record_hash(orders(spark, sf_dir)).select(SOURCE_RECORD_ID, RECORD_HASH)


def record_hash_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = extract(spark, sf_dir, "documents", "doc_id")
    return enrich.add_record_hash(documents).select(SOURCE_RECORD_ID, RECORD_HASH)


def record_hash_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    some = without_some_ids(orders(spark, sf_dir))
    return enrich.add_record_hash(some, piped_hash).select("o_orderkey", RECORD_HASH)


def ingestion_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = extract(spark, sf_dir, "customer", "c_custkey")
    return enrich.add_ingestion_metadata(
        customers, "B001", "run-1", SYSTEM, ingested_at=FIXED_TIME
    ).withColumn("_ingested_timestamp", F.col("_ingested_timestamp").cast("string"))


def enrich_standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched = in_batch(extract(spark, sf_dir, "customer", "c_custkey"), "B001")
    return enriched.withColumn("_ingested_timestamp", F.col("_ingested_timestamp").cast("string"))


def enrich_short_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched = enrich.add_short_metadata_columns(
        extract(spark, sf_dir, "part", "p_partkey"), "B001", "run-1", SYSTEM, ingested_at=FIXED_TIME
    )
    return enriched.withColumn("_ingested_timestamp", F.col("_ingested_timestamp").cast("string"))


# ---- quality ---------------------------------------------------------------------------


def null_or_blank_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.blank_id_rows(flawed_events(spark, sf_dir))


def null_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unhashed_rows(flawed_events(spark, sf_dir))


def corrupt_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.corrupt_rows(flawed_line_items(spark, sf_dir)).select(
        "l_orderkey", "l_linenumber", "l_partkey", CORRUPT_RECORD
    )


def duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicated_ids(flawed_line_items(spark, sf_dir))


def validation_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.validation_metrics(flawed_line_items(spark, sf_dir))


def validation_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocking errors of the flawed line items as order items, numbered, with the columns
    the contract misses last."""
    items = flawed_line_items(spark, sf_dir).withColumnsRenamed(
        {"l_orderkey": "order_id", "l_quantity": "quantity"}
    )
    missing = quality.check_required_columns(items, "order_item")
    report = quality.with_errors(quality.validation_metrics(items), missing)
    return quality.error_rows(report)


def missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the flawed line items lack of an order item, in contract order."""
    items = flawed_line_items(spark, sf_dir).withColumnsRenamed(
        {"l_orderkey": "order_id", "l_quantity": "quantity"}
    )
    missing = quality.check_required_columns(items, "order_item")
    return spark.createDataFrame(list(enumerate(missing, start=1)), "position int, name string")


# ---- matching --------------------------------------------------------------------------


def merge_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All orders against the earlier load. Some orders changed, and a fifth has no id, so
    one key holds a fifth of either side."""
    now, earlier = (
        without_some_ids(orders(spark, sf_dir, loaded=loaded)) for loaded in (False, True)
    )
    return hashed(now), hashed(with_former_status(earlier))


def merge_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.matched_keys(*merge_sides(spark, sf_dir), DEFAULT_KEYS)


def merge_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.classify(merge_matches(spark, sf_dir))


def hash_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.hash_conflicts(merge_matches(spark, sf_dir))


def merge_new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.new_rows(*merge_sides(spark, sf_dir), DEFAULT_KEYS)


def merge_new_rows_plain_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.new_rows(*merge_sides(spark, sf_dir), DEFAULT_KEYS, null_safe=False)


def first_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    matched = matching.matched_keys(*merge_sides(spark, sf_dir), DEFAULT_KEYS, null_safe=False)
    return matching.first_conflict(matched)


def dedup_merge_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return matching.reduce_to_one_per_key(turns, ("conv_id",), ("turn", "role", "text"))


# ---- tables ----------------------------------------------------------------------------


def written(spark: SparkSession, *batches: DataFrame) -> tuple[str, list[tables.WriteMetrics]]:
    """Write batches one after another to a new table; returns its path and the counts."""
    target = child(scratch_path(spark, "bronze"), "orders")
    return target, [tables.write_bronze_data(spark, batch, target) for batch in batches]


def table_content(spark: SparkSession, target: str) -> DataFrame:
    volatile = ("_pipeline_run_id", "_ingested_timestamp")
    return tables.read_table(spark, target).drop(*volatile)


def write_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, _ = written(spark, in_batch(orders(spark, sf_dir), "B001"))
    return table_content(spark, target)


def write_into_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = in_batch(orders(spark, sf_dir), "B001")
    target, _ = written(spark, now.filter("false"), now)
    return table_content(spark, target)


def write_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table an empty first batch of orders leaves: its columns, and how many rows."""
    target, (counts,) = written(spark, in_batch(orders(spark, sf_dir).filter("false"), "B001"))
    rows = [
        (place, name, kind, counts.target_total_row_count)
        for place, (name, kind) in enumerate(table_content(spark, target).dtypes, start=1)
    ]
    return spark.createDataFrame(rows, "position int, name string, kind string, rows bigint")


def write_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    earlier, now = orders(spark, sf_dir, loaded=True), orders(spark, sf_dir)
    target, _ = written(spark, in_batch(earlier, "B001"), in_batch(now, "B002"))
    return table_content(spark, target)


def write_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = orders(spark, sf_dir)
    target, _ = written(spark, in_batch(now, "B001"), in_batch(now, "B002"))
    return table_content(spark, target)


def write_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = orders(spark, sf_dir)
    earlier = with_former_status(orders(spark, sf_dir, loaded=True))
    target, _ = written(spark, in_batch(earlier, "B001"), in_batch(now, "B002"))
    return table_content(spark, target)


def write_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a first write, a merge, a replay and a blocked batch into one table."""
    now = orders(spark, sf_dir)
    changed = with_former_status(now)
    earlier = orders(spark, sf_dir, loaded=True)
    batches = {"first": earlier, "merge": now, "replay": now, "conflict": changed}
    _, metrics = written(spark, *[in_batch(df, name) for name, df in batches.items()])
    rows = [
        (
            name,
            counts.replay_existing_row_count,
            counts.inserted_row_count,
            counts.hash_conflict_count,
            counts.target_total_row_count,
        )
        for name, counts in zip(batches, metrics)
    ]
    return spark.createDataFrame(
        rows,
        "scenario string, replay_existing_row_count bigint, inserted_row_count bigint, "
        "hash_conflict_count bigint, target_total_row_count bigint",
    )


def fresh_table_name() -> str:
    return f"rawstrata_{uuid.uuid4().hex}"


def register_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    location, name = scratch_path(spark, "registered"), fresh_table_name()
    tables.create_table(orders(spark, sf_dir), location)
    tables.register_table(spark, name, location)
    return spark.table(name)


def write_named_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earlier load, then all orders, into a catalog table compared by plain equality:
    orders without id that were loaded before come in twice."""
    location, name = scratch_path(spark, "named"), fresh_table_name()
    for loaded in (True, False):
        batch = hashed(without_some_ids(orders(spark, sf_dir, loaded=loaded)))
        tables.write_named_table(spark, batch, name, location)
    return spark.table(name)


# ---- runs ------------------------------------------------------------------------------


def run_config(root: str, batch_id: str) -> BronzeIngestionConfig:
    return BronzeIngestionConfig(child(root, "source"), child(root, "bronze"), batch_id, SYSTEM)


def audit_rows(spark: SparkSession, root: str) -> DataFrame:
    return tables.read_table(spark, child(root, "bronze", AUDIT_TABLE)).select(*AUDITED)


def ingest_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "ingest_entity")
    config = run_config(root, "B001")
    add_extract(customer_entity(spark, sf_dir), config.source_path("customer"))
    ingest_batch(spark, config, ["customer"])
    return table_content(spark, config.target_path("customer"))


def ingest_batch_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "ingest_batch")
    config = run_config(root, "B001")
    sources = {"customer": customer_entity, "order": order_entity, "product": product_entity}
    for entity, source in sources.items():
        add_extract(source(spark, sf_dir), config.source_path(entity))
    ingest_batch(spark, config, list(sources))
    return audit_rows(spark, root)


def audit_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows of three loads: the first creates the audit table, the others are added."""
    root = scratch_path(spark, "audit_append")
    for entity, name in (("customer", "customer"), ("order", "orders"), ("product", "part")):
        rows = table(spark, sf_dir, name).count()
        record = IngestionAuditRecord.start(
            source_batch_id="B001",
            pipeline_run_id="run-1",
            source_system=SYSTEM,
            entity=entity,
            source_file_path=f"{root}/{entity}.csv",
            target_table=entity,
        ).with_write(tables.WriteMetrics(0, rows, 0, rows))
        done = record.succeeded(has_warnings=False).completed()
        append_audit_record(spark, done, child(root, "bronze", AUDIT_TABLE))
    return audit_rows(spark, root).select(
        "entity", "source_row_count", "inserted_row_count", "target_total_row_count", "status"
    )


def ingest_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One audit row per way a run can end: a first load, a replay, a load with malformed
    lines, duplicated ids, and changed payloads under known ids."""
    root = scratch_path(spark, "ingest_outcomes")
    customers, products = customer_entity(spark, sf_dir), product_entity(spark, sf_dir)
    changed = customers.withColumn("loyalty_status", F.lower("loyalty_status"))
    large = F.col("sku").cast("int") > 40
    first, second = run_config(root, "B001"), run_config(root, "B002")
    add_extract(customers, first.source_path("customer"))
    add_extract(products.filter(~large), first.source_path("product"))
    surplus = products.filter(large).withColumn("extra", F.lit("extra"))
    add_extract(surplus, first.source_path("product"))
    add_extract(order_item_entity(spark, sf_dir), first.source_path("order_item"))
    add_extract(changed, second.source_path("customer"))
    runs = [
        (first, "customer"),
        (first, "customer"),
        (first, "product"),
        (first, "order_item"),
        (second, "customer"),
    ]
    for config, entity in runs:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore", UserWarning)
            try:
                ingest_batch(spark, config, [entity])
            except ValueError:
                pass  # The audit row says so.
    return audit_rows(spark, root)


def ingest_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older flow with two batches of orders: those placed before 1998, then all."""
    root, database = scratch_path(spark, "ingest_named"), fresh_table_name()
    for batch_id in ("B001", "B002"):
        config = run_config(root, batch_id)
        batch = order_entity(spark, sf_dir, loaded=batch_id == "B001")
        add_extract(batch, config.source_path("order"))
        landed = ingest_named_entity(spark, config, "order", "run-1", database)
    return landed.drop("_ingested_timestamp")


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as log entries; sign-ups are below the minimum level, views have a level
    of their own."""
    kind = F.col("event_type")
    level = (
        F.when(kind == "error", "ERROR")
        .when(kind == "purchase", "WARN")
        .when(kind == "signup", "DEBUG")
        .when(kind == "view", "TRACE")
        .otherwise("INFO")
    )
    source = table(spark, sf_dir, "events")
    entries = events.log_entries(
        source,
        batch_id="B001",
        level=level,
        category=F.lit("INGESTION"),
        message=F.concat(kind, F.lit(" by "), F.col("user_id").cast("string")),
        entity=F.lit("event"),
        details=F.to_json(
            F.struct(
                F.col("event_id").cast("string").alias("event_id"),
                F.col("value").cast("decimal(18,2)").cast("string").alias("value"),
                "props",
            )
        ),
        logged_at=F.col("ts"),
    )
    name = fresh_table_name()
    events.create_log_table(spark, name, location=scratch_path(spark, "event_log"))
    events.append_entries(entries, name)
    logged = spark.table(name).drop("log_id")
    return logged.withColumn("logged_at", F.date_format("logged_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def fresh_log(spark: SparkSession, label: str) -> str:
    name = fresh_table_name()
    events.create_log_table(spark, name, location=scratch_path(spark, label))
    return name


def logged(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name).withColumn(
        "logged_at", F.date_format("logged_at", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )


def identified_events(source: DataFrame) -> DataFrame:
    """Events as entries whose ids come from the events' own ids."""
    return events.info_entries(
        source,
        batch_id="B001",
        category=F.lit("INGESTION"),
        message=F.concat("event_type", F.lit(" by "), F.col("user_id").cast("string")),
        logged_at=F.col("ts"),
        identity=[F.lit("event"), F.col("event_id")],
    )


def log_append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch of events of which the purchases were logged before the first run died, appended
    whole by two more runs: every event is there once, under the id it always has."""
    name = fresh_log(spark, "log_append_twice")
    entries = identified_events(table(spark, sf_dir, "events"))
    events.append_entries(entries.filter("message LIKE 'purchase%'"), name, once=True)
    for _ in range(2):
        events.append_entries(entries, name, once=True)
    return logged(spark, name)


def log_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of each level's helper and of one about an entity, under settings that keep
    warnings and errors, and under settings that keep nothing."""
    name = fresh_log(spark, "log_levels")
    source = table(spark, sf_dir, "events")
    columns = {
        "batch_id": "B001",
        "category": F.lit("INGESTION"),
        "message": F.col("event_id").cast("string"),
        "logged_at": F.col("ts"),
    }
    helpers = {
        "click": events.debug_entries,
        "view": events.info_entries,
        "purchase": events.warn_entries,
        "error": events.error_entries,
    }
    settings = events.LogSettings().changed(min_log_level="warn")
    for kind, helper in helpers.items():
        rows = helper(source.filter(F.col("event_type") == kind), **columns)
        settings.append(rows, name)
        settings.changed(persist=False).append(rows, name)
    of_user = source.filter("event_type = 'signup'")
    settings.append(events.entity_entries(of_user, "customer", "ERROR", **columns), name)
    return logged(spark, name).drop("log_id")


def audited_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows as if every customer's orders had been landed by a run of their own, one
    priority after another: open orders failed, those in status P gave warnings."""
    status = (
        F.when(F.max(F.col("o_orderstatus") == "O"), "FAILED")
        .when(F.max(F.col("o_orderstatus") == "P"), "SUCCESS_WITH_WARNINGS")
        .otherwise("SUCCESS")
    )
    return (
        table(spark, sf_dir, "orders")
        .groupBy(
            F.concat(F.lit("run-"), F.col("o_custkey").cast("string")).alias("pipeline_run_id"),
            F.col("o_orderpriority").alias("entity"),
        )
        .agg(
            status.alias("status"),
            F.count("*").alias("inserted_row_count"),
            F.min("o_orderdate").alias("started_at"),
            F.max("o_orderdate").alias("completed_at"),
        )
    )


def log_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start and end of every run, logged twice over and there once."""
    name = fresh_log(spark, "log_runs")
    entries = events.run_entries(audited_orders(spark, sf_dir))
    for _ in range(2):
        events.append_entries(entries, name, once=True)
    return logged(spark, name)


def log_table_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of a log table made by its statement, with the number of events logged in it."""
    name = fresh_table_name()
    place = scratch_path(spark, "log_table_layout")
    spark.sql(events.create_log_table_ddl(name, location=place))
    events.append_entries(identified_events(table(spark, sf_dir, "events")), name)
    rows = spark.table(name).count()
    kinds = dict(part.rsplit(" ", 1) for part in events.log_schema_ddl().split(", "))
    described = [
        (place, field.name, kinds[field.name], field.metadata["comment"], rows)
        for place, field in enumerate(spark.table(name).schema.fields, start=1)
    ]
    return spark.createDataFrame(
        described, "position int, name string, kind string, comment string, rows bigint"
    )


def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five orders by id, from a table of them in that order. The table is as many files
    as the sort has parts, and a scan takes them in no order, so the preview asks for it."""
    location = scratch_path(spark, "preview")
    tables.create_table(table(spark, sf_dir, "orders").orderBy("o_orderkey"), location)
    return tables.preview(tables.read_table(spark, location).orderBy("o_orderkey"))


def quarantine_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their defects, malformed lines included; line items by their order's id, which
    most orders repeat."""
    flawed = flawed_events(spark, sf_dir).withColumn(
        CORRUPT_RECORD, F.when(F.col("event_type") == "click", F.col("props"))
    )
    items = flawed_line_items(spark, sf_dir)

    def judged(df: DataFrame, kind: str) -> DataFrame:
        verdicts = quarantine.row_verdicts(df, quality.duplicated_ids(df), malformed=True)
        return verdicts.select(
            F.lit(kind).alias("kind"),
            SOURCE_RECORD_ID,
            F.concat_ws(", ", quarantine.REASONS).alias("reasons"),
        )

    return judged(flawed, "event").unionByName(judged(items, "line item"))


def quarantine_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of flawed events through both sinks, the second batch sent twice: what landed
    and what was set aside, each row once."""
    root = scratch_path(spark, "quarantine_sinks")
    target, aside = child(root, "event"), child(root, "quarantine", "event")
    flawed = flawed_events(spark, sf_dir).withColumn(SOURCE_SYSTEM, F.lit(SYSTEM))
    early = F.col("user_id").cast("bigint") % 2 == 0
    for batch_id, rows in (("B001", flawed.filter(early)), ("B002", flawed), ("B002", flawed)):
        quarantine.write_with_quarantine(spark, rows, target, aside, batch_id)
    landed = tables.read_table(spark, target)
    columns = ["event_id", SOURCE_RECORD_ID, RECORD_HASH]
    out = landed.select(F.lit("landed").alias("place"), *columns, F.lit("").alias("reasons"))
    for batch_id in ("B001", "B002"):
        rows = tables.read_table(spark, child(aside, batch_id))
        reasons = F.concat_ws(", ", quarantine.REASONS).alias("reasons")
        out = out.unionByName(rows.select(F.lit(batch_id).alias("place"), *columns, reasons))
    return out


QUERIES: dict[str, Query] = {
    "scan_csv": scan_csv,
    "scan_csv_corrupt": scan_csv_corrupt,
    "scan_csv_split": scan_csv_split,
    "scan_csv_by_line": scan_csv_by_line,
    "load_entity": load_entity,
    "record_hash": record_hash,
    "record_hash_text": record_hash_text,
    "record_hash_concat": record_hash_concat,
    "ingestion_metadata": ingestion_metadata,
    "enrich": enrich_standard,
    "enrich_short_names": enrich_short_names,
    "null_or_blank_ids": null_or_blank_ids,
    "null_hashes": null_hashes,
    "corrupt_records": corrupt_records,
    "duplicate_ids": duplicate_ids,
    "validation_metrics": validation_metrics,
    "validation_errors": validation_errors,
    "missing_columns": missing_columns,
    "merge_matches": merge_matches,
    "merge_classify": merge_classify,
    "hash_conflicts": hash_conflicts,
    "merge_new_rows": merge_new_rows,
    "merge_new_rows_plain_eq": merge_new_rows_plain_eq,
    "first_conflict": first_conflict,
    "dedup_merge_source": dedup_merge_source,
    "write_first": write_first,
    "write_empty": write_empty,
    "write_into_empty": write_into_empty,
    "write_merge": write_merge,
    "write_replay": write_replay,
    "write_conflict": write_conflict,
    "write_metrics": write_metrics,
    "register_table": register_table,
    "write_named_table": write_named_table,
    "ingest_entity": ingest_entity,
    "ingest_batch": ingest_batch_audit,
    "audit_append": audit_append,
    "ingest_outcomes": ingest_outcomes,
    "ingest_named": ingest_named,
    "event_log": event_log,
    "log_append_twice": log_append_twice,
    "log_levels": log_levels,
    "log_runs": log_runs,
    "log_table_layout": log_table_layout,
    "preview": preview_rows,
    "quarantine_verdicts": quarantine_verdicts,
    "quarantine_sinks": quarantine_sinks,
}
