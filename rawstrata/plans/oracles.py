"""The queries again, as SQL over the same tables, to compare results with."""

from __future__ import annotations

# The columns of the entities the queries land, in contract order.
ENTITY_COLUMNS = {
    "customer": (
        "source_record_id customer_id first_name last_name email phone date_of_birth "
        "loyalty_status marketing_opt_in created_at updated_at"
    ),
    "order": (
        "source_record_id order_id customer_id billing_address_id shipping_address_id "
        "order_timestamp channel order_status currency_code subtotal_amount discount_amount "
        "tax_amount shipping_amount order_total_amount created_at updated_at"
    ),
}

# Columns of the test tables as an extract would show them: text, amounts with two decimals.
TABLE_COLUMNS = {
    "customer": "c_custkey c_name c_nationkey c_acctbal:amount c_mktsegment",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice:amount",
    "orders": (
        "o_orderkey o_custkey o_orderstatus o_totalprice:amount o_orderdate o_orderpriority"
    ),
    "lineitem": (
        "l_orderkey l_partkey l_suppkey l_linenumber l_quantity:amount "
        "l_extendedprice:amount l_discount:amount l_tax:amount l_returnflag l_linestatus "
        "l_shipdate"
    ),
    "events": "event_id ts user_id event_type value:amount props",
    "documents": "doc_id text lang source n_chars",
}


def columns_of(table: str) -> list[str]:
    return [column.split(":")[0] for column in TABLE_COLUMNS[table].split()]


def text_of(column: str) -> str:
    name, _, is_amount = column.partition(":")
    value = f"CAST({name} AS DECIMAL(18,2))" if is_amount else name
    return f"CAST({value} AS VARCHAR) AS {name}"


def as_text(table: str) -> str:
    return f"SELECT {', '.join(map(text_of, TABLE_COLUMNS[table].split()))} FROM {table}"


def extract(table: str, key: str) -> str:
    return f"SELECT {key} AS source_record_id, * FROM ({as_text(table)})"


def json_hash(columns: list[str]) -> str:
    pairs = ", ".join(f"'{name}', {name}" for name in columns)
    return f"sha256(CAST(json_object({pairs}) AS VARCHAR)) AS _record_hash"


def hash_of(table: str) -> str:
    return json_hash(["source_record_id", *columns_of(table)])


NO_CORRUPT = "CAST(NULL AS VARCHAR) AS _corrupt_record"
RUN_COLUMNS = (
    "'run-1' AS {run}, 'OLTP' AS _source_system, '2024-01-01 00:00:00' AS _ingested_timestamp"
)

EVENTS = f"""
    SELECT * REPLACE (
        CASE event_type WHEN 'signup' THEN '' WHEN 'error' THEN NULL
             ELSE source_record_id END AS source_record_id,
        CASE WHEN event_type <> 'view' THEN _record_hash END AS _record_hash)
    FROM (SELECT *, {hash_of("events")} FROM ({extract("events", "event_id")}))
"""

ITEMS = f"""
    SELECT * REPLACE (
        CASE l_returnflag || l_linestatus WHEN 'RF' THEN '' WHEN 'AF' THEN NULL
             ELSE source_record_id END AS source_record_id,
        CASE WHEN l_discount <> '0.00' THEN _record_hash END AS _record_hash),
        CASE WHEN l_quantity = '50.00' THEN l_shipdate END AS _corrupt_record
    FROM (SELECT *, {hash_of("lineitem")} FROM ({extract("lineitem", "l_orderkey")}))
"""

PER_ID = f"""
    SELECT nullif(source_record_id, '') AS id, count(*) AS n,
           count(_corrupt_record) AS corrupt, count(*) - count(_record_hash) AS unhashed
    FROM ({ITEMS}) GROUP BY 1
"""

METRICS = f"""
    SELECT CAST(sum(n) AS BIGINT) AS row_count,
           CAST(coalesce(sum(n) FILTER (id IS NULL), 0) AS BIGINT)
               AS null_or_blank_source_record_id_count,
           count(*) FILTER (id IS NOT NULL AND n > 1)
               AS distinct_duplicated_source_record_id_count,
           CAST(sum(corrupt) AS BIGINT) AS corrupt_record_count,
           CAST(sum(unhashed) AS BIGINT) AS null_record_hash_count,
           CAST(coalesce(sum(n - 1) FILTER (id IS NOT NULL AND n > 1), 0) AS BIGINT)
               AS duplicate_rows_beyond_first_count
    FROM ({PER_ID})
"""

ORDERS = extract("orders", "o_orderkey")
SOME_IDS = f"""
    SELECT * REPLACE (CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN source_record_id END
                      AS source_record_id)
    FROM ({ORDERS})
"""


def loaded(orders: str) -> str:
    return f"SELECT * FROM ({orders}) WHERE o_orderdate < '1998-01-01'"


def former_status(orders: str) -> str:
    return f"""
        SELECT * REPLACE (CASE WHEN o_orderstatus = 'P' THEN 'O' ELSE o_orderstatus END
                          AS o_orderstatus)
        FROM ({orders})
    """


def hashed(orders: str) -> str:
    return f"SELECT *, {hash_of('orders')}, 'OLTP' AS _source_system FROM ({orders})"


def in_batch(orders: str, batch: str) -> str:
    return f"SELECT *, '{batch}' AS _source_batch_id FROM ({hashed(orders)})"


SIDES = f"""
    WITH incoming AS ({hashed(SOME_IDS)}),
    target AS ({hashed(former_status(loaded(SOME_IDS)))})
"""
SAME_KEY = (
    "s._source_system IS NOT DISTINCT FROM t._source_system "
    "AND s.source_record_id IS NOT DISTINCT FROM t.source_record_id"
)
PLAIN_KEY = (
    "s._source_system = t._source_system AND s.source_record_id = t.source_record_id"
)
SAME_HASH = "s._record_hash IS NOT DISTINCT FROM t._record_hash"
MATCHES = f"""
    {SIDES},
    pairs AS (
        SELECT s._source_system, s.source_record_id,
               count(*) FILTER ({SAME_HASH}) AS replay_pairs,
               count(*) FILTER (NOT ({SAME_HASH})) AS conflict_pairs
        FROM incoming s JOIN target t ON {SAME_KEY} GROUP BY ALL),
    ins AS (SELECT _source_system, source_record_id, count(*) AS incoming_rows
            FROM incoming GROUP BY ALL),
    tgt AS (SELECT _source_system, source_record_id, count(*) AS target_rows
            FROM target GROUP BY ALL),
    matched AS (
        SELECT s._source_system, s.source_record_id, incoming_rows, target_rows,
               replay_pairs, conflict_pairs
        FROM pairs s JOIN tgt t ON {SAME_KEY}
        JOIN ins i ON s._source_system IS NOT DISTINCT FROM i._source_system
                  AND s.source_record_id IS NOT DISTINCT FROM i.source_record_id)
"""


def in_contract(table: str, entity: str, **columns: str) -> str:
    listed = ", ".join(
        f"{columns[name] if name in columns else 'CAST(NULL AS VARCHAR)'} AS {name}"
        for name in ENTITY_COLUMNS[entity].split()
    )
    return f"SELECT {listed} FROM ({as_text(table)})"


CUSTOMERS = in_contract(
    "customer",
    "customer",
    source_record_id="c_custkey",
    customer_id="c_custkey",
    first_name="c_nationkey",
    last_name="c_name",
    phone="c_acctbal",
    loyalty_status="c_mktsegment",
)
ORDER_ENTITY = in_contract(
    "orders",
    "order",
    source_record_id="o_orderkey",
    order_id="o_orderkey",
    customer_id="o_custkey",
    order_timestamp="o_orderdate",
    channel="o_orderpriority",
    order_status="o_orderstatus",
    order_total_amount="o_totalprice",
)
LANDED_CUSTOMERS = f"""
    SELECT *, {json_hash([*ENTITY_COLUMNS["customer"].split(), "_corrupt_record"])},
           'OLTP' AS _source_system, 'B001' AS _source_batch_id
    FROM (SELECT *, {NO_CORRUPT} FROM ({CUSTOMERS}))
"""


def audit_row(
    batch: str,
    entity: str,
    table: str,
    *,
    rows: str = "count(*)",
    corrupt: str = "0",
    duplicated: str = "0",
    beyond_first: str = "0",
    replay: str = "0",
    inserted: str = "0",
    conflict: str = "0",
    total: str = "count(*)",
    status: str = "SUCCESS",
    error: str = "NULL",
) -> str:
    def number(text: str) -> str:
        return f"CAST({text} AS BIGINT)"

    return f"""
        SELECT '{batch}' AS source_batch_id, '{entity}' AS entity,
               {number(rows)} AS source_row_count, {number(corrupt)} AS corrupt_record_count,
               {number("0")} AS null_business_key_count,
               {number(duplicated)} AS duplicate_business_key_count,
               {number(beyond_first)} AS duplicate_rows_beyond_first,
               {number(replay)} AS replay_existing_row_count,
               {number(inserted)} AS inserted_row_count,
               {number(conflict)} AS hash_conflict_count,
               {number(total)} AS target_total_row_count,
               '{status}' AS status, CAST({error} AS VARCHAR) AS error_message
        FROM {table}
    """


def first_load(batch: str, entity: str, table: str) -> str:
    return audit_row(batch, entity, table, inserted="count(*)")


MISSING = """
    (VALUES (1, '_source_batch_id'), (2, '_pipeline_run_id'), (3, '_source_system'),
     (4, '_ingested_timestamp'), (5, 'order_item_id'), (6, 'product_id'), (7, 'unit_price'),
     (8, 'discount_amount'), (9, 'tax_amount'), (10, 'line_total_amount'), (11, 'created_at'),
     (12, 'updated_at')) AS missing(place, name)
"""
MALFORMED = "count(*) FILTER (p_size > 40)"
ITEM_IDS = "(SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)"
DUPLICATED = "count(*) FILTER (n > 1)"

def entry_id(*identity: str) -> str:
    """The id of an entry: parts of the hash of its identity as a JSON list."""
    listed = " || ',' || ".join(f"'\"' || {value} || '\"'" for value in identity)
    digest = f"sha256('[' || {listed} || ']')"
    parts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return " || '-' || ".join(f"substr({digest}, {at}, {size})" for at, size in parts)


def logged_at(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f') AS logged_at"


LOG_COLUMNS = (
    ("log_id", "STRING", "UUID per log entry"),
    ("batch_id", "STRING", "Unique identifier for this pipeline execution batch"),
    ("entity_name", "STRING", "Which entity (customer, order, etc.), null for pipeline-level events"),
    ("log_level", "STRING", "Severity level of the log entry"),
    ("log_category", "STRING", "Functional area that produced the log entry"),
    ("message", "STRING", "Human-readable log message"),
    ("details", "STRING", "JSON blob for structured metadata (row counts, file paths, durations, etc.)"),
    ("logged_at", "TIMESTAMP", "UTC timestamp of when the event was logged"),
)
LINE_ITEM_REASONS = """
    concat_ws(', ',
        CASE WHEN coalesce(source_record_id, '') = '' THEN 'blank id' END,
        CASE WHEN source_record_id <> ''
             AND count(*) OVER (PARTITION BY source_record_id) > 1 THEN 'duplicated id' END,
        CASE WHEN _corrupt_record IS NOT NULL THEN 'malformed line' END,
        CASE WHEN _record_hash IS NULL THEN 'no hash' END)
"""

ORACLES = {
    "scan_csv": f"SELECT *, {NO_CORRUPT} FROM ({as_text('customer')})",
    "scan_csv_corrupt": f"""
        SELECT * REPLACE (CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_mktsegment END
                          AS c_mktsegment),
               CASE c_mktsegment
                   WHEN 'MACHINERY' THEN concat_ws(',', {", ".join(columns_of("customer"))}, 'extra')
                   WHEN 'FURNITURE' THEN concat_ws(',', {", ".join(columns_of("customer")[:-1])})
               END AS _corrupt_record
        FROM ({as_text("customer")})
    """,
    "scan_csv_split": f"SELECT *, {NO_CORRUPT} FROM ({as_text('documents')})",
    "scan_csv_by_line": f"SELECT *, {NO_CORRUPT} FROM ({extract('lineitem', 'l_orderkey')})",
    "load_entity": f"SELECT *, {NO_CORRUPT} FROM ({CUSTOMERS})",
    "record_hash": f"SELECT source_record_id, {hash_of('orders')} FROM ({ORDERS})",
    "record_hash_text": f"""
        SELECT source_record_id, {hash_of("documents")} FROM ({extract("documents", "doc_id")})
    """,
    "record_hash_concat": f"""
        SELECT o_orderkey, sha256(concat_ws('||', source_record_id,
               {", ".join(columns_of("orders"))})) AS _record_hash
        FROM ({SOME_IDS})
    """,
    "ingestion_metadata": f"""
        SELECT *, 'B001' AS _source_batch_id, {RUN_COLUMNS.format(run="_pipeline_run_id")}
        FROM ({extract("customer", "c_custkey")})
    """,
    "enrich": f"""
        SELECT *, {hash_of("customer")}, 'B001' AS _source_batch_id,
               {RUN_COLUMNS.format(run="_pipeline_run_id")}
        FROM ({extract("customer", "c_custkey")})
    """,
    "enrich_short_names": f"""
        SELECT *, sha256(concat_ws('||', source_record_id, {", ".join(columns_of("part"))}))
                  AS _record_hash,
               'B001' AS _batch_id, {RUN_COLUMNS.format(run="_run_id")}
        FROM ({extract("part", "p_partkey")})
    """,
    "null_or_blank_ids": f"""
        SELECT * FROM ({EVENTS}) WHERE source_record_id IS NULL OR source_record_id = ''
    """,
    "null_hashes": f"SELECT * FROM ({EVENTS}) WHERE _record_hash IS NULL",
    "corrupt_records": f"""
        SELECT l_orderkey, l_linenumber, l_partkey, _corrupt_record FROM ({ITEMS})
        WHERE _corrupt_record IS NOT NULL
    """,
    "duplicate_ids": f"""
        SELECT source_record_id, count(*) AS row_count FROM ({ITEMS})
        WHERE source_record_id <> '' GROUP BY 1 HAVING count(*) > 1
    """,
    "validation_metrics": METRICS,
    "validation_errors": f"""
        WITH m AS ({METRICS}),
        found AS (
            SELECT 1 AS rank, null_or_blank_source_record_id_count AS n, 'Found '
                || null_or_blank_source_record_id_count
                || ' rows with null or blank source_record_id values' AS error FROM m
            UNION ALL
            SELECT 2, distinct_duplicated_source_record_id_count, 'Found '
                || distinct_duplicated_source_record_id_count
                || ' distinct duplicated source_record_id values' FROM m
            UNION ALL
            SELECT 3, null_record_hash_count, 'Found ' || null_record_hash_count
                || ' rows with null _record_hash' FROM m
            UNION ALL
            SELECT 3 + place, 1, 'Missing required column: ' || name FROM {MISSING})
        SELECT CAST(row_number() OVER (ORDER BY rank) AS INTEGER) AS position, error
        FROM found WHERE n > 0
    """,
    "missing_columns": f"SELECT place AS position, name FROM {MISSING}",
    "merge_matches": f"{MATCHES} SELECT * FROM matched",
    "merge_classify": f"""
        {MATCHES}
        SELECT CAST(sum(replay_pairs) AS BIGINT) AS replay_existing_row_count,
               CAST(sum(conflict_pairs) AS BIGINT) AS hash_conflict_count,
               CAST(sum(incoming_rows) AS BIGINT) AS matched_row_count
        FROM matched
    """,
    "hash_conflicts": f"{MATCHES} SELECT * FROM matched WHERE conflict_pairs > 0",
    "merge_new_rows": f"""
        {SIDES} SELECT * FROM incoming s
        WHERE NOT EXISTS (SELECT 1 FROM target t WHERE {SAME_KEY})
    """,
    "merge_new_rows_plain_eq": f"""
        {SIDES} SELECT * FROM incoming s
        WHERE NOT EXISTS (SELECT 1 FROM target t WHERE {PLAIN_KEY})
    """,
    "first_conflict": f"""
        {SIDES} SELECT s._source_system, s.source_record_id
        FROM incoming s JOIN target t ON {PLAIN_KEY} WHERE NOT ({SAME_HASH})
        ORDER BY 1, 2 LIMIT 1
    """,
    "dedup_merge_source": """
        SELECT conv_id, turn, role, text FROM conversations
        QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) = 1
    """,
    "write_first": in_batch(ORDERS, "B001"),
    "write_empty": f"""
        SELECT CAST(row_number() OVER () AS INTEGER) AS position, name, 'string' AS kind,
               CAST(0 AS BIGINT) AS rows
        FROM (SELECT unnest(['source_record_id', {", ".join(f"'{c}'" for c in columns_of("orders"))},
              '_record_hash', '_source_batch_id', '_source_system']) AS name)
    """,
    "write_into_empty": in_batch(ORDERS, "B001"),
    "write_merge": f"""
        SELECT *, CASE WHEN o_orderdate < '1998-01-01' THEN 'B001' ELSE 'B002' END
               AS _source_batch_id
        FROM ({hashed(ORDERS)})
    """,
    "write_replay": in_batch(ORDERS, "B001"),
    "write_conflict": in_batch(former_status(loaded(ORDERS)), "B001"),
    "write_metrics": """
        WITH n AS (
            SELECT count(*) AS everything,
                   count(*) FILTER (o_orderdate < '1998-01-01') AS earlier,
                   count(*) FILTER (o_orderstatus = 'P') AS changed
            FROM orders)
        SELECT 'first' AS scenario, CAST(0 AS BIGINT) AS replay_existing_row_count,
               earlier AS inserted_row_count, CAST(0 AS BIGINT) AS hash_conflict_count,
               earlier AS target_total_row_count FROM n
        UNION ALL SELECT 'merge', earlier, everything - earlier, 0, everything FROM n
        UNION ALL SELECT 'replay', everything, 0, 0, everything FROM n
        UNION ALL SELECT 'conflict', everything - changed, 0, changed, everything FROM n
    """,
    "register_table": ORDERS,
    "write_named_table": f"""
        {hashed(SOME_IDS)} UNION ALL
        SELECT * FROM ({hashed(loaded(SOME_IDS))}) WHERE source_record_id IS NULL
    """,
    "ingest_entity": LANDED_CUSTOMERS,
    "ingest_batch": f"""
        {first_load("B001", "customer", "customer")} UNION ALL
        {first_load("B001", "order", "orders")} UNION ALL
        {first_load("B001", "product", "part")}
    """,
    "audit_append": """
        SELECT entity, CAST(NULL AS BIGINT) AS source_row_count, n AS inserted_row_count,
               n AS target_total_row_count, 'SUCCESS' AS status
        FROM (SELECT 'customer' AS entity, count(*) AS n FROM customer UNION ALL
              SELECT 'order', count(*) FROM orders UNION ALL SELECT 'product', count(*) FROM part)
    """,
    "ingest_outcomes": f"""
        {first_load("B001", "customer", "customer")} UNION ALL
        {audit_row("B001", "customer", "customer", replay="count(*)")} UNION ALL
        {audit_row("B001", "product", "part", corrupt=MALFORMED, inserted="count(*)",
                   status="SUCCESS_WITH_WARNINGS")} UNION ALL
        {audit_row("B001", "order_item", ITEM_IDS, rows="sum(n)", duplicated=DUPLICATED,
                   beyond_first="sum(n - 1)", replay="NULL", inserted="NULL",
                   conflict="NULL", total="NULL", status="FAILED",
                   error="'ValueError: Bronze validation failed for entity ''order_item'':' "
                         f"|| chr(10) || '- Found ' || {DUPLICATED} "
                         "|| ' distinct duplicated source_record_id values'")} UNION ALL
        {audit_row("B002", "customer", "customer", conflict="count(*)", status="FAILED",
                   error="'ValueError: Found ' || count(*) "
                         "|| ' hash conflicts for entity ''customer'''")}
    """,
    "ingest_named": f"""
        SELECT *, {NO_CORRUPT},
               sha256(concat_ws('||', {", ".join(ENTITY_COLUMNS["order"].split())})) AS _record_hash,
               CASE WHEN order_timestamp < '1998-01-01' THEN 'B001' ELSE 'B002' END
                   AS _batch_id,
               'run-1' AS _run_id, 'OLTP' AS _source_system
        FROM ({ORDER_ENTITY})
    """,
    "event_log": """
        SELECT 'B001' AS batch_id, 'event' AS entity_name,
               CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'WARN'
                    WHEN 'view' THEN 'TRACE' ELSE 'INFO' END AS log_level,
               'INGESTION' AS log_category, event_type || ' by ' || user_id AS message,
               CAST(json_object('event_id', CAST(event_id AS VARCHAR),
                   'value', CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), 'props', props) AS VARCHAR)
                   AS details, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS logged_at
        FROM events WHERE event_type <> 'signup'
    """,
    "log_append_twice": f"""
        SELECT {entry_id("'B001'", "'event'", "event_id")} AS log_id, 'B001' AS batch_id,
               CAST(NULL AS VARCHAR) AS entity_name, 'INFO' AS log_level,
               'INGESTION' AS log_category, event_type || ' by ' || user_id AS message,
               CAST(NULL AS VARCHAR) AS details, {logged_at("ts")}
        FROM events
    """,
    "log_levels": f"""
        SELECT 'B001' AS batch_id, CASE event_type WHEN 'signup' THEN 'customer' END AS entity_name,
               CASE event_type WHEN 'purchase' THEN 'WARN' ELSE 'ERROR' END AS log_level,
               'INGESTION' AS log_category, CAST(event_id AS VARCHAR) AS message,
               CAST(NULL AS VARCHAR) AS details, {logged_at("ts")}
        FROM events WHERE event_type IN ('purchase', 'error', 'signup')
    """,
    "log_runs": f"""
        WITH audits AS (
            SELECT 'run-' || o_custkey AS run, o_orderpriority, count(*) AS n,
                   min(o_orderdate) AS started, max(o_orderdate) AS completed,
                   CASE WHEN count(*) FILTER (o_orderstatus = 'O') > 0 THEN 'FAILED'
                        WHEN count(*) FILTER (o_orderstatus = 'P') > 0
                        THEN 'SUCCESS_WITH_WARNINGS' ELSE 'SUCCESS' END AS status
            FROM orders GROUP BY ALL),
        runs AS (
            SELECT run, min(started) AS started, max(completed) AS completed, count(*) AS entities,
                   sum(n) AS inserted,
                   CASE WHEN count(*) FILTER (status = 'FAILED') > 0 THEN 'FAILED'
                        WHEN count(*) FILTER (status <> 'SUCCESS') > 0
                        THEN 'SUCCESS_WITH_WARNINGS' ELSE 'SUCCESS' END AS status
            FROM audits GROUP BY run)
        SELECT {entry_id("run", "'PIPELINE'", "'start'")} AS log_id, run AS batch_id,
               CAST(NULL AS VARCHAR) AS entity_name, 'INFO' AS log_level,
               'PIPELINE' AS log_category, 'Pipeline run started' AS message,
               CAST(NULL AS VARCHAR) AS details, {logged_at("started")}
        FROM runs
        UNION ALL
        SELECT {entry_id("run", "'PIPELINE'", "'end'")}, run, NULL,
               CASE status WHEN 'SUCCESS' THEN 'INFO' ELSE 'ERROR' END, 'PIPELINE',
               'Pipeline run completed — ' || status,
               '{{"status":"' || status || '","entities":' || entities
                   || ',"inserted_row_count":' || inserted || '}}', {logged_at("completed")}
        FROM runs
    """,
    "log_table_layout": "\nUNION ALL\n".join(
        f"""
        SELECT CAST({place} AS INTEGER) AS position, '{name}' AS name, '{kind}' AS kind,
               '{comment}' AS comment, count(*) AS rows FROM events
        """
        for place, (name, kind, comment) in enumerate(LOG_COLUMNS, start=1)
    ),
    "preview": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5",
    "quarantine_verdicts": f"""
        SELECT 'event' AS kind, source_record_id,
               concat_ws(', ',
                   CASE WHEN coalesce(source_record_id, '') = '' THEN 'blank id' END,
                   CASE WHEN event_type = 'click' AND props IS NOT NULL THEN 'malformed line' END,
                   CASE WHEN _record_hash IS NULL THEN 'no hash' END) AS reasons
        FROM ({EVENTS})
        UNION ALL
        SELECT 'line item', source_record_id, {LINE_ITEM_REASONS} FROM ({ITEMS})
    """,
    "quarantine_sinks": f"""
        WITH judged AS (
            SELECT event_id, user_id, source_record_id, _record_hash,
                   concat_ws(', ',
                       CASE WHEN coalesce(source_record_id, '') = '' THEN 'blank id' END,
                       CASE WHEN _record_hash IS NULL THEN 'no hash' END) AS reasons
            FROM ({EVENTS}))
        SELECT 'landed' AS place, event_id, source_record_id, _record_hash, reasons
        FROM judged WHERE reasons = ''
        UNION ALL
        SELECT 'B001', event_id, source_record_id, _record_hash, reasons
        FROM judged WHERE reasons <> '' AND CAST(user_id AS BIGINT) % 2 = 0
        UNION ALL
        SELECT 'B002', event_id, source_record_id, _record_hash, reasons
        FROM judged WHERE reasons <> ''
    """,
}
