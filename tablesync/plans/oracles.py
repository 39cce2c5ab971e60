"""The same answers in plain SQL, over the same whole tables."""

from __future__ import annotations

ERROR_TS = "CASE WHEN event_type = 'error' THEN ts END"

LATEST = """
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM {source}
"""

EVENT_COLUMNS = "event_id, ts, user_id, event_type, value, props"

FIRST_HALF = "ts < TIMESTAMP '2024-01-16 00:00:00'"
SECOND_HALF = "ts >= TIMESTAMP '2024-01-16 00:00:00'"

SIZE_CHANGE = (
    """'{{"field":"{field}","change":"NULLED","reason":"DESTINATION_FIELD_SIZE_LIMITATION"}}'"""
)


def latest(source: str = "events") -> str:
    return LATEST.format(source=source)


def meta(field: str, bad: str) -> str:
    change = SIZE_CHANGE.format(field=field)
    return f"""CASE WHEN {bad} THEN '{{"changes":[' || {change} || ']}}' ELSE '{{"changes":[]}}' END"""


SURVIVORS = f"SELECT {EVENT_COLUMNS} FROM ({latest()}) WHERE rn = 1 AND event_type <> 'error'"

MERGED = f"""
    WITH old AS (SELECT * FROM ({latest(f"(SELECT * FROM events WHERE {FIRST_HALF})")}) WHERE rn = 1 AND event_type <> 'error'),
         new AS (SELECT * FROM ({latest(f"(SELECT * FROM events WHERE {SECOND_HALF})")}) WHERE rn = 1)
    SELECT {EVENT_COLUMNS} FROM old WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.user_id = old.user_id)
    UNION ALL
    SELECT {EVENT_COLUMNS} FROM new WHERE event_type <> 'error'
"""

KEPT_LINES = """
    SELECT * FROM lineitem t WHERE NOT EXISTS (
        SELECT 1 FROM lineitem d
        WHERE d.l_returnflag = 'R' AND d.l_orderkey = t.l_orderkey AND d.l_linenumber = t.l_linenumber)
"""

CENTS = "CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR)"
BIG_KEY = f"o_orderkey || '{'0' * 16}'"
BIG_PRICE = f"{CENTS} || '{'0' * 22}'"
BAD_KEY = f"TRY_CAST({BIG_KEY} AS BIGINT) IS NULL"
BAD_PRICE = f"TRY_CAST({BIG_PRICE} AS DECIMAL(38,9)) IS NULL"

MOVED_SECONDS = "(CAST(epoch_us(o_orderdate) AS BIGINT) // 1000000 + 252534758400)"
LAST_SECOND = 253402300799

DECIMAL_TEXT = "CAST(CAST({0} AS DECIMAL(38,9)) AS VARCHAR)"
SECONDS = "strftime({0}, '%Y-%m-%d %H:%M:%S')"

CSV_EVENT = " || ',' || ".join(
    [
        """'"' || event_id || '"'""",
        SECONDS.format("ts"),
        """'"{""changes"":[]}"'""",
        "day(ts)",
        "user_id",
        "event_id",
        SECONDS.format("ts"),
        """'"' || event_type || '"'""",
        DECIMAL_TEXT.format("value"),
        """'"' || replace(props, '"', '""') || '"'""",
        f"""CASE WHEN event_type = 'error' THEN {SECONDS.format("ts")} ELSE '\\N' END""",
        "CASE WHEN event_type = 'error' THEN '1' ELSE '0' END",
    ]
)

JSON_EVENT = f"""
        CAST(json_object(
            'raw_id', CAST(event_id AS VARCHAR), 'extracted_at', {SECONDS.format('ts')}, 'meta', '{{"changes":[]}}',
            'generation_id', CAST(day(ts) AS VARCHAR), 'user_id', CAST(user_id AS VARCHAR), 'event_id', CAST(event_id AS VARCHAR),
            'ts', {SECONDS.format('ts')}, 'event_type', event_type, 'value', {DECIMAL_TEXT.format('value')}, 'props', props,
            'deleted_at', CASE WHEN event_type = 'error' THEN {SECONDS.format('ts')} END,
            'op', CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS VARCHAR)
"""

BATCHED = """
    SELECT *, (row_number() OVER (ORDER BY event_id) - 1) // 1000 AS batch_id,
           (row_number() OVER (ORDER BY event_id) - 1) % 1000 AS position FROM events
"""

LABELS = f"""
    SELECT batch_id, 'tablesync-activity-' || sha256(string_agg(line, chr(10) ORDER BY position) || chr(10)) AS label,
           count(*) AS row_count
    FROM (SELECT batch_id, position, event_id || ',' || user_id || ',"' || event_type || '","' ||
                 replace(props, '"', '""') || '"' AS line FROM ({BATCHED}))
    GROUP BY batch_id
"""

ACCOUNTS = f"""
    SELECT batch_id, count(*) AS buffered, count(*) FILTER (value >= 1) AS loaded, count(*) FILTER (value < 1) AS filtered,
           count(*) FILTER (value >= 1 AND event_type <> 'error') AS upserts,
           count(*) FILTER (value >= 1 AND event_type = 'error') AS deletes
    FROM ({BATCHED}) GROUP BY batch_id
"""

LINE_TEXT = """'"' || replace({0}, '"', '""') || '"'"""
DOCUMENT_LINE = "doc_id || ',' || " + " || ',' || ".join(
    [f"coalesce({LINE_TEXT.format(c)}, '\\N')" for c in ("text", "lang", "source")] + ["n_chars"]
)

# A row of the flushed log: of generation 0, and of a stream that is no change stream, so without operation column.
CSV_EVENT_ROW = CSV_EVENT.rsplit("|| ',' ||", 1)[0].replace("day(ts)", "'0'")

# Batches of the second run: those that the first one loaded are known.
FLUSHED = f"""
    SELECT batch_id, CASE WHEN batch_id < (SELECT greatest(1, count(*) // 1000 // 2) FROM events) THEN 'Label Already Exists' ELSE 'Success' END AS status
    FROM (SELECT DISTINCT batch_id FROM ({BATCHED}))
"""
OUTCOME = "CASE WHEN status = 'Success' THEN 'loaded' ELSE 'already_loaded' END"

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

ORACLES: dict[str, str] = {
    "cdc_hard_delete": SURVIVORS,
    "cdc_soft_delete": f"SELECT {EVENT_COLUMNS}, {ERROR_TS} AS deleted_at FROM ({latest()}) WHERE rn = 1",
    "soft_delete_live_rows": SURVIVORS,
    "dedup_upsert": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (
            SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
        WHERE rn = 1""",
    "append_keep_all": "SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_type = 'purchase'",
    "full_refresh_overwrite": """
        SELECT o_orderkey, o_custkey, lower(o_orderstatus) AS o_orderstatus,
               CAST(CAST(o_totalprice AS DECIMAL(38,9)) + 1 AS VARCHAR) AS o_totalprice, o_orderdate, o_orderpriority
        FROM orders""",
    "generation_refresh": """
        SELECT CAST(event_id AS VARCHAR) AS raw_id, CAST(2 AS BIGINT) AS generation_id, user_id, event_type, props FROM events""",
    "change_history": """
        SELECT event_id, user_id, ts, event_type, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to FROM events""",
    "cdc_sync_stored": f"""
        SELECT user_id, CAST(event_id AS VARCHAR) AS raw_id, event_id, ts, event_type, props
        FROM ({latest()}) WHERE rn = 1 AND event_type <> 'error'""",
    "last_event_per_key": f"SELECT {EVENT_COLUMNS} FROM ({latest()}) WHERE rn = 1",
    "last_event_window": f"SELECT {EVENT_COLUMNS} FROM ({latest()}) WHERE rn = 1",
    "last_event_composite_key": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (
                PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
                         l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
            FROM lineitem) WHERE rn = 1""",
    "order_ties": """
        SELECT user_id, event_type, hour, n AS n_tied FROM (
            SELECT user_id, event_type, date_trunc('hour', ts) AS hour, count(*) AS n,
                   row_number() OVER (PARTITION BY user_id, event_type ORDER BY date_trunc('hour', ts) DESC) AS rn
            FROM events GROUP BY user_id, event_type, date_trunc('hour', ts)) WHERE rn = 1 AND n > 1""",
    "op_code_per_record": """
        SELECT event_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS hard_op, 0 AS soft_op FROM events""",
    "route_operations": f"""
        SELECT user_id, event_id, CASE WHEN event_type = 'error' THEN 'delete' ELSE 'upsert' END AS route
        FROM ({latest()}) WHERE rn = 1""",
    "route_without_key": """
        SELECT user_id, event_id, CASE WHEN event_type = 'error' THEN 'delete' ELSE 'upsert' END AS route FROM events""",
    "upsert_by_key": """
        WITH u AS (SELECT l_orderkey AS o_orderkey, max(l_linestatus) AS o_orderstatus,
                          max(l_extendedprice) AS o_totalprice, max(l_shipdate) AS o_orderdate
                   FROM lineitem GROUP BY l_orderkey)
        SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders o
        WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.o_orderkey = o.o_orderkey)
        UNION ALL SELECT * FROM u""",
    "merge_upsert_delete": MERGED,
    "merge_large_batch": MERGED,
    "delete_by_key": KEPT_LINES,
    "delete_by_key_salted": KEPT_LINES,
    "order_safe_upsert": SURVIVORS,
    "cursor_increment": f"SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-16 00:00:00'",
    "validate_bigint": f"""
        SELECT o_orderkey, CAST(TRY_CAST({BIG_KEY} AS BIGINT) AS VARCHAR) AS kept, {meta('v', BAD_KEY)} AS meta FROM orders""",
    "validate_decimal": f"""
        SELECT o_orderkey, CAST(TRY_CAST({BIG_PRICE} AS DECIMAL(38,9)) AS VARCHAR) AS kept,
               {meta('v', BAD_PRICE)} AS meta FROM orders""",
    "validate_date": f"""
        SELECT o_orderkey, CASE WHEN {MOVED_SECONDS} <= {LAST_SECOND} THEN CAST({MOVED_SECONDS} // 86400 AS VARCHAR) END AS kept,
               {meta('v', f'{MOVED_SECONDS} > {LAST_SECOND}')} AS meta FROM orders""",
    "validate_timestamp": f"""
        SELECT o_orderkey, CASE WHEN s <= {LAST_SECOND} THEN CAST(s AS VARCHAR) END AS local_seconds,
               CASE WHEN s <= {LAST_SECOND} THEN CAST(s AS VARCHAR) END AS instant_seconds,
               CASE WHEN s <= {LAST_SECOND} THEN '{{"changes":[]}}'
                    ELSE '{{"changes":[' || {SIZE_CHANGE.format(field='local')} || ',' ||
                         {SIZE_CHANGE.format(field='instant')} || ']}}' END AS meta
        FROM (SELECT o_orderkey, {MOVED_SECONDS} AS s FROM orders)""",
    "validation_changes": f"""
        SELECT o_orderkey, CAST(TRY_CAST({BIG_KEY} AS BIGINT) AS VARCHAR) AS big_key,
               CAST(TRY_CAST({BIG_PRICE} AS DECIMAL(38,9)) AS VARCHAR) AS big_price,
               CASE WHEN {BAD_KEY} OR {BAD_PRICE} THEN '{{"sync":1,"changes":[' ||
                    concat_ws(',', CASE WHEN {BAD_KEY} THEN {SIZE_CHANGE.format(field='big_key')} END,
                                   CASE WHEN {BAD_PRICE} THEN {SIZE_CHANGE.format(field='big_price')} END) || ']}}'
                    ELSE '{{"sync":1,"changes":[]}}' END AS meta
        FROM orders""",
    "validation_report_per_column": f"""
        SELECT field, 'DESTINATION_FIELD_SIZE_LIMITATION' AS reason, count(*) AS nullified FROM (
            SELECT 'big_key' AS field FROM orders WHERE {BAD_KEY}
            UNION ALL SELECT 'big_price' FROM orders WHERE {BAD_PRICE})
        GROUP BY field""",
    "type_cast": f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
               {DECIMAL_TEXT.format('l_quantity')} AS l_quantity, {DECIMAL_TEXT.format('l_extendedprice')} AS l_extendedprice,
               {DECIMAL_TEXT.format('l_discount')} AS l_discount, l_returnflag, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate
        FROM lineitem""",
    "missing_fields": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_tax, l_linestatus FROM lineitem
        UNION ALL SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, NULL, NULL FROM lineitem""",
    "object_as_variant": """
        SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, '{"k":' || json_extract_string(props, '$.k') || '}' AS props
        FROM events""",
    "envelope_intake": f"""
        SELECT CAST(event_id AS VARCHAR) AS raw_id, epoch_us(ts) AS extracted_micros, '{{"changes":[]}}' AS meta,
               CAST(7 AS BIGINT) AS generation_id, user_id, event_id, ts, event_type, {DECIMAL_TEXT.format('value')} AS value, props
        FROM events""",
    "csv_encode": f"SELECT {CSV_EVENT} AS line FROM events",
    "csv_encode_documents": f"SELECT doc_id, {DOCUMENT_LINE} AS line FROM documents",
    "json_encode": f"SELECT {JSON_EVENT} AS line FROM events",
    "batch_bodies": f"""
        SELECT batch_id, 'tablesync-activity-' || sha256(text) AS label, row_count, text, true AS is_smaller FROM (
            SELECT batch_id, '[' || string_agg(line, ',' ORDER BY position) || ']' AS text, count(*) AS row_count
            FROM (SELECT batch_id, position, {JSON_EVENT} AS line FROM ({BATCHED})) GROUP BY batch_id)""",
    "sql_bind_strings": f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_partkey AS VARCHAR) AS l_partkey,
               CAST(l_suppkey AS VARCHAR) AS l_suppkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
               {DECIMAL_TEXT.format('l_quantity')} AS l_quantity, {DECIMAL_TEXT.format('l_extendedprice')} AS l_extendedprice,
               {DECIMAL_TEXT.format('l_discount')} AS l_discount, {DECIMAL_TEXT.format('l_tax')} AS l_tax,
               l_returnflag, l_linestatus, {SECONDS.format('l_shipdate')} AS l_shipdate
        FROM lineitem""",
    "batch_assign": f"SELECT event_id, batch_id, CAST(position AS INTEGER) AS position FROM ({BATCHED})",
    "batch_labels": LABELS,
    "batch_labels_by_row_digest": f"""
        SELECT batch_id, 'tablesync-documents-' || sha256(string_agg(digest, chr(10) ORDER BY digest) || chr(10)) AS label,
               count(*) AS row_count
        FROM (SELECT (row_number() OVER (ORDER BY doc_id) - 1) // 1000 AS batch_id, sha256({DOCUMENT_LINE}) AS digest
              FROM documents)
        GROUP BY batch_id""",
    "batch_assign_by_bytes": """
        SELECT doc_id, bytes, position, position // 200 + CAST(coalesce(before, 0) AS BIGINT) // 100000 AS batch_id FROM (
            SELECT doc_id, bytes, row_number() OVER (ORDER BY doc_id) - 1 AS position,
                   sum(bytes) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
            FROM (SELECT doc_id, CAST(octet_length(encode(text)) AS INTEGER) AS bytes FROM documents))""",
    "batch_assign_greedy": """
        WITH RECURSIVE sized AS (
            SELECT doc_id, CAST(octet_length(encode(text)) AS INTEGER) AS bytes, row_number() OVER (ORDER BY doc_id) - 1 AS position,
                   sum(coalesce(octet_length(encode(text)), 0)) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS after
            FROM documents),
        starts AS (
            SELECT CAST(0 AS BIGINT) AS first, CAST(0 AS BIGINT) AS batch_id
            UNION ALL
            SELECT min(n.position), s.batch_id + 1 FROM starts s JOIN sized f ON f.position = s.first
            JOIN sized n ON n.position > s.first AND (n.position >= s.first + 200 OR n.after > f.after - coalesce(f.bytes, 0) + 100000)
            GROUP BY s.batch_id)
        SELECT doc_id, bytes, position, batch_id FROM sized ASOF JOIN starts ON position >= first""",
    "ledger_dedup": f"""
        SELECT batch_id, label, row_count FROM ({LABELS}) WHERE batch_id NOT IN (
            SELECT batch_id FROM ({BATCHED}) GROUP BY batch_id HAVING max(ts) < TIMESTAMP '2024-01-16 00:00:00')""",
    "load_accounting": ACCOUNTS,
    "load_outcomes": f"SELECT batch_id, status, {OUTCOME} AS outcome FROM ({FLUSHED})",
    "batch_flush": f"""
        SELECT batch_id, 'tablesync-activity-' || sha256(string_agg(digest, '' ORDER BY chunk)) AS label, sum(n)::BIGINT AS buffered,
               sum(n)::BIGINT AS upserts, 0 AS deletes, any_value(status) AS status, any_value({OUTCOME}) AS outcome,
               sum(n)::BIGINT AS stored, min(first_event) AS first_event
        FROM (
            SELECT batch_id, position // 256 AS chunk, sha256(string_agg(sha256(line), '' ORDER BY position)) AS digest, count(*) AS n, min(event_id) AS first_event
            FROM (SELECT batch_id, position, event_id, {CSV_EVENT_ROW} AS line FROM ({BATCHED})) GROUP BY batch_id, chunk)
        JOIN ({FLUSHED}) USING (batch_id) GROUP BY batch_id""",
    "batch_tree_labels": f"""
        SELECT batch_id, 'tablesync-documents-' || sha256(string_agg(digest, '' ORDER BY chunk)) AS label, sum(n)::BIGINT AS row_count
        FROM (
            SELECT place // 1000 AS batch_id, place % 1000 // 64 AS chunk, sha256(string_agg(sha256(line), '' ORDER BY place)) AS digest, count(*) AS n
            FROM (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS place, {DOCUMENT_LINE} AS line FROM documents) GROUP BY ALL)
        GROUP BY batch_id""",
    "staged_refresh": """
        SELECT 'during' AS seen, 1::BIGINT AS generation_id, event_id::VARCHAR AS raw_id, user_id, event_type, props FROM events
        UNION ALL SELECT 'after', 2, event_id::VARCHAR, user_id, upper(event_type), props FROM events""",
    "history_stored": f"""
        SELECT event_id, user_id, ts, event_type, {DECIMAL_TEXT.format('value')} AS value, props,
               lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to FROM events""",
    "merge_changelog": f"""
        WITH old AS (SELECT * FROM ({latest(f"(SELECT * FROM events WHERE {FIRST_HALF})")}) WHERE rn = 1 AND event_type <> 'error'),
             new AS (SELECT * FROM ({latest(f"(SELECT * FROM events WHERE {SECOND_HALF})")}) WHERE rn = 1),
             pair AS (SELECT old.user_id IS NOT NULL AS had, new.event_type = 'error' AS gone, new.user_id AS k FROM new LEFT JOIN old USING (user_id))
        SELECT 'insert' AS change, user_id, event_id, ts, event_type, props FROM new JOIN pair ON k = user_id WHERE NOT had AND NOT gone
        UNION ALL SELECT 'update_after', user_id, event_id, ts, event_type, props FROM new JOIN pair ON k = user_id WHERE had AND NOT gone
        UNION ALL SELECT CASE WHEN gone THEN 'delete' ELSE 'update_before' END, user_id, event_id, ts, event_type, props
                  FROM old JOIN pair ON k = user_id
        UNION ALL SELECT 'copy', user_id, event_id, ts, event_type, props FROM ({MERGED})""",
    "quarantine": """
        SELECT conv_id || '-' || turn AS raw_id, CASE WHEN reason = 'loaded' THEN conv_id END AS conv_id, CASE WHEN reason = 'loaded' THEN turn END AS turn,
               CASE WHEN reason = 'loaded' THEN role END AS role,
               CASE reason WHEN 'loaded' THEN text
                           WHEN 'not JSON' THEN left(whole, length(whole) - 1)
                           WHEN 'not an object' THEN json_array(role, text)::VARCHAR
                           ELSE json_object('conv_id', conv_id, 'role', role, 'text', text)::VARCHAR END AS text, reason
        FROM (SELECT *, json_object('conv_id', conv_id, 'turn', turn, 'role', role, 'text', text)::VARCHAR AS whole,
                     CASE WHEN conv_id % 11 = 3 THEN 'not JSON' WHEN conv_id % 11 = 5 THEN 'not an object'
                          WHEN conv_id % 11 = 7 AND turn = 0 THEN 'no key' ELSE 'loaded' END AS reason FROM conversations)""",
    "json_encode_number_text": """
        SELECT json_object('raw_id', l_orderkey || '-' || l_linenumber, 'extracted_at', '2024-01-01 00:00:00', 'meta', '{"changes":[]}',
                           'generation_id', '0', 'l_orderkey', l_orderkey::VARCHAR,
                           'price', round(l_extendedprice * 100)::BIGINT || '.' || lpad(l_partkey::VARCHAR, 15, '0'))::VARCHAR AS line
        FROM lineitem""",
    "stream_growing_schema": f"""
        SELECT user_id, event_id, ts, event_type, {DECIMAL_TEXT.format('value')} AS value, props, event_id::VARCHAR AS raw_id,
               CASE WHEN event_id % 8 >= 4 THEN json_object('n', event_id % 8, 'name', event_type)::VARCHAR END AS channel
        FROM ({latest('(SELECT * FROM events WHERE event_id % 97 <> 0)')}) WHERE rn = 1 AND event_type <> 'error'
        UNION ALL SELECT NULL, count(*), NULL, 'not JSON', NULL, NULL, NULL, NULL FROM events WHERE event_id % 97 = 0""",
    "count_rows": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES),
    "max_generation": "SELECT max(day(ts)) AS generation_id FROM events",
    "initial_status": """
        SELECT 'events' AS table_name, true AS table_exists, count(*) AS row_count, max(day(ts)) AS generation_id FROM events
        UNION ALL SELECT 'orders', true, count(*), max(year(o_orderdate)) FROM orders
        UNION ALL SELECT 'customer', true, count(*), 0 FROM customer
        UNION ALL SELECT 'no_events', true, count(*), 0 FROM events WHERE day(ts) > 31
        UNION ALL SELECT 'not_there', false, 0, 0""",
    "copy_table": """
        SELECT CAST(c_custkey AS VARCHAR) AS raw_id, CAST(0 AS BIGINT) AS generation_id, c_custkey, c_name,
               CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer""",
    "evolve_add_drop": """
        SELECT CAST(o_orderkey AS VARCHAR) AS raw_id, o_custkey, o_orderkey, o_orderstatus, o_orderdate,
               CAST(NULL AS VARCHAR) AS o_comment FROM orders""",
    "evolve_retype": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS raw_id, {DECIMAL_TEXT.format('o_custkey')} AS o_custkey,
               CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, {SECONDS.format('o_orderdate')} AS o_orderdate,
               CAST(TRY_CAST(o_orderpriority AS BIGINT) AS VARCHAR) AS o_orderpriority, CAST(NULL AS VARCHAR) AS o_note
        FROM orders""",
    "evolve_stored": f"""
        SELECT o_custkey, o_year, count(*) AS orders FROM (
            SELECT {DECIMAL_TEXT.format('o_custkey')} AS o_custkey, CAST(NULL AS VARCHAR) AS o_year FROM orders
            UNION ALL SELECT {DECIMAL_TEXT.format('o_custkey')}, CAST(year(o_orderdate) AS VARCHAR) FROM orders)
        GROUP BY o_custkey, o_year""",
    "stream_append": "SELECT * FROM events",
    "stream_upsert": f"""
        SELECT user_id, event_id, ts, event_type, props FROM ({latest()}) WHERE rn = 1 AND event_type <> 'error'""",
}
