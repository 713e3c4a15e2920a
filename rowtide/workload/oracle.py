"""DuckDB SQL for the result of each query."""

from __future__ import annotations

from rowtide.workload.tables import EVENTS_CUT, FULFILMENT_DAYS, ORDERS_CUT, TOPIC_PARTITIONS

_N = TOPIC_PARTITIONS
_EVENT_OP = "CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END"
_ORDER_OP = "CASE o_orderstatus WHEN 'O' THEN 'c' WHEN 'P' THEN 'u' ELSE 'd' END"
_PARTITION = f"CAST(user_id % {_N} AS INTEGER)"

_RECORD = f"""
SELECT {_PARTITION} AS partition, event_id AS "offset",
       '{{"id":' || user_id || '}}' AS key, ts AS kafka_timestamp
FROM events"""

_CHANGE = f"""
SELECT user_id AS id, event_type AS name, value, ts AS created_at, {_EVENT_OP} AS "__op",
       ts AS kafka_timestamp, {_PARTITION} AS partition, event_id AS "offset"
FROM events"""

_ORDER = f"""
SELECT o_custkey AS id, o_orderpriority AS name, o_totalprice AS price, o_orderdate AS created_at,
       {_ORDER_OP} AS "__op", o_orderdate AS kafka_timestamp, CAST(0 AS INTEGER) AS partition,
       o_orderkey AS "offset"
FROM orders"""


def _latest(rows: str, where: str = "TRUE") -> str:
    return f"""
SELECT * FROM ({rows}) AS c WHERE {where}
QUALIFY row_number() OVER (PARTITION BY id ORDER BY kafka_timestamp DESC, partition DESC, "offset" DESC) = 1"""


_EVENT_STATE = f"SELECT id, name, value, created_at FROM ({_latest(_CHANGE)}) WHERE \"__op\" <> 'd'"

_BEFORE = f"kafka_timestamp < TIMESTAMP '{ORDERS_CUT}'"
_OLD_STATE = f"SELECT id, name, price, created_at FROM ({_latest(_ORDER, _BEFORE)}) WHERE \"__op\" <> 'd'"
_NEW_STATE = f"SELECT id, name, price, created_at FROM ({_latest(_ORDER)}) WHERE \"__op\" <> 'd'"
_INCOMING = _latest(_ORDER, f"NOT ({_BEFORE})")

_MERGED = f"""
SELECT coalesce(s.id, c.id) AS id,
       CASE WHEN c.id IS NULL THEN s.name ELSE c.name END AS name,
       CASE WHEN c.id IS NULL THEN s.price ELSE c.price END AS price,
       CASE WHEN c.id IS NULL THEN s.created_at ELSE c.created_at END AS created_at
FROM ({_OLD_STATE}) AS s FULL JOIN ({_INCOMING}) AS c ON s.id = c.id
WHERE c.id IS NULL OR c."__op" <> 'd'"""

_SENT = f"o_orderdate < TIMESTAMP '{ORDERS_CUT}'"
_LOG_OP = "CASE o_orderstatus WHEN 'O' THEN 'I' WHEN 'P' THEN 'U' ELSE 'D' END"

_ENVELOPE = f"""
SELECT o_orderkey AS change_id, o_orderdate AS changed_at, o_custkey AS id,
       CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN '' ELSE o_orderpriority END AS name,
       o_totalprice AS price, o_orderdate AS created_at, {_ORDER_OP} AS "__op",
       epoch_us(o_orderdate) // 1000 AS "__source_ts_ms",
       CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END AS "__deleted"
FROM orders"""

_POLLED = f"""
SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 'fulfilled' ELSE 'open' END AS name,
       o_totalprice AS price, o_orderdate AS created_at,
       CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL {FULFILMENT_DAYS} DAY
            ELSE o_orderdate END AS updated_at
FROM orders"""

_SPOILT = """CASE WHEN value <= 100 THEN NULL WHEN event_type IN ('signup', 'view') THEN 'unknown_op'
     WHEN event_type IN ('click', 'purchase') THEN 'no_key' ELSE 'tombstone' END"""

_DIFF = f"({_OLD_STATE}) AS b FULL JOIN ({_NEW_STATE}) AS a ON a.id = b.id"
_CHANGED = "(a.name IS DISTINCT FROM b.name OR a.price IS DISTINCT FROM b.price OR a.created_at IS DISTINCT FROM b.created_at)"

_RECONCILED = f"""
SELECT coalesce(a.id, b.id) AS id,
       CASE WHEN b.id IS NULL THEN 'missing' WHEN a.id IS NULL THEN 'extra' ELSE 'different' END AS status,
       CASE WHEN a.id IS NOT NULL AND b.id IS NOT NULL THEN concat_ws(',',
            CASE WHEN a.name IS DISTINCT FROM b.name THEN 'name' END,
            CASE WHEN a.price IS DISTINCT FROM b.price THEN 'price' END,
            CASE WHEN a.created_at IS DISTINCT FROM b.created_at THEN 'created_at' END) END AS columns
FROM {_DIFF} WHERE a.id IS NULL OR b.id IS NULL OR {_CHANGED}"""

_POINTS = f'SELECT {_PARTITION} AS partition, max(event_id) + 1 AS next_offset FROM events GROUP BY 1'
_ALL_POINTS = f"""
SELECT CAST(p.partition AS INTEGER) AS partition, coalesce(o.next_offset, -2) AS next_offset
FROM range({_N + 2}) AS p(partition) LEFT JOIN ({_POINTS}) AS o ON o.partition = p.partition"""

_LOG_BRIEF = f"""
SELECT o_orderkey AS change_id, {_LOG_OP} AS operation, o_custkey AS record_id, o_orderdate AS changed_at
FROM orders"""

ORACLE: dict[str, str] = {
    "resume_points": _POINTS,
    "resume_points_all": _ALL_POINTS,
    "starting_offsets": f"""
SELECT '{{"events":{{' || string_agg('"' || partition || '":' || next_offset, ',' ORDER BY partition) || '}}}}'
       AS starting_offsets
FROM ({_ALL_POINTS})""",
    "land_incremental": f"{_RECORD} WHERE ts >= TIMESTAMP '{EVENTS_CUT}'",
    "land_slices": _RECORD,
    "topic_peek": f'{_RECORD} ORDER BY partition, "offset" LIMIT 10',
    "publish_order": f"""
SELECT event_id, {_PARTITION} AS partition,
       row_number() OVER (PARTITION BY user_id % {_N} ORDER BY ts, event_id) - 1 AS "offset"
FROM events""",
    "parse_envelope": _CHANGE,
    "parse_iso_envelope": f"""
SELECT change_id AS "offset", changed_at AS kafka_timestamp, id, name, price, created_at, "__op",
       "__source_ts_ms", "__deleted"
FROM ({_ENVELOPE})""",
    "quarantine": f"""
SELECT * FROM (SELECT {_PARTITION} AS partition, event_id AS "offset", {_SPOILT} AS reject FROM events)
WHERE reject <> 'tombstone'""",
    "accepted_of_faulty": f"{_CHANGE} WHERE value <= 100",
    "materialize_quarantine": f"""
SELECT partition, "offset", reject, count(*) OVER (PARTITION BY reject) AS n
FROM (SELECT {_PARTITION} AS partition, event_id AS "offset", {_SPOILT} AS reject FROM events)
WHERE reject <> 'tombstone'""",
    "materialize_counts": f"""
SELECT kind, count(reject) AS n
FROM (VALUES ('accepted'), ('no_key'), ('unknown_op'), ('tombstone')) AS k(kind)
LEFT JOIN (SELECT coalesce({_SPOILT}, 'accepted') AS reject FROM events) ON reject = kind GROUP BY kind""",
    "state_new_column": f"""
SELECT id, name, CASE WHEN kafka_timestamp >= TIMESTAMP '{EVENTS_CUT}' THEN value END AS value, created_at
FROM ({_latest(_CHANGE)}) WHERE "__op" <> 'd'""",
    "unwrap_nested": f"""
SELECT ts AS kafka_timestamp, {_PARTITION} AS partition, event_id * 2 AS "offset", user_id AS id,
       event_type AS name, value, ts AS created_at, {_EVENT_OP} AS "__op", epoch_us(ts) // 1000 AS "__source_ts_ms",
       CASE WHEN event_type = 'error' THEN 'true' ELSE 'false' END AS "__deleted"
FROM events""",
    "time_parse": """
SELECT event_id, ts AS exact, date_trunc('second', ts) AS whole_second, ts AS iso_micros,
       make_timestamp(epoch_us(ts) // 100 * 100) AS iso_short, date_trunc('second', ts) AS iso_plain,
       ts AS iso_zone, CAST(NULL AS TIMESTAMP) AS iso_empty,
       CAST(NULL AS TIMESTAMP) AS iso_time, CAST(NULL AS TIMESTAMP) AS iso_year,
       CAST(NULL AS TIMESTAMP) AS iso_day, CAST(NULL AS TIMESTAMP) AS iso_junk
FROM events""",
    "latest_change": _latest(_CHANGE),
    "latest_order": _latest(_ORDER),
    "latest_by_offset": f"""
SELECT * REPLACE (TIMESTAMP '{EVENTS_CUT}' AS kafka_timestamp) FROM ({_CHANGE})
QUALIFY row_number() OVER (PARTITION BY id ORDER BY partition DESC, "offset" DESC) = 1""",
    "initial_state": _EVENT_STATE,
    "tombstone_delete": _EVENT_STATE,
    "tombstone_ignore": f"SELECT id, name, value, created_at FROM ({_latest(_CHANGE, chr(34) + '__op' + chr(34) + ' <> ' + chr(39) + 'd' + chr(39))})",
    "merge_apply": _MERGED,
    "merge_lookup": _MERGED,
    "merge_action_counts": f"""
SELECT CASE WHEN c.id IS NULL THEN 'untouched' WHEN s.id IS NOT NULL AND c."__op" = 'd' THEN 'delete'
            WHEN s.id IS NOT NULL THEN 'update' WHEN c."__op" = 'd' THEN 'ignored' ELSE 'insert' END AS action,
       count(*) AS n
FROM ({_OLD_STATE}) AS s FULL JOIN ({_INCOMING}) AS c ON s.id = c.id GROUP BY 1""",
    "late_changes": _NEW_STATE,
    "changelog_pending": f"{_LOG_BRIEF} WHERE NOT ({_SENT}) ORDER BY o_orderdate, o_orderkey LIMIT 100",
    "changelog_pending_all": f"{_LOG_BRIEF} WHERE NOT ({_SENT})",
    "changelog_to_envelope": f"""
SELECT * REPLACE (strftime(created_at, '%Y-%m-%dT%H:%M:%S') AS created_at) FROM ({_ENVELOPE})""",
    "backlog": f"SELECT {_SENT} AS processed, count(*) AS n FROM orders GROUP BY 1",
    "recent_changes": f"{_LOG_BRIEF} ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 10",
    "recent_change_ids": f"""
SELECT o_orderkey AS change_id, {_LOG_OP} AS operation, o_custkey AS record_id
FROM orders ORDER BY o_orderkey DESC LIMIT 10""",
    "captured_tables": f"""
SELECT o_orderkey AS change_id, 'orders_' || substr(o_orderpriority, 1, 1) AS table_name,
       {_LOG_OP} AS operation, o_custkey AS record_id
FROM orders WHERE substr(o_orderpriority, 1, 1) IN ('1', '2')""",
    "purged_log": f"""
SELECT o_orderkey AS change_id, o_orderdate AS changed_at, {_SENT} AS processed
FROM orders WHERE NOT ({_SENT} AND o_orderdate < TIMESTAMP '1999-01-01')""",
    "op_codes": """
SELECT translate(o_orderstatus, 'OPF', 'IUX') AS log_op,
       CASE o_orderstatus WHEN 'O' THEN 'c' WHEN 'P' THEN 'u' ELSE 'X' END AS op, count(*) AS n
FROM orders GROUP BY 1, 2""",
    "polled_changes": f"SELECT * FROM ({_POLLED}) WHERE updated_at > TIMESTAMP '{ORDERS_CUT}'",
    "polled_overlap": f"""
SELECT * FROM ({_POLLED}) WHERE updated_at >= TIMESTAMP '{ORDERS_CUT}' - INTERVAL 30 DAY""",
    "poll_ops": """
SELECT id, name, price, epoch_us(CASE WHEN created_at IS NULL THEN updated_at ELSE created_at END) AS created_at,
       CASE WHEN epoch_us(updated_at) - epoch_us(created_at) < 1000000 THEN 'c' ELSE 'u' END AS "__op",
       epoch_us(updated_at) AS "__source_ts_ms", 'false' AS "__deleted"
FROM (SELECT o_orderkey AS id, o_orderpriority AS name, o_totalprice AS price,
             CASE WHEN o_orderstatus <> 'F' THEN o_orderdate END AS created_at,
             o_orderdate + CASE WHEN o_orderstatus = 'O' THEN INTERVAL 999999 MICROSECOND
                                ELSE INTERVAL 1 SECOND END AS updated_at
      FROM orders)""",
    "poll_watermark": f"""
SELECT greatest(max(updated_at), TIMESTAMP '{ORDERS_CUT}') AS last_polled
FROM ({_POLLED}) WHERE updated_at > TIMESTAMP '{ORDERS_CUT}'""",
    "source_by_recency": f"SELECT id, updated_at FROM ({_POLLED}) ORDER BY updated_at DESC, id",
    "snapshot_envelope": """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS value, 'r' AS "__op",
       epoch_ms(TIMESTAMP '2023-12-31') AS "__source_ts_ms", 'false' AS "__deleted"
FROM customer""",
    "snapshot_diff": f"""
SELECT 'orders' AS table_name,
       CASE WHEN b.id IS NULL THEN 'I' WHEN a.id IS NULL THEN 'D' ELSE 'U' END AS operation,
       coalesce(b.id, a.id) AS record_id, b.price AS old_price, a.price AS new_price, b.name AS old_name,
       a.name AS new_name, a.created_at AS new_created_at, TIMESTAMP '{ORDERS_CUT}' AS changed_at,
       FALSE AS processed
FROM {_DIFF} WHERE a.id IS NULL OR b.id IS NULL OR {_CHANGED}""",
    "reconcile_rows": _RECONCILED,
    "reconcile_digest": _RECONCILED,
    "capture_lag": """
SELECT CAST(date_trunc('day', arrived) AS TIMESTAMP) AS start, count(*) AS n, quantile_disc(lag, 0.5) AS p50, quantile_disc(lag, 0.95) AS p95,
       quantile_disc(lag, 0.99) AS p99, max(lag) AS most
FROM (SELECT event_id % 51 * 100 AS lag, ts + to_milliseconds(event_id % 51 * 100) AS arrived FROM events) GROUP BY 1""",
    "reconcile_summary": f"SELECT status, count(*) AS n FROM ({_RECONCILED}) GROUP BY 1",
    "op_mix": f"""
SELECT {_PARTITION} AS partition, {_EVENT_OP} AS "__op", count(*) AS n, min(ts) AS first_at, max(ts) AS last_at
FROM events GROUP BY 1, 2""",
    "log_capture": f"""
SELECT id, name, value, created_at FROM ({_EVENT_STATE})
UNION ALL
SELECT c_custkey, c_name, c_acctbal, NULL FROM customer
WHERE c_custkey NOT IN (SELECT user_id FROM events)""",
    "trigger_capture": f"""
SELECT id, name, price, created_at FROM ({_ENVELOPE})
QUALIFY row_number() OVER (PARTITION BY id ORDER BY changed_at DESC, change_id DESC) = 1 AND "__op" <> 'd'""",
    "polling_capture": f"SELECT id, name, price, created_at FROM ({_POLLED})",
    "drain_captured": """
SELECT '{"id":' || o_custkey || '}' AS key, count(*) AS n
FROM orders WHERE substr(o_orderpriority, 1, 1) IN ('1', '2') GROUP BY 1""",
    "drain_late_commit": f"SELECT o_orderkey AS change_id, o_orderdate AS changed_at FROM orders WHERE {_SENT}",
    "snapshot_chunks": f"""
SELECT p.id, p.name, p.price, p.created_at FROM ({_POLLED}) AS p JOIN orders ON o_orderkey = p.id
WHERE o_orderstatus <> 'P'""",
    "poll_deletes": f"""
SELECT p.id, p.name, p.price, p.created_at FROM ({_POLLED}) AS p JOIN orders ON o_orderkey = p.id
WHERE o_orderpriority NOT IN ('4-NOT SPECIFIED', '5-LOW')""",
    "drain_closed_days": f"""
SELECT o_orderkey AS change_id, CASE WHEN {_SENT} THEN 'missed' ELSE 'sent' END AS fate
FROM orders WHERE NOT ({_SENT}) OR o_orderpriority = '5-LOW'""",
    "poll_from_initial": f"SELECT * FROM ({_POLLED}) WHERE updated_at > TIMESTAMP '{ORDERS_CUT}'",
    "poll_iso": """
SELECT o_orderkey AS id, CASE WHEN o_orderstatus <> 'F' THEN o_orderdate
       ELSE o_orderdate + INTERVAL 1 SECOND END AS created_at FROM orders""",
    "changelog_micros": f'SELECT change_id AS "offset", id, created_at FROM ({_ENVELOPE})',
    "state_by_offset": f"""
SELECT id, name, value, created_at FROM (
    SELECT * FROM ({_CHANGE}) QUALIFY row_number() OVER (PARTITION BY id ORDER BY partition DESC, "offset" DESC) = 1)
WHERE "__op" <> 'd'""",
    "stream_land": _RECORD,
    "stream_land_repeated": _RECORD,
    "stream_upsert": _EVENT_STATE,
    "stream_drain": f"""
SELECT id, name, price, created_at, "__op", "__source_ts_ms", "__deleted" FROM ({_ENVELOPE})""",
}
