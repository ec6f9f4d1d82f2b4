"""DuckDB SQL equivalent to each catalogue query, over the same ``events`` table.

The replayed topic's records are derived from ``events`` by fixed rules, so
each streaming result has a batch SQL equivalent: event time is ``ts``
truncated to the second, ``item`` is ``event_type``, ``quantity`` is
``floor(value)``; micro-batch ``b`` is ``clamp(event_id*4 // N, 0, 3)`` (late
fixture: plus 1 or 2 batches for ids with residue 7 or 8 modulo 50).
"""

from __future__ import annotations

from tideline.plans.catalog import DELAY, SLIDE_SIZE, SLIDE_STEP, SUM_SIZE, SUM_STEP, TUMBLE
from tideline.sources.replay import DEFAULT_PARTITIONS, EVEN, LATE

_N = "(SELECT count(*) FROM events)"


def _batch(rule) -> str:
    return rule.duckdb_sql(0).replace("// 0", f"// {_N}")


B_EVEN = _batch(EVEN)
B_LATE = _batch(LATE)
ET = "date_trunc('second', ts)"
QTY = "TRY_CAST(floor(value) AS INTEGER)"
USER = "CAST(user_id AS BIGINT)"
NARROW_USER = "TRY_CAST(user_id AS INTEGER)"  # of the fixture of bad records
TS_TEXT = (
    "CAST(epoch_us(ts) // 1000000 AS VARCHAR) || '.' || "
    "lpad(CAST(epoch_us(ts) % 1000000 AS VARCHAR), 6, '0')"
)
EPOCH = "(epoch_us(ts) / 1e6)"


def _micros(duration: str) -> int:
    n, unit = duration.split()
    scale = {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600, "hours": 3600, "day": 86400}[unit]
    return int(n) * scale * 1_000_000


def _interval(duration: str) -> str:
    return f"INTERVAL '{duration}'"


def _window_rows(size: str, slide: str | None, cols: str) -> str:
    """Rows of events expanded to the windows containing them: (start, end, cols)."""
    step = _micros(slide or size)
    width = _micros(size)
    parts = []
    for k in range(width // step):
        start = f"make_timestamp((epoch_us({ET}) // {step}) * {step} - {k * step})"
        parts.append(
            f"SELECT {start} AS start, {start} + {_interval(size)} AS \"end\", {cols} FROM events"
        )
    return " UNION ALL ".join(parts)


def _json_value() -> str:
    fields = [
        f"'\"timestamp\":' || {TS_TEXT}",
        f"CASE WHEN user_id IS NOT NULL THEN '\"user_id\":' || CAST({USER} AS VARCHAR) END",
        "CASE WHEN event_type IS NOT NULL THEN '\"item\":' || CAST(to_json(event_type) AS VARCHAR) END",
        f"CASE WHEN value IS NOT NULL THEN '\"quantity\":' || CAST({QTY} AS VARCHAR) END",
    ]
    return "'{' || concat_ws(',', " + ", ".join(fields) + ") || '}'"


ITEM_COUNTS = "SELECT event_type AS item, count(*) AS count FROM events GROUP BY event_type"


def _with_batches(n: int) -> str:
    """Item counts of a query that ran ``n`` micro-batches."""
    return f"SELECT *, CAST({n} AS BIGINT) AS batches FROM ({ITEM_COUNTS})"


CHANGELOG = f"""
WITH c AS (SELECT {B_EVEN} AS b, event_type, count(*) AS n FROM events GROUP BY ALL)
SELECT CAST(b AS BIGINT) AS batch_id, event_type AS item,
       CAST(sum(n) OVER (PARTITION BY event_type ORDER BY b) AS BIGINT) AS count
FROM c"""

RECORDS = f"SELECT event_id AS offset, {USER} AS user_id, event_type AS item, {QTY} AS quantity FROM events"

WATERMARK = f"""
SELECT start, "end", item, count(item) AS item_count
FROM ({_window_rows(TUMBLE, None, 'event_type AS item')}) w
GROUP BY start, "end", item
HAVING "end" <= (SELECT max({ET}) FROM events) - {_interval(DELAY)}"""

LATE_DATA = f"""
WITH r AS (SELECT {ET} AS et, event_type, {B_LATE} AS b FROM events),
w AS (SELECT b, event_type,
             make_timestamp((epoch_us(et) // {_micros(TUMBLE)}) * {_micros(TUMBLE)}) AS start
      FROM r),
m AS (SELECT b, max(et) AS m FROM r GROUP BY b),
wm AS (SELECT x.b, (SELECT max(y.m) - {_interval(DELAY)} FROM m y WHERE y.b <= x.b - 2) AS late
       FROM m x)
SELECT start, start + {_interval(TUMBLE)} AS "end", event_type AS item, count(event_type) AS item_count
FROM w JOIN wm USING (b)
WHERE late IS NULL OR start + {_interval(TUMBLE)} > late
GROUP BY start, event_type
HAVING start + {_interval(TUMBLE)} <= (SELECT max(m) - {_interval(DELAY)} FROM m)"""

_R = "event_id % 10"
BAD_TYPES = f"""
SELECT event_id AS offset,
  CASE WHEN {_R} IN (0, 1, 2) THEN NULL ELSE {ET} END AS timestamp,
  CASE WHEN {_R} IN (0, 1, 2, 4) THEN NULL ELSE {NARROW_USER} END AS user_id,
  CASE WHEN {_R} IN (1, 2, 3) THEN NULL ELSE event_type END AS item,
  CASE WHEN {_R} IN (1, 2, 4) THEN NULL ELSE {QTY} END AS quantity
FROM events"""

_RULE_FAILS = {
    "json": f"{_R} IN (0, 1, 4)",
    "timestamp": f"{_R} IN (0, 1, 2)",
    "user": f"{_R} IN (0, 1, 2, 4)",
    "item": f"{_R} IN (1, 2, 3)",
    "quantity": f"({_R} IN (1, 2, 4) OR {QTY} <= 0)",
}
_REASONS = "concat_ws(',', " + ", ".join(
    f"CASE WHEN {cond} THEN '{name}' END" for name, cond in _RULE_FAILS.items()
) + ")"

VALID_GOOD = f"""
SELECT event_id AS offset, {ET} AS timestamp, {NARROW_USER} AS user_id, event_type AS item, {QTY} AS quantity
FROM events WHERE {_REASONS} = ''"""

VALID_BAD = f"SELECT event_id AS offset, {_REASONS} AS reasons FROM events WHERE {_REASONS} <> ''"

HISTORY = f"""
WITH c AS (SELECT DISTINCT {B_EVEN} AS b, event_type FROM events),
f AS (SELECT event_type, min(b) AS fb FROM c GROUP BY event_type)
SELECT CAST(c.b AS BIGINT) AS version, CAST(c.b AS BIGINT) AS batch_id, 'MERGE' AS operation,
       CAST(sum(CASE WHEN f.fb = c.b THEN 1 ELSE 0 END) AS BIGINT) AS rows_inserted,
       CAST(sum(CASE WHEN f.fb < c.b THEN 1 ELSE 0 END) AS BIGINT) AS rows_updated
FROM c JOIN f USING (event_type) GROUP BY c.b"""

OFFSETS = f"""
WITH m AS (SELECT {B_EVEN} AS b, max({ET}) AS m FROM events GROUP BY ALL),
k AS (SELECT b AS k FROM m UNION ALL SELECT max(b) + 1 FROM m)
SELECT CAST(k AS BIGINT) AS batch_id, 0 AS source_index,
       CAST(least(k, (SELECT max(b) FROM m)) AS BIGINT) AS log_offset,
       CAST(coalesce((SELECT epoch_ms(max(m.m)) FROM m WHERE m.b < k.k)
                     - {_micros(DELAY) // 1000}, 0) AS BIGINT) AS watermark_ms,
       true AS committed
FROM k"""

ORACLES: dict[str, str] = {
    "kafka_envelope_scan": """SELECT CAST(user_id AS VARCHAR) AS key, props AS value, event_type AS topic,
        event_id AS "offset", ts AS timestamp FROM events""",
    "decode_kv": f"SELECT CAST(NULL AS VARCHAR) AS key, {_json_value()} AS value, event_id AS offset FROM events",
    "decode_messages": """SELECT CAST(user_id AS VARCHAR) AS key, event_id AS offset,
        CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""",
    "null_item_counts": f"""SELECT CASE WHEN {_R} IN (1, 2, 3) THEN NULL ELSE event_type END AS item,
        count(*) AS rows,
        count(CASE WHEN {_R} IN (1, 2, 3) THEN NULL ELSE event_type END) AS item_count
        FROM events GROUP BY 1""",
    "start_earliest": f"SELECT CAST(event_id % {DEFAULT_PARTITIONS} AS INTEGER) AS partition, event_id AS offset FROM events",
    "start_latest": f"""SELECT CAST(event_id % {DEFAULT_PARTITIONS} AS INTEGER) AS partition, event_id AS offset
        FROM events WHERE {B_EVEN} = 3""",
    "table_scan": "SELECT * FROM events",
    "parse_transactions": f"""SELECT event_id AS offset, {EPOCH} AS timestamp, {USER} AS user_id,
        event_type AS item, {QTY} AS quantity FROM events""",
    "event_time": f"""SELECT event_id AS offset, {ET} AS timestamp, {USER} AS user_id,
        event_type AS item, {QTY} AS quantity FROM events""",
    "parse_bad_types": BAD_TYPES,
    "item_counts": ITEM_COUNTS,
    "mode_complete": _with_batches(4),
    "trigger_once": _with_batches(1),
    "trigger_default": _with_batches(4),
    "trigger_interval": _with_batches(4),
    "memory_table_sql": ITEM_COUNTS,
    "foreach_batch_counts": _with_batches(4),
    "checkpoint_resume": f"""SELECT *, (SELECT count(*) FROM events WHERE {B_EVEN} >= 2) AS rows_after FROM ({ITEM_COUNTS})""",
    "mode_update_changelog": CHANGELOG,
    "kafka_sink_records": f"""SELECT item AS key,
        '{{"item":' || CAST(to_json(item) AS VARCHAR) || ',"count":' || CAST(count AS VARCHAR) || '}}' AS value
        FROM ({CHANGELOG}) c""",
    "upsert_replace": ITEM_COUNTS,
    "upsert_add_batch": ITEM_COUNTS,
    "upsert_add_running": f"SELECT item, CAST(sum(count) AS BIGINT) AS count FROM ({CHANGELOG}) c GROUP BY item",
    "table_history": HISTORY,
    "table_complete": ITEM_COUNTS,
    "mode_append": RECORDS,
    "table_append": RECORDS,
    "file_sink_json": RECORDS,
    "file_sink_csv": RECORDS,
    "file_sink_parquet": RECORDS,
    "foreach_rows": RECORDS,
    "tumbling_count": f"""SELECT start, "end", item, count(item) AS item_count
        FROM ({_window_rows(TUMBLE, None, 'event_type AS item')}) w GROUP BY ALL""",
    "tumbling_avg": f"""SELECT start, "end", item, avg(quantity) AS avg_quantity, avg(user_id) AS avg_user_id
        FROM ({_window_rows(TUMBLE, None, f'event_type AS item, {QTY} AS quantity, {USER} AS user_id')}) w GROUP BY ALL""",
    "sliding_count": f"""SELECT start, "end", item, count(item) AS item_count
        FROM ({_window_rows(SLIDE_SIZE, SLIDE_STEP, 'event_type AS item')}) w GROUP BY ALL""",
    "sliding_sum": f"""SELECT start, "end", item, CAST(sum(quantity) AS BIGINT) AS sum_quantity
        FROM ({_window_rows(SUM_SIZE, SUM_STEP, f'event_type AS item, {QTY} AS quantity')}) w GROUP BY ALL""",
    "watermark_append": WATERMARK,
    "watermark_append_rocksdb": f"SELECT *, 'RocksDBStateStoreProvider' AS store FROM ({WATERMARK})",
    "tumbling_append": WATERMARK,
    "memory_append": WATERMARK,
    "sliding_append": f"""SELECT start, "end", item, count(item) AS item_count
        FROM ({_window_rows(SLIDE_SIZE, SLIDE_STEP, 'event_type AS item')}) w GROUP BY ALL
        HAVING "end" <= (SELECT max({ET}) FROM events) - {_interval(DELAY)}""",
    "null_item_windows": f"""WITH f AS ({BAD_TYPES}), w AS (
        SELECT make_timestamp((epoch_us(timestamp) // {_micros(TUMBLE)}) * {_micros(TUMBLE)}) AS start, item
        FROM f WHERE timestamp IS NOT NULL)
        SELECT start, start + {_interval(TUMBLE)} AS "end", item, count(*) AS rows, count(item) AS item_count
        FROM w GROUP BY ALL""",
    "late_data_append": LATE_DATA,
    "approx_users_stream": "SELECT event_type AS item, count(DISTINCT user_id) AS exact, true AS within_3_rsd FROM events GROUP BY event_type",
    "distinct_users_batch": f"""SELECT event_type AS item, count(DISTINCT {USER}) AS distinct_users
        FROM events GROUP BY event_type""",
    "dedup_batch": f"""SELECT * EXCLUDE (rn) FROM (
        SELECT event_id AS offset, {ET} AS timestamp, {USER} AS user_id, event_type AS item,
               {QTY} AS quantity, CAST({B_EVEN} AS BIGINT) AS batch_id,
               row_number() OVER (PARTITION BY {B_EVEN}, {USER}, event_type
                                  ORDER BY {ET}, event_id) AS rn
        FROM events) WHERE rn = 1""",
    "validate_good": VALID_GOOD,
    "validate_quarantine": VALID_BAD,
    "checkpoint_offsets": OFFSETS,
}
ORACLES["tumbling_complete"] = ORACLES["tumbling_count"]
