"""The named queries once more, as SQL for an independent engine that reads the same tables."""

from __future__ import annotations

from fraudlens import schemas as s


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


TX = f"""tx AS (
  SELECT event_id, 'TX' || event_id AS transaction_id, 'C' || user_id AS customer_id,
         CAST(round(value * 100000) AS BIGINT) AS amount,
         {_list(s.LOCATIONS)}[k % 9 + 1] AS location,
         {_list(s.MERCHANTS)}[event_id % 5 + 1] AS merchant,
         {_list(s.PAYMENT_METHODS)}[event_id % 4 + 1] AS payment_method,
         'dev-' || k AS device_id,
         make_timestamp(1704067200000000 + (((epoch_us(ts) - 1704067200000000) // 720) // 1000) * 1000) AS "timestamp"
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events))"""
BC = "bc AS (SELECT 'C' || c_custkey AS customer_id, c_mktsegment AS description FROM customer WHERE c_acctbal < 0)"
BD = "bd AS (SELECT 'dev-' || p_partkey AS device_id, p_brand AS description FROM part WHERE p_size <= 5)"
FEED = """feed AS (SELECT 'C' || o_custkey AS customer_id, o_orderpriority AS description, o_orderkey
  FROM orders WHERE o_orderstatus = 'F')"""

SECOND_ID = "'TX' || strftime(\"timestamp\", '%Y%m%d%H%M%S')"
COLUMNS = 'transaction_id, customer_id, amount, location, merchant, payment_method, device_id, "timestamp"'
REST = 'customer_id, amount, location, merchant, payment_method, device_id, "timestamp"'
T_COLUMNS = 't.transaction_id, t.customer_id, t.amount, t.location, t.merchant, t.payment_method, t.device_id, t."timestamp"'
LABEL = f"'{s.BLACKLIST_LABEL}' AS label"


def _hop(key: str, size_s: int, slide_s: int, aggregate: str, having: str, source: str = "tx") -> str:
    return f"""SELECT {key}, make_timestamp(w) AS window_start, make_timestamp(w + {size_s * 1_000_000}) AS window_end, {aggregate}
  FROM (SELECT {source}.*, (epoch_us("timestamp") // {slide_s * 1_000_000} - i) * {slide_s * 1_000_000} AS w
        FROM {source} CROSS JOIN range({size_s // slide_s}) r(i))
  GROUP BY {key}, w HAVING {having}"""


VELOCITY = _hop("customer_id", 60, 10, f"count(*) AS txn_count, '{s.VELOCITY_MESSAGE}' AS alert_message", "count(*) >= 5")
GEO = _hop(
    "customer_id", 300, 60, f"count(DISTINCT location) AS distinct_locations, '{s.GEO_MESSAGE}' AS alert_message",
    "count(DISTINCT location) >= 2",
)
DEVICE = _hop(
    "device_id", 300, 60, f"count(DISTINCT customer_id) AS distinct_customers, '{s.DEVICE_MESSAGE}' AS alert_message",
    "count(DISTINCT customer_id) > 3",
)
VELOCITY_BY_WINDOW = _hop("customer_id", 60, 10, "count(*) AS tx_count", "count(*) >= 5")

JOIN_C = f"SELECT {T_COLUMNS}, {LABEL}, b.description FROM tx t JOIN bc b ON t.customer_id = b.customer_id"
JOIN_D = f"SELECT {T_COLUMNS}, {LABEL}, b.description FROM tx t JOIN bd b ON t.device_id = b.device_id"
JOIN_FEED = f"SELECT {T_COLUMNS}, {LABEL}, b.description FROM tx t JOIN feed b ON t.customer_id = b.customer_id"
TX_LATEST = f"""SELECT {COLUMNS} FROM (
  SELECT {SECOND_ID} AS transaction_id, {REST},
         row_number() OVER (PARTITION BY {SECOND_ID} ORDER BY event_id DESC) AS rn FROM tx) WHERE rn = 1"""


def _json(fields: list[str]) -> str:
    """A JSON object of the columns; the windows begin and end on whole seconds."""
    def value(f: str) -> str:
        if f == "timestamp":
            return 'CAST("timestamp" AS VARCHAR)'
        return f"strftime({f}, '%Y-%m-%d %H:%M:%S')" if f.startswith("window_") else f

    return "CAST(json_object(" + ", ".join(f"'{f}', {value(f)}" for f in fields) + ") AS VARCHAR)"


def _decoded(columns: str) -> str:
    """What remains of the nine message shapes; see ``driver_tables.payloads``."""
    return f"""WITH {TX} SELECT event_id, {columns}
  FROM (SELECT *, event_id % 9 AS shape FROM tx) WHERE shape NOT IN (4, 7, 8)"""


_PRESENT = "CASE WHEN shape <> 3 THEN {0} END AS {0}"
_AMOUNT = "CASE WHEN shape IN (0, 1, 6) THEN amount END AS amount"
_TIME = "CASE WHEN shape IN (0, 1, 5) THEN \"timestamp\" END AS \"timestamp\""


def _present(*names: str) -> str:
    return ", ".join(_PRESENT.format(n) for n in names)


ORACLES = {
    "big_amount": f"WITH {TX} SELECT {COLUMNS} FROM tx WHERE amount > 10000000",
    "big_amount_latest": f"""WITH {TX} SELECT {COLUMNS} FROM (
  SELECT {SECOND_ID} AS transaction_id, {REST},
         row_number() OVER (PARTITION BY {SECOND_ID} ORDER BY event_id DESC) AS rn FROM tx WHERE amount > 10000000) WHERE rn = 1""",
    "tx_latest_by_id": f"WITH {TX} {TX_LATEST}",
    "tx_copy": f"WITH {TX} SELECT {COLUMNS} FROM tx",
    "blacklist_customers": f"WITH {TX}, {BC} {JOIN_C}",
    "blacklist_devices": f"WITH {TX}, {BD} {JOIN_D}",
    "blacklist_append": f"WITH {TX}, {BC}, {BD} {JOIN_C} UNION ALL {JOIN_D}",
    "blacklist_latest": f"""WITH {TX}, {BC}, {BD}, hits AS (
  SELECT t.event_id, 0 AS writer, {T_COLUMNS}, {LABEL}, b.description FROM tx t JOIN bc b ON t.customer_id = b.customer_id
  UNION ALL
  SELECT t.event_id, 1 AS writer, {T_COLUMNS}, {LABEL}, b.description FROM tx t JOIN bd b ON t.device_id = b.device_id)
SELECT {COLUMNS}, label, description FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY event_id DESC, writer DESC, description DESC) AS rn FROM hits)
WHERE rn = 1""",
    "blacklist_repeated_entries": f"WITH {TX}, {FEED} {JOIN_FEED}",
    "blacklist_by_shuffle": f"WITH {TX}, {FEED} {JOIN_FEED}",
    "tx_left_blacklist": f"""WITH {TX}, {BC}
SELECT {T_COLUMNS}, {LABEL}, b.description FROM tx t LEFT JOIN bc b ON t.customer_id = b.customer_id""",
    "dictionary_distinct": f"WITH {FEED} SELECT DISTINCT customer_id, description FROM feed",
    "decode_strict_dictionary": f"WITH {FEED} SELECT DISTINCT customer_id, description FROM feed",
    "dictionary_latest": f"""WITH {FEED} SELECT customer_id, description FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY o_orderkey DESC) AS rn FROM feed) WHERE rn = 1""",
    "velocity_windows": f"WITH {TX} {_hop('customer_id', 60, 10, 'count(*) AS txn_count', 'count(*) >= 1')}",
    "velocity_alerts": f"WITH {TX} {VELOCITY}",
    "velocity_alerts_direct": f"WITH {TX} {VELOCITY}",
    "velocity_computed_time": f"""WITH {TX}, cut AS (SELECT customer_id, date_trunc('second', "timestamp") AS "timestamp" FROM tx)
{_hop('customer_id', 60, 10, 'count(*) AS tx_count', 'count(*) >= 5', source='cut')}""",
    "geolocation_alerts": f"WITH {TX} {GEO}",
    "device_alerts": f"WITH {TX} {DEVICE}",
    "decode_lenient_records": _decoded(
        "CASE WHEN shape = 6 THEN CAST(event_id AS VARCHAR) ELSE transaction_id END AS transaction_id, "
        + _present("customer_id", "location", "merchant", "payment_method", "device_id") + f", {_AMOUNT}, {_TIME}"
    ),
    "decode_strict_records": f"""WITH {TX} SELECT transaction_id, customer_id, amount, location, merchant, payment_method, device_id,
  date_trunc('second', "timestamp") AS "timestamp" FROM tx""",
    "decode_narrow_records": _decoded(
        "CASE WHEN shape = 6 THEN event_id END AS transaction_id, "
        + _present("customer_id", "location", "payment_method", "device_id") + f", {_AMOUNT}, {_TIME}"
    ),
    "relational_copy": f"""WITH {TX} SELECT transaction_id, customer_id, CAST(amount AS INTEGER) AS amount,
  date_trunc('second', "timestamp") AS "timestamp", CAST(NULL AS VARCHAR) AS mercant, payment_method, location, device_id
FROM ({TX_LATEST})""",
    "assemble_records": f"""WITH {TX} SELECT {SECOND_ID} AS transaction_id, customer_id, CAST(amount AS VARCHAR) AS amount, merchant,
  location, payment_method, device_id, strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp" FROM tx""",
    "encode_alerts": f"""WITH {TX} SELECT {_json(['customer_id'])} AS "key",
  {_json(['customer_id', 'window_start', 'window_end', 'txn_count', 'alert_message'])} AS "value" FROM ({VELOCITY})""",
    "encode_geolocation": f"""WITH {TX} SELECT {_json(['customer_id'])} AS "key",
  {_json(['customer_id', 'window_start', 'window_end', 'distinct_locations', 'alert_message'])} AS "value" FROM ({GEO})""",
    "encode_blacklist": f"""WITH {TX}, {BC}, {BD} SELECT {_json(s.BLACKLIST_COLUMNS)} AS "value" FROM ({JOIN_C} UNION ALL {JOIN_D})""",
    "encode_blacklist_customers": f"""WITH {TX}, {BC} SELECT {_json(s.BLACKLIST_COLUMNS)} AS "value" FROM ({JOIN_C})""",
    "encode_window_keys": f"""WITH {TX} SELECT {_json(['customer_id', 'window_start'])} AS "key",
  {_json(['customer_id', 'tx_count', 'window_start', 'window_end'])} AS "value" FROM ({VELOCITY_BY_WINDOW})""",
    "encode_unkeyed": f"""WITH {TX} SELECT
  {_json(['device_id', 'window_start', 'window_end', 'distinct_customers', 'alert_message'])} AS "value" FROM ({DEVICE})""",
    "alerts_from_messages": f"WITH {TX} {DEVICE}",
    "normalised_places": f"WITH {TX} {GEO}",
    "panel_counts": """SELECT date_trunc('hour', ts) AS "time", event_type, count(*) AS n FROM events
GROUP BY 1, 2 ORDER BY 1, 2 LIMIT 100000""",
    "panel_p99": """SELECT date_trunc('day', ts) AS "time", event_type, quantile_disc(value, 0.99) / 1000 AS p99 FROM events
WHERE event_type <> 'signup' GROUP BY 1, 2 ORDER BY 1, 2 LIMIT 100000""",
    "panel_errors": """SELECT date_trunc('hour', ts) AS "time", event_type, count(*) AS n FROM events
WHERE event_type IN ('error', 'signup') AND event_type <> 'signup' GROUP BY 1, 2 ORDER BY 1, 2 LIMIT 100000""",
    "panel_top": """SELECT min(ts) AS first_time, user_id, arg_min(event_type, (ts, event_id)) AS first_label, max(value) / 1000 AS duration
FROM events GROUP BY user_id ORDER BY duration DESC, user_id LIMIT 100""",
    "panel_detail": """WITH chosen AS (SELECT user_id FROM events ORDER BY value DESC, user_id DESC LIMIT 1),
span AS (SELECT min(ts) AS lo, max(ts) AS hi FROM events WHERE event_type = 'purchase' AND user_id = (SELECT user_id FROM chosen))
SELECT user_id, event_id, event_type, ts, value * 0.001 AS duration, 'k=' || json_extract_string(props, '$.k') AS tags
FROM events WHERE user_id = (SELECT user_id FROM chosen) AND ts >= (SELECT lo FROM span) AND ts <= (SELECT hi FROM span) + INTERVAL 1 SECOND AND value > 0
ORDER BY ts DESC, value DESC, event_id DESC LIMIT 1000""",
    "panel_page": "SELECT ts, props, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 1000",
    "panel_distinct": "SELECT DISTINCT event_type FROM events",
    "panel_distinct_ids": "SELECT DISTINCT user_id FROM events WHERE event_type = 'error' ORDER BY user_id LIMIT 100",
    "panel_avg": """SELECT date_trunc('hour', ts) AS "time", event_type, round(avg(value), 10) AS avg_value FROM events
GROUP BY 1, 2 ORDER BY 1, 2""",
    "panel_avg_text": """SELECT ts AS "time", event_type, CAST(avg(value) AS VARCHAR) AS avg_value FROM events
GROUP BY 1, 2 ORDER BY 1, 2""",
    "panel_status": "SELECT event_id, event_type, CASE WHEN event_type IN ('error') THEN 2 ELSE 0 END AS status_code FROM events",
    "panel_time_range": """SELECT make_timestamp((epoch_us(ts) // 90000000) * 90000000) AS "time", event_type, count(*) AS n FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-10 06:00:00' AND TIMESTAMP '2024-01-20 18:30:00' GROUP BY 1, 2""",
    "panel_date_range": """SELECT make_timestamp((epoch_us(ts) // 500000) * 500000) AS "time", event_type, count(*) AS n FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' GROUP BY 1, 2""",
    "panel_date_time": """SELECT date_trunc('hour', ts) AS "time", event_type, count(*) AS n FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-10 06:00:00' AND TIMESTAMP '2024-01-20 18:30:00' GROUP BY 1, 2""",
    "alert_rollup": f"""WITH {TX}, {BC}, {BD}, alerts AS (
  SELECT 'big_amount' AS rule, "timestamp" AS raised FROM tx WHERE amount > 10000000
  UNION ALL SELECT 'blacklist', "timestamp" FROM ({JOIN_C} UNION ALL {JOIN_D})
  UNION ALL SELECT 'velocity_alerts', window_start FROM ({VELOCITY})
  UNION ALL SELECT 'geolocation_alerts', window_start FROM ({GEO})
  UNION ALL SELECT 'device_alerts', window_start FROM ({DEVICE}))
SELECT rule, make_timestamp((epoch_us(raised) // 300000000) * 300000000) AS "time", count(*) AS alerts FROM alerts GROUP BY 1, 2""",
    "stream_big_amount": f"WITH {TX} SELECT {COLUMNS} FROM tx WHERE amount > 10000000",
    "stream_velocity_alerts": f"WITH {TX} SELECT * FROM ({VELOCITY})",
    "stream_geolocation_alerts": f"WITH {TX} SELECT * FROM ({GEO})",
    "stream_device_alerts": f"WITH {TX} SELECT * FROM ({DEVICE})",
    "stream_blacklist_customers": f"WITH {TX}, {BC} {JOIN_C}",
    "stream_velocity_in_batches": f"WITH {TX} SELECT * FROM ({VELOCITY})",
    "stream_device_in_batches": f"WITH {TX} SELECT * FROM ({DEVICE})",
    "stream_blacklist_devices_joined": f"WITH {TX}, {BD} {JOIN_D}",
    "stream_blacklist_devices": f"WITH {TX}, {BD} {JOIN_D}",
    "stream_dictionary_distinct": f"WITH {FEED} SELECT DISTINCT customer_id, description FROM feed",
    "stream_tx_latest": f"WITH {TX} {TX_LATEST}",
    "stream_landed_transactions": f"WITH {TX} SELECT {COLUMNS} FROM tx",
}
ORACLES["stream_blacklist_latest"] = ORACLES["blacklist_latest"]
ORACLES["stream_big_amount_latest"] = ORACLES["big_amount_latest"]
ORACLES["users_per_week"] = """WITH panes AS (SELECT DISTINCT event_type, user_id, epoch_us(ts) // 3600000000 AS p FROM events),
met AS (SELECT DISTINCT event_type, user_id, unnest(range(p - 167, p + 1)) AS s FROM panes)
SELECT event_type, make_timestamp(s * 3600000000) AS window_start, make_timestamp((s + 168) * 3600000000) AS window_end, count(*) AS users
FROM met GROUP BY event_type, s"""
# The same questions, asked of streams in other ways.
for _name, _same in {
    "stream_velocity_out_of_order": "stream_velocity_alerts", "stream_device_strict": "stream_device_alerts",
    "stream_velocity_backfilled": "stream_velocity_alerts", "stream_tx_latest_tiered": "stream_tx_latest",
    "stream_blacklist_latest_tiered": "blacklist_latest", "stream_landed_tiered": "stream_landed_transactions",
    "stream_blacklist_devices_heavy": "stream_blacklist_devices_joined", "stream_all_rules": "alert_rollup", "stream_dictionary_distinct_table": "stream_dictionary_distinct",
    "panel_counts_rolled_up": "panel_counts", "panel_avg_rolled_up": "panel_avg", "panel_p99_rolled_up": "panel_p99",
}.items():
    ORACLES[_name] = ORACLES[_same]
