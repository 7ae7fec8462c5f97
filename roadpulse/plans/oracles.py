"""The SQL each query's result must equal, on the same events table."""

from __future__ import annotations

from roadpulse.plans import settings as S

ISO = (
    "strftime(ts, '%Y-%m-%dT%H:%M:%S.')"
    " || lpad(((epoch_us(ts) // 1000) % 1000)::VARCHAR, 3, '0') || 'Z'"
)

# The 33 record fields over the events table.
FIELDS = {
    "policy_id": "200000 + user_id",
    "vehicle_id": "300000 + user_id",
    "vin": "'VIN' || lpad(user_id::VARCHAR, 14, '0')",
    "event_time": ISO,
    "speed_mph": "value / 4",
    "speed_limit_mph": "(25 + 5 * (event_id % 10))::INTEGER",
    "current_street": "event_type || ' Street'",
    "g_force": "value",
    "driver_id": "(400000 + user_id)::INTEGER",
    "gps_latitude": "33::DOUBLE + user_id / 1000::DOUBLE",
    "gps_longitude": "-84::DOUBLE - (event_id % 1000) / 1000::DOUBLE",
    "gps_altitude": "value / 2",
    "gps_speed": "value / 8",
    "gps_bearing": "(event_id % 360)::DOUBLE",
    "gps_accuracy": "value / 16",
    "gps_satellite_count": "(user_id % 13)::INTEGER",
    "gps_fix_time": "(event_id % 300)::INTEGER",
    "accelerometer_x": "value / 32",
    "accelerometer_y": "-(value / 64)",
    "accelerometer_z": "value / 128",
    "gyroscope_x": "value / 256",
    "gyroscope_y": "-(value / 512)",
    "gyroscope_z": "value / 1024",
    "magnetometer_x": "value / 2048",
    "magnetometer_y": "-(value / 4096)",
    "magnetometer_z": "value / 8192",
    "magnetometer_heading": "(event_id % 360)::DOUBLE",
    "barometric_pressure": "1000::DOUBLE + value / 32",
    "device_battery_level": "(event_id % 101)::INTEGER",
    "device_signal_strength": "(-(event_id % 90))::INTEGER",
    "device_orientation": "CASE WHEN event_id % 2 = 0 THEN 'portrait' ELSE 'landscape' END",
    "device_screen_on": "event_id % 3 = 0",
    "device_charging": "event_id % 5 = 0",
}
KEPT_DOUBLE = ("gps_latitude", "gps_longitude")


def _columns(fields: dict[str, str]) -> str:
    return ",\n       ".join(f"{sql} AS {name}" for name, sql in fields.items())


def _table_fields() -> dict[str, str]:
    typed = {}
    for name, sql in FIELDS.items():
        if name == "event_time":
            sql = "epoch_us(ts) // 1000000"
        elif name in ("policy_id", "vehicle_id"):
            sql = f"({sql})::INTEGER"
        elif "value" in sql and name not in KEPT_DOUBLE or name in (
            "gps_bearing",
            "magnetometer_heading",
        ):
            sql = f"({sql})::FLOAT"
        typed[name] = sql
    return typed


RECORD = _columns(FIELDS)
TYPED_RECORD = _columns(_table_fields())

G_FORCE = "CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 THEN 0 ELSE value END"

ACCIDENTS = f"""
SELECT event_id, event_type, value AS g_force FROM events
WHERE ({G_FORCE}) > {{threshold}}
"""

COUNTERS = f"""count(*) AS messages_total,
       count(*) FILTER (WHERE ({G_FORCE}) > {S.THRESHOLD}) AS accidents_total,
       count(*) FILTER (WHERE event_id % 97 = 0) AS invalid_total"""

BUCKET_LIST = ", ".join(f"({bound})" for bound in S.BUCKETS)

LABELLED = """
indexed AS (
  SELECT *, octet_length(encode(props))::BIGINT AS bytes,
         row_number() OVER (ORDER BY ts, event_id) - 1 AS arrival_index
  FROM events
),
labelled AS (
  SELECT *, arrival_index // 500 AS intake_batch,
         'writer-' || chr((65 + (arrival_index % 500) % 3)::INTEGER) AS writer_id
  FROM indexed
)"""

SIMPLE_TEXT = (
    "'{\"policy_id\":' || user_id || ',\"vin\":\"VIN-' || user_id"
    " || '\",\"note\":null,\"props\":' || props || '}'"
)

LOADED = """
loaded AS (
  SELECT event_id, ts,
         CASE WHEN event_id % 2 = 0 THEN 'vehicle_events' ELSE 'messages' END AS table_name,
         CASE WHEN event_type <> 'error' THEN NULL
              WHEN json_extract_string(props, '$.k')::INTEGER % 3 = 0 THEN 'JsonParseException'
              WHEN json_extract_string(props, '$.k')::INTEGER % 3 = 1
                THEN 'DataIntegrityViolationException'
              ELSE 'TransientDataAccessException' END AS error_class
  FROM events
)"""

FORM_NUMBER = "event_id % 10 IN (0, 1, 2)"

def _sessions(source: str) -> str:
    return f"""
gaps AS (
  SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) <= {S.IDLE_MICROS}
                 THEN 0 ELSE 1 END AS opens
  FROM {source} WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)
),
sessions AS (
  SELECT *, sum(opens) OVER (PARTITION BY event_type ORDER BY ts, event_id
                             ROWS UNBOUNDED PRECEDING)::BIGINT AS session
  FROM gaps
),
numbered AS (
  SELECT *, (row_number() OVER (PARTITION BY event_type, session ORDER BY ts, event_id) - 1)
            // {S.BATCH_ROWS} AS batch_no
  FROM sessions
)"""


SESSIONS = _sessions("events")


def _batches(partial: str, source: str, session: str) -> str:
    return f"""
SELECT event_type, {session} AS session, batch_no, count(*) AS batch_rows,
       min(ts) AS first_ts, max(ts) AS last_ts,
       CASE WHEN count(*) = {S.BATCH_ROWS} THEN 'count' ELSE '{partial}' END AS release
FROM {source} GROUP BY ALL
"""


def _roll(age_micros: int) -> str:
    return f"""
files AS (
  SELECT ts::DATE::VARCHAR AS date, writer_id, epoch_us(ts) // {age_micros} AS age_bucket,
         ts, bytes,
         (row_number() OVER (PARTITION BY ts::DATE, writer_id, epoch_us(ts) // {age_micros}
                             ORDER BY ts, event_id) - 1) // {S.ROLL.max_rows} AS file_no
  FROM labelled
),
plan AS (
  SELECT date, writer_id, age_bucket, file_no, count(*) AS file_rows, min(ts) AS first_ts,
         max(ts) AS last_ts, sum(bytes)::BIGINT AS file_bytes,
         count(*) < {S.ROLL.min_rows} AS too_small
  FROM files GROUP BY ALL
)"""


def _window(seconds: int) -> str:
    return f"time_bucket(INTERVAL {seconds} SECONDS, ts)"


def _quantile(q: float) -> str:
    """Linear interpolation in the first bucket whose cumulative count reaches the rank."""
    rank, cases = f"{q}::DOUBLE * total", []
    for i, bound in enumerate(S.BUCKETS):
        low, below = (0.0, "0") if i == 0 else (S.BUCKETS[i - 1], f"c{i - 1}")
        inside = f"coalesce(({rank} - {below}) / nullif(c{i} - {below}, 0), 0)"
        cases.append(f"WHEN c{i} >= {rank} THEN {low}::DOUBLE + {bound - low}::DOUBLE * {inside}")
    return f"CASE {' '.join(cases)} ELSE {S.BUCKETS[-1]}::DOUBLE END"


BUCKET_COUNTS = ", ".join(
    f"count(*) FILTER (WHERE value <= {bound}) AS c{i}" for i, bound in enumerate(S.BUCKETS)
)
QUANTILE_NAMES = {q: "p" + f"{q * 100:g}".replace(".", "_") for q in S.QUANTILES}


def _sketch_quantiles(seconds: int) -> str:
    """The middle of the bucket that holds rank ceil(q * n); a bucket keeps eight leading binary digits."""
    picks = ", ".join(
        f"min(CASE WHEN upto >= ceil({q}::DOUBLE * total) THEN middle END) AS {name}"
        for q, name in QUANTILE_NAMES.items()
    )
    return f"""
WITH timed AS (
  SELECT {_window(seconds)} AS window_start, event_type, round(value * 1000)::BIGINT AS d FROM events
),
digits AS (SELECT *, greatest(length(bin(d)) - 8, 0) AS s FROM timed WHERE d IS NOT NULL),
ranked AS (
  SELECT window_start, event_type, ((d >> s) << s) + ((1::BIGINT << s) - 1) / 2.0::DOUBLE AS middle,
         count(*) OVER (PARTITION BY window_start, event_type) AS total,
         row_number() OVER (PARTITION BY window_start, event_type ORDER BY d) AS upto
  FROM digits
)
SELECT window_start, event_type, max(total) AS n, {picks} FROM ranked GROUP BY ALL
"""


ORACLES: dict[str, str] = {
    "accident_filter": ACCIDENTS.format(threshold=S.THRESHOLD),
    "accident_filter_default": ACCIDENTS.format(threshold=5.0),
    "accident_passthrough": """
SELECT event_id, '{"g_force": ' || (event_id % 11) || ', "props": ' || props || '} ' AS value
FROM events WHERE event_id % 11 > 5
""",
    "invalid_messages": """
SELECT event_id, event_type, 'not-json' AS value FROM events WHERE event_id % 97 = 0
""",
    "normal_sample": f"""
SELECT event_id, event_type FROM events
WHERE ('0x' || substr(md5(event_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0 < 0.001
  AND event_id % 97 <> 0 AND NOT ({G_FORCE}) > {S.THRESHOLD}
""",
    "detector_counters": f"SELECT {COUNTERS} FROM events",
    "detector_counters_by_type": f"SELECT event_type, {COUNTERS} FROM events GROUP BY event_type",
    "archive_counters": """
SELECT event_type, count(*) AS received, count(*) FILTER (WHERE event_id % 97 <> 0) AS written,
       count(*) FILTER (WHERE event_id % 97 = 0) AS quarantined
FROM events GROUP BY event_type
""",
    "metric_series": f"""
WITH counters AS (SELECT event_type, {COUNTERS} FROM events GROUP BY event_type)
SELECT event_type, 'telemetry_messages_total' AS name, messages_total::DOUBLE AS value
FROM counters
UNION ALL SELECT event_type, 'telemetry_accidents_total', accidents_total::DOUBLE FROM counters
UNION ALL SELECT event_type, 'telemetry_invalid_total', invalid_total::DOUBLE FROM counters
""",
    "typed_projection": f"SELECT event_id, {RECORD} FROM events",
    "lenient_coercion": f"""
SELECT event_id,
       CASE WHEN {FORM_NUMBER} THEN trunc(value)::INTEGER WHEN event_id % 10 = 3 THEN 1
            WHEN event_id % 10 IN (4, 5, 6) THEN 0 WHEN event_id % 10 = 9 THEN event_id
            END::INTEGER AS i,
       CASE WHEN {FORM_NUMBER} THEN trunc(value)::BIGINT WHEN event_id % 10 = 3 THEN 1
            WHEN event_id % 10 IN (4, 5, 6) THEN 0
            WHEN event_id % 10 = 9 THEN 4294967296 + event_id END::BIGINT AS l,
       CASE WHEN {FORM_NUMBER} THEN value WHEN event_id % 10 = 3 THEN 1
            WHEN event_id % 10 IN (4, 5, 6) THEN 0
            WHEN event_id % 10 = 9 THEN 4294967296 + event_id END::DOUBLE AS d,
       CASE event_id % 10 WHEN 0 THEN value::VARCHAR WHEN 1 THEN value::VARCHAR
            WHEN 2 THEN '  ' || value::VARCHAR || ' ' WHEN 3 THEN 'true' WHEN 4 THEN 'abc'
            WHEN 5 THEN '' WHEN 6 THEN '' WHEN 9 THEN (4294967296 + event_id)::VARCHAR END AS s,
       CASE WHEN event_id % 10 IN (3, 9) THEN true WHEN event_id % 10 IN (7, 8) THEN NULL
            ELSE false END AS b
FROM events
""",
    "json_source_roundtrip": """
SELECT event_id, value AS g_force, user_id::INTEGER AS driver_id, event_type AS current_street
FROM events
""",
    "column_mapping": """
SELECT event_id, (200000 + user_id)::VARCHAR AS policy, (300000 + user_id)::VARCHAR AS vehicle_id,
       'VIN' || lpad(user_id::VARCHAR, 14, '0') AS vin, NULL::VARCHAR AS event_timestamp,
       NULL::VARCHAR AS speed_ms, event_type || ' Street' AS street
FROM events
""",
    "column_expressions": f"""
SELECT event_id, user_id::VARCHAR AS policy,
       CASE WHEN event_id % 2 = 0 THEN NULL ELSE 'VIN-' || user_id END AS vin,
       event_type AS source, json_extract_string(props, '$.k') AS first_k,
       NULL::VARCHAR AS note, 'VIN-' || user_id || '/' || event_type AS label,
       CASE WHEN event_id % 2 = 1 THEN user_id || '-VIN-' || user_id END AS marked,
       NULL::VARCHAR AS absent, NULL::DOUBLE AS half, {SIMPLE_TEXT} AS message
FROM events
""",
    "vehicle_totals": f"""
SELECT CASE WHEN event_id % 3 = 0 THEN {S.HOT_VEHICLE} ELSE 300000 + user_id END::INTEGER AS vehicle_id,
       count(*) AS events, sum(user_id % 13)::BIGINT AS satellites,
       min(value::FLOAT) AS least_g_force, max(value::FLOAT) AS greatest_g_force
FROM events GROUP BY 1
""",
    "expression_faults": """
SELECT event_id, NULL::INTEGER AS vin_number, -1.0::DOUBLE AS fallback,
       CASE WHEN user_id * 10000000 BETWEEN -2147483648 AND 2147483647
            THEN (user_id * 10000000)::INTEGER END AS large,
       CASE WHEN user_id <= 126 THEN (user_id + 1)::TINYINT END AS small,
       CASE WHEN user_id % 10 <> 0 THEN 100::DOUBLE / (user_id % 10) END AS share,
       CASE WHEN len(string_split(event_type, 'r')) >= 3 THEN string_split(event_type, 'r')[3] END AS letter,
       NULL::BOOLEAN AS above, NULL::DATE AS day, NULL::INTEGER AS again
FROM events
""",
    "null_parameters": """
SELECT event_type, 'vehicle_events' AS table_name, count(*) AS messages, column_name,
       CASE WHEN column_name IN ('absent', 'half') THEN count(*) ELSE 0 END AS null_parameters
FROM events,
     (VALUES ('policy'), ('vin'), ('source'), ('first_k'), ('note'), ('label'), ('marked'),
             ('absent'), ('half'), ('message')) AS c(column_name)
GROUP BY event_type, column_name
""",
    "payload_decode": """
SELECT event_id,
       CASE event_id % 4 WHEN 0 THEN 'application/json' WHEN 1 THEN 'text/plain'
            WHEN 2 THEN 'application/octet-stream' END AS content_type,
       CASE WHEN event_id % 4 <> 2 THEN props END AS value,
       octet_length(encode(props))::INTEGER AS bytes
FROM events
""",
    "payload_list": """
SELECT event_id, props AS value FROM events
UNION ALL SELECT event_id, event_id::VARCHAR FROM events
""",
    "message_preview": """
SELECT event_id, substr(repeat(props, 12), 1, 100) || '...' AS preview FROM events
""",
    "event_time_normalize": """
SELECT event_id, CASE WHEN event_id % 3 = 1 THEN epoch_us(ts) // 1000000 * 1000
                      ELSE epoch_us(ts) // 1000 END AS epoch_ms
FROM events
""",
    "readable_events": """
SELECT event_id, epoch_us(ts) // 1000000 AS event_time,
       epoch_us(ts) // 1000000 * 1000000 AS event_timestamp_us,
       make_timestamp(epoch_us(ts) // 1000000 * 1000000) AS event_time_utc
FROM events
""",
    "partition_path": """
WITH places AS (
  SELECT event_id, ts::DATE::VARCHAR AS day,
         CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 THEN 'unknown'
              ELSE user_id::VARCHAR END AS place
  FROM events
)
SELECT event_id, 'date=' || day || '/driver=' || place || '/policy=' || place AS path,
       'date=' || day || '/driver=unknown/policy=unknown' AS path_without_message,
       'date=' || day AS default_path
FROM places
""",
    "archive_roundtrip": f"SELECT ts::DATE::VARCHAR AS date, {RECORD} FROM events",
    "archive_partition_scan": f"""
SELECT ts::DATE::VARCHAR AS date, count(*) AS messages,
       sum(400000 + user_id)::BIGINT AS driver_sum
FROM events WHERE ts >= TIMESTAMP '{S.SCAN_FROM} 00:00:00' GROUP BY ALL
""",
    "archive_file_stats": """
SELECT ts::DATE::VARCHAR AS date, count(*) AS rows_written, 0::BIGINT AS files_too_small,
       true AS has_bytes
FROM events GROUP BY ALL
""",
    "archive_compaction": f"""
SELECT ts::DATE::VARCHAR AS date, ceil(count(*) / {S.SMALL_ROWS})::BIGINT AS small_files,
       1::BIGINT AS files, count(*) AS messages
FROM events GROUP BY ALL
""",
    "archive_file_labels": f"""
WITH {LABELLED}, {_roll(S.ROLL.max_age_micros)}
SELECT date, writer_id, age_bucket, file_no,
       'telemetry-' || strftime(first_ts, '%Y%m%d_%H%M%S') || '-instance-0-' || writer_id || '-'
       || (epoch_us(first_ts) // 1000) || '.parquet' AS file_label
FROM plan
""",
    "events_table_typed": f"""
SELECT * EXCLUDE (user_id)
       REPLACE (CASE WHEN event_id % 89 <> 0 THEN vehicle_id END AS vehicle_id),
       CASE WHEN event_id % 89 = 0 THEN 300000 + user_id + {S.BEYOND_INT} END AS kept_vehicle_id
FROM (SELECT event_id, user_id, {TYPED_RECORD} FROM events)
""",
    "events_lookup_files": """
SELECT (200000 + user_id)::INTEGER AS policy_id, count(*) AS messages,
       max(epoch_us(ts) // 1000000) AS last_event_time
FROM events GROUP BY ALL
""",
    "events_lookup": f"""
SELECT epoch_us(ts) // 1000000 AS event_time, (200000 + user_id)::INTEGER AS policy_id,
       (300000 + user_id)::INTEGER AS vehicle_id, (400000 + user_id)::INTEGER AS driver_id,
       value::REAL AS g_force, 'VIN' || lpad(user_id::VARCHAR, 14, '0') AS vin
FROM events
WHERE epoch_us(ts) // 1000000 BETWEEN {S.LOOKUP["event_time"][0]} AND {S.LOOKUP["event_time"][1]}
  AND 300000 + user_id BETWEEN {S.LOOKUP["vehicle_id"][0]} AND {S.LOOKUP["vehicle_id"][1]}
  AND 400000 + user_id >= {S.LOOKUP["driver_id"][0]}
  AND value::REAL BETWEEN {S.LOOKUP["g_force"][0]} AND {S.LOOKUP["g_force"][1]}
""",
    "schema_migration": """
SELECT event_id, NULL::BIGINT AS event_time, epoch_us(ts) // 1000000 AS kept_time FROM events
""",
    "jdbc_init_strings": f"""
SELECT event_id::VARCHAR AS event_id, (200000 + user_id)::VARCHAR AS policy_id,
       'VIN' || lpad(user_id::VARCHAR, 14, '0') AS vin, {ISO} AS event_time,
       (400000 + user_id)::VARCHAR AS driver_id,
       CASE WHEN event_id % 5 = 0 THEN 'true' ELSE 'false' END AS device_charging
FROM events
""",
    "dead_letters": """
SELECT event_id, CASE WHEN event_id % 97 = 0 THEN 'not-json' ELSE '[1]' END AS payload,
       CASE WHEN event_id % 97 = 0 THEN 'JsonParseException'
            ELSE 'MismatchedInputException' END AS error_class,
       3::INTEGER AS attempts, ts
FROM events WHERE event_id % 97 = 0 OR event_id % 89 = 0
""",
    "round_robin": f"""
WITH {LABELLED} SELECT event_id, arrival_index, intake_batch, writer_id FROM labelled
""",
    "writer_messages": f"""
WITH {LABELLED} SELECT intake_batch, writer_id, count(*) AS messages FROM labelled GROUP BY ALL
""",
    "writer_running_count": f"""
WITH {LABELLED}
SELECT event_id, writer_id,
       row_number() OVER (PARTITION BY writer_id ORDER BY ts, event_id) AS running_count
FROM labelled
""",
    "count_idle_batches": f"WITH {SESSIONS} {_batches('idle', 'numbered', 'session')}",
    "count_batches": f"""
WITH counted AS (
  SELECT *, (row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1)
            // {S.BATCH_ROWS} AS batch_no
  FROM events
) {_batches('pending', 'counted', '1::BIGINT')}""",
    "file_roll_plan": f"WITH {LABELLED}, {_roll(S.ROLL.max_age_micros)} SELECT * FROM plan",
    "file_roll_by_size": f"""
WITH {LABELLED},
sized AS (
  SELECT ts::DATE::VARCHAR AS date, writer_id, bytes,
         (sum(bytes) OVER (PARTITION BY ts::DATE, writer_id ORDER BY ts, event_id
                           ROWS UNBOUNDED PRECEDING) - bytes)::BIGINT // {S.FILE_BYTES} AS file_no
  FROM labelled
)
SELECT date, writer_id, file_no, count(*) AS file_rows, sum(bytes)::BIGINT AS file_bytes
FROM sized GROUP BY ALL
""",
    "file_roll_reason": f"""
WITH {LABELLED},
state AS (
  SELECT ts::DATE::VARCHAR AS date, writer_id, event_id,
         row_number() OVER w AS open_rows, (sum(bytes) OVER w)::BIGINT AS open_bytes,
         epoch_us(ts) - epoch_us(first_value(ts) OVER w) AS age_micros
  FROM labelled
  WINDOW w AS (PARTITION BY ts::DATE, writer_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
)
SELECT *, CASE WHEN open_bytes > {S.REASON_ROLL.max_bytes} THEN 'file size'
               WHEN open_rows >= {S.REASON_ROLL.max_rows} THEN 'message count'
               WHEN age_micros > {S.REASON_ROLL.max_age_micros} THEN 'age' END AS reason
FROM state
""",
    "rate_5m": f"""
SELECT {_window(300)} AS window_start, event_type, count(*) AS events, count(*) / 300.0 AS rate
FROM events GROUP BY ALL
""",
    "rate_5m_sliding": f"""
SELECT {_window(60)} - to_minutes(back) AS window_start, count(*) AS events,
       count(*) / 300.0 AS rate
FROM events, (VALUES (0), (1), (2), (3), (4)) AS b(back) GROUP BY 1
""",
    "error_rate_pct": f"""
SELECT {_window(3600)} AS window_start, count(*) AS total,
       count(*) FILTER (WHERE event_type = 'error') AS matching,
       100.0::DOUBLE * count(*) FILTER (WHERE event_type = 'error') / count(*) AS error_pct
FROM events GROUP BY ALL
""",
    "success_rate_pct": f"""
WITH {LOADED}
SELECT {_window(3600)} AS window_start, table_name, count(*) AS total,
       count(*) FILTER (WHERE error_class IS NULL) AS matching,
       100.0::DOUBLE * count(*) FILTER (WHERE error_class IS NULL) / count(*) AS success_pct
FROM loaded GROUP BY ALL
""",
    "error_rate_by_type": f"""
WITH {LOADED}
SELECT {_window(300)} AS window_start, table_name, error_class, count(*) AS events,
       count(*) / 300.0 AS rate
FROM loaded WHERE error_class IS NOT NULL GROUP BY ALL
""",
    "null_rate_5m": f"""
SELECT {_window(300)} AS window_start, 2 * count(*) AS increase, 2 * count(*) / 300.0 AS rate
FROM events GROUP BY ALL
""",
    "duration_percentiles": "SELECT event_type, "
    + ", ".join(
        f"round(quantile_cont(value, {q}), 6) AS {name}" for q, name in QUANTILE_NAMES.items()
    )
    + " FROM events GROUP BY event_type",
    "duration_percentiles_approx": "SELECT event_type, count(value) AS n, "
    + ", ".join(f"true AS {name}_in_bound" for name in QUANTILE_NAMES.values())
    + " FROM events GROUP BY event_type",
    "duration_quantiles_5m": f"""
WITH counts AS (
  SELECT {_window(300)} AS window_start, count(value) AS total, {BUCKET_COUNTS}
  FROM events GROUP BY ALL
)
SELECT window_start, {", ".join(f"{_quantile(q)} AS {n}" for q, n in QUANTILE_NAMES.items())}
FROM counts
""",
    "duration_histogram": f"""
SELECT event_type, bound::VARCHAR AS le,
       count(*) FILTER (WHERE value <= bound) AS cumulative
FROM events, (SELECT col0::DOUBLE AS bound FROM (VALUES {BUCKET_LIST}) AS v(col0))
GROUP BY event_type, bound
UNION ALL SELECT event_type, '+Inf', count(value) FROM events GROUP BY event_type
""",
    "duration_summary": """
WITH timed AS (SELECT event_type, round(value * 1000)::BIGINT AS d FROM events)
SELECT event_type, count(d) AS timed, sum(d)::BIGINT AS total_duration, max(d) AS max_duration
FROM timed GROUP BY event_type
""",
    "jdbc_counters": f"""
WITH {LOADED}
SELECT table_name, count(*) AS messages_total,
       count(*) FILTER (WHERE error_class IS NULL) AS messages_success,
       count(*) FILTER (WHERE error_class IS NOT NULL) AS messages_error
FROM loaded GROUP BY table_name
""",
    "error_classification": f"""
WITH {LOADED}
SELECT table_name, error_class, count(*) AS errors
FROM loaded WHERE error_class IS NOT NULL GROUP BY ALL
""",
    "events_count": "SELECT count(*) AS events FROM events",
    "recent_events": """
SELECT count(*) AS events FROM events
WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 1 DAY
""",
    "recent_events_millis": """
SELECT count(*) AS events FROM events
WHERE epoch_us(ts) // 1000 > (SELECT max(epoch_us(ts) // 1000) FROM events) - 7 * 86400000
""",
    "scalar_functions": r"""
SELECT event_id, ts::DATE::VARCHAR AS iso_date, strftime(ts, '%Y%m%d_%H%M%S') AS file_time,
       epoch_us(ts) // 1000 AS millis, epoch_us(ts) // 1000000 AS seconds,
       ts - INTERVAL 5 MINUTES AS five_minutes_before, user_id::VARCHAR AS driver,
       regexp_replace(props, '(\d+)', '<\1>', 'g') AS marked_props, 'a:b\,c' AS first_pair,
       replace(event_type, 'e', '3') AS replaced, substr(props, 1, 4) AS head,
       least(100, length(props))::BIGINT AS shown,
       'writer-' || chr((65 + event_id % 3)::INTEGER) AS writer, event_id % 7 AS remainder,
       octet_length(encode(props)) / 1048576::DOUBLE AS megabytes, false AS is_text,
       json_extract_string(props, '$.k') AS k
FROM events
""",
    "stream_accidents": ACCIDENTS.format(threshold=S.THRESHOLD),
    "stream_counters": f"SELECT {COUNTERS} FROM events",
    "stream_archive": """
SELECT ts::DATE::VARCHAR AS date, count(*) FILTER (WHERE event_id % 97 <> 0) AS messages,
       count(*) FILTER (WHERE event_id % 97 <> 0 AND event_id % 89 <> 0) AS with_g_force,
       max(value) FILTER (WHERE event_id % 97 <> 0 AND event_id % 89 <> 0) AS max_g_force,
       count(*) FILTER (WHERE event_id % 97 = 0) AS quarantined
FROM events GROUP BY ALL
""",
    "fanout_routes": f"""
SELECT 'archive' AS route, count(*) AS messages FROM events WHERE event_id % 97 <> 0
UNION ALL SELECT 'accidents', count(*) FROM events WHERE ({G_FORCE}) > {S.THRESHOLD}
UNION ALL SELECT 'log', count(*) FROM events WHERE ({G_FORCE}) > {S.THRESHOLD}
UNION ALL SELECT 'quarantine', count(*) FROM events WHERE event_id % 97 = 0
""",
    "table_load": """
SELECT 'loaded' AS outcome, count(*) AS messages, sum(user_id)::BIGINT AS policy_sum,
       1::INTEGER AS attempts
FROM events WHERE event_id % 97 <> 0 AND event_id % 89 <> 0
UNION ALL SELECT 'JsonParseException', count(*), NULL, 3 FROM events WHERE event_id % 97 = 0
UNION ALL SELECT 'DataIntegrityViolationException', count(*), NULL, 3
FROM events WHERE event_id % 97 <> 0 AND event_id % 89 = 0
""",
    "table_load_by_message": f"""
SELECT 'loaded' AS outcome, count(*) AS messages, sum(user_id)::BIGINT AS policy_sum,
       1::INTEGER AS attempts
FROM events WHERE event_id % 97 <> 0 AND event_id % {S.REFUSED_EVERY} <> 0
UNION ALL SELECT 'JsonParseException', count(*), NULL, 3 FROM events WHERE event_id % 97 = 0
UNION ALL SELECT 'SparkRuntimeException', count(*), sum(user_id)::BIGINT, 3
FROM events WHERE event_id % 97 <> 0 AND event_id % {S.REFUSED_EVERY} = 0 HAVING count(*) > 0
""",
    "loader_metrics": """
SELECT 'jdbc_consumer_messages_total' AS name, 'vehicle_events' AS "table",
       NULL::VARCHAR AS error, count(*) AS value FROM events
UNION ALL SELECT 'jdbc_consumer_messages_success', 'vehicle_events', NULL, count(*)
FROM events WHERE event_id % 97 <> 0 AND event_id % 89 <> 0
UNION ALL SELECT 'jdbc_consumer_null_parameters_total', 'vehicle_events', NULL, count(*)
FROM events WHERE event_id % 97 <> 0 AND event_id % 89 <> 0
UNION ALL SELECT 'jdbc_consumer_messages_error', 'vehicle_events', 'JsonParseException', count(*)
FROM events WHERE event_id % 97 = 0
UNION ALL SELECT 'jdbc_consumer_messages_error', 'vehicle_events',
       'DataIntegrityViolationException', count(*)
FROM events WHERE event_id % 97 <> 0 AND event_id % 89 = 0
""",
    "stream_rate_5m": f"""
SELECT {_window(300)} AS window_start, event_type, count(*) AS events, count(*) / 300.0 AS rate
FROM events GROUP BY ALL
""",
    "stream_quantiles_5m": _sketch_quantiles(300),
    "stream_quantiles_daily": _sketch_quantiles(86_400),
    "stream_sink_counters": """
SELECT 'messages_received' AS name, count(*) AS value FROM events
UNION ALL SELECT 'messages_rejected', count(*) FROM events WHERE event_id % 97 = 0
UNION ALL SELECT 'messages_written', count(*) FROM events WHERE event_id % 97 <> 0
UNION ALL SELECT 'batch_failures', 0
UNION ALL SELECT 'rows of ' || ts::DATE::VARCHAR, count(*) FROM events WHERE event_id % 97 <> 0
GROUP BY ALL
""",
    "stream_session_batches": f"""
WITH {SESSIONS},
closed AS (
  SELECT *, min(ts) OVER (PARTITION BY event_type, session) AS session_ts FROM numbered
)
SELECT event_type AS key, session_ts, batch_no, count(*) AS batch_rows
FROM closed
GROUP BY ALL
""",
    "stream_released_batches": f"""
WITH {SESSIONS}
SELECT event_type AS key, count(*) AS batch_rows, min(ts) AS first_ts, max(ts) AS last_ts,
       CASE WHEN count(*) = {S.BATCH_ROWS} THEN 'count' ELSE 'idle' END AS release
FROM numbered GROUP BY event_type, session, batch_no
""",
    "stream_bounded_batches": f"""
WITH arrivals AS (
  SELECT *, least({S.ARRIVALS - 1},
                  (epoch_us(ts) - min(epoch_us(ts)) OVER ()) * {S.ARRIVALS}
                  // (max(epoch_us(ts)) OVER () - min(epoch_us(ts)) OVER () + 1)
                  + CASE WHEN event_id % {S.DELAYED_EVERY} = 0 THEN 1 ELSE 0 END) AS part
  FROM events
),
newest AS (
  SELECT part, max(max(epoch_us(ts)) // 1000) OVER (ORDER BY part) - {S.LATE_BY_HOURS} * 3600000 AS passed
  FROM arrivals GROUP BY part
),
marked AS (
  SELECT a.*, epoch_us(ts) <= coalesce((SELECT max(passed) FROM newest n WHERE n.part < a.part), 0) * 1000 AS late
  FROM arrivals a
),
kept AS (SELECT * FROM marked WHERE NOT late),
{_sessions("kept")}
SELECT event_type AS key, count(*) AS batch_rows, min(ts) AS first_ts, max(ts) AS last_ts,
       CASE WHEN count(*) = {S.BATCH_ROWS} THEN 'count' ELSE 'idle' END AS release,
       NULL::BIGINT AS event_id
FROM numbered GROUP BY event_type, session, batch_no
UNION ALL SELECT event_type, 1, ts, ts, 'late', event_id FROM marked WHERE late
""",
    "stream_recent_events": """
SELECT event_type AS key, count(*)::BIGINT AS events FROM events
WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 1 DAY
GROUP BY event_type
""",
}
