"""Parameters of the query catalogue, shared with the SQL that checks it."""

from __future__ import annotations

from roadpulse.config import RollConfig
from roadpulse.operators.layout import TODAY

THRESHOLD = 150.0
BATCH_ROWS = 10
IDLE_MICROS = 300_000_000
ROLL = RollConfig(max_age_minutes=360, max_rows=20, min_rows=10)
FILE_BYTES = 600
SIZE_ROLL = RollConfig(max_rows=10**6, max_size_mb=FILE_BYTES / (1024 * 1024))
SMALL_ROWS = 200
REFUSED_EVERY = 3001
LOOKUP_ROWS = 2_000
BUCKET_ROWS = 1_000
HOT_VEHICLE = 300_000
# Least and greatest values of the columns; None leaves an end open.
LOOKUP = {
    "event_time": (1_704_672_000, 1_706_000_000),
    "vehicle_id": (300_000, 300_400),
    "driver_id": (400_010, None),
    "g_force": (20.0, 180.0),
}
REASON_ROLL = RollConfig(max_age_minutes=1200, max_rows=90, max_size_mb=900 / (1024 * 1024))
QUANTILES = (0.5, 0.95, 0.99)
BUCKETS = (1.0, 2.5, 5.0, 10.0, 25.0, 50.0, 100.0, 250.0)
SCAN_FROM = "2024-01-15"
BEYOND_INT = 2**40
PATH_TEMPLATE = (
    f"'date=' + {TODAY} + '/driver=' + payload.driver_id + '/policy=' + payload.policy_id"
)
MAPPING = "policy:policy_id,vehicle_id,vin,event_timestamp:timestamp,speed_ms,street:current_street"
EXPRESSIONS = {
    "policy": "payload.policy_id",
    "vin": "vin",
    "source": "headers.source",
    "first_k": "payload.props.k",
    "note": "note",
    "label": "concat(payload.vin, '/', headers.source)",
    "marked": "concat(policy_id, '-', vin)",
    "absent": "speed_ms",
    "half": "speed_ms / 2",
    "message": "payload.toString()",
}
# Expressions that fail for some messages: no number, too large, division by zero, out of an array.
FAULTY_EXPRESSIONS = {
    "vin_number": "cast(vin as int)",
    "fallback": "coalesce(payload.vin * 2, -1)",
    "large": "cast(policy_id as int) * 10000000",
    "small": "cast(policy_id as tinyint) + cast(1 as tinyint)",
    "share": "100 / (policy_id % 10)",
    "letter": "element_at(split(headers.source, 'r'), 3)",
    "above": "payload.vin > 5",
    "day": "to_date(headers.source)",
    "again": "cast(payload.vin as int) + 1",
}
# A gap longer than the idle limit: the session window's own gap is exclusive.
IDLE_GAP = "300 seconds 1 microsecond"
# The bounded stream: events arrive in this many parts of equal length in time, each 50th a part late.
ARRIVALS = 3
DELAYED_EVERY = 50
LATE_BY_HOURS = 24
BUCKET_SECONDS = 3600
LOAD_COLUMNS = "policy:policy_id,vin,speed_ms"
