"""The 33-column telemetry record in its two typings: archive files and the events table."""

from __future__ import annotations

from pyspark.sql import types as T

# Field name, archive type, events-table type, in record order.
TELEMETRY_FIELDS: tuple[tuple[str, str, str], ...] = (
    ("policy_id", "bigint", "int"),
    ("vehicle_id", "bigint", "int"),
    ("vin", "string", "string"),
    ("event_time", "string", "bigint"),
    ("speed_mph", "double", "float"),
    ("speed_limit_mph", "int", "int"),
    ("current_street", "string", "string"),
    ("g_force", "double", "float"),
    ("driver_id", "int", "int"),
    ("gps_latitude", "double", "double"),
    ("gps_longitude", "double", "double"),
    ("gps_altitude", "double", "float"),
    ("gps_speed", "double", "float"),
    ("gps_bearing", "double", "float"),
    ("gps_accuracy", "double", "float"),
    ("gps_satellite_count", "int", "int"),
    ("gps_fix_time", "int", "int"),
    ("accelerometer_x", "double", "float"),
    ("accelerometer_y", "double", "float"),
    ("accelerometer_z", "double", "float"),
    ("gyroscope_x", "double", "float"),
    ("gyroscope_y", "double", "float"),
    ("gyroscope_z", "double", "float"),
    ("magnetometer_x", "double", "float"),
    ("magnetometer_y", "double", "float"),
    ("magnetometer_z", "double", "float"),
    ("magnetometer_heading", "double", "float"),
    ("barometric_pressure", "double", "float"),
    ("device_battery_level", "int", "int"),
    ("device_signal_strength", "int", "int"),
    ("device_orientation", "string", "string"),
    ("device_screen_on", "boolean", "boolean"),
    ("device_charging", "boolean", "boolean"),
)

# SQL types of the typed events table, where Spark's default differs.
TABLE_TEXT_LENGTH = 255
SQL_TYPE_NAMES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "float": "REAL",
    "double": "DOUBLE PRECISION",
    "string": f"VARCHAR({TABLE_TEXT_LENGTH})",
    "boolean": "BOOLEAN",
}

# Columns the events table is looked up by.
LOOKUP_COLUMNS = ("event_time", "policy_id", "vehicle_id", "driver_id", "g_force")

FIELD_NAMES = tuple(name for name, _, _ in TELEMETRY_FIELDS)
ARCHIVE_TYPES = {name: kind for name, kind, _ in TELEMETRY_FIELDS}
TABLE_TYPES = {name: kind for name, _, kind in TELEMETRY_FIELDS}


SPARK_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
}


def _struct(types: dict[str, str]) -> T.StructType:
    return T.StructType(
        [T.StructField(name, SPARK_TYPES[kind], True) for name, kind in types.items()]
    )


ARCHIVE_SCHEMA = _struct(ARCHIVE_TYPES)
TABLE_SCHEMA = _struct(TABLE_TYPES)


def table_column_types() -> str:
    """Column DDL of the typed events table, as taken by the JDBC writer."""
    return ", ".join(f"{name} {SQL_TYPE_NAMES[kind]}" for name, kind in TABLE_TYPES.items())
