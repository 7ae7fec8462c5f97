"""The given tables, and telemetry messages made from the events table by Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.operators.parse import computed_once
from roadpulse.session import prepare

# Which events stand for broken messages.
UNPARSABLE_EVERY = 97
NO_G_FORCE_EVERY = 89
TOO_LONG_EVERY = 89


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def spread_small(rows: DataFrame) -> DataFrame:
    """Rows over all cores when their source has fewer splits than that.

    Only a small source is shuffled: one with a split or more per core stays as it is.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    if rows.isStreaming or rows.rdd.getNumPartitions() >= cores:
        return rows
    return rows.repartition(cores)


def telemetry_fields() -> dict[str, Column]:
    """The 33 record fields, each an expression over the events table."""
    event_id, user_id, value = F.col("event_id"), F.col("user_id"), F.col("value")

    def part(divisor: int) -> Column:
        return value / F.lit(float(divisor))

    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return {
        "policy_id": F.lit(200000) + user_id,
        "vehicle_id": F.lit(300000) + user_id,
        "vin": F.concat(F.lit("VIN"), F.lpad(user_id.cast("string"), 14, "0")),
        "event_time": iso,
        "speed_mph": part(4),
        "speed_limit_mph": F.lit(25) + F.lit(5) * (event_id % 10),
        "current_street": F.concat(F.col("event_type"), F.lit(" Street")),
        "g_force": value,
        "driver_id": F.lit(400000) + user_id,
        "gps_latitude": F.lit(33.0) + user_id / F.lit(1000.0),
        "gps_longitude": F.lit(-84.0) - (event_id % 1000) / F.lit(1000.0),
        "gps_altitude": part(2),
        "gps_speed": part(8),
        "gps_bearing": (event_id % 360).cast("double"),
        "gps_accuracy": part(16),
        "gps_satellite_count": user_id % 13,
        "gps_fix_time": event_id % 300,
        "accelerometer_x": part(32),
        "accelerometer_y": -part(64),
        "accelerometer_z": part(128),
        "gyroscope_x": part(256),
        "gyroscope_y": -part(512),
        "gyroscope_z": part(1024),
        "magnetometer_x": part(2048),
        "magnetometer_y": -part(4096),
        "magnetometer_z": part(8192),
        "magnetometer_heading": (event_id % 360).cast("double"),
        "barometric_pressure": F.lit(1000.0) + part(32),
        "device_battery_level": event_id % 101,
        "device_signal_strength": -(event_id % 90),
        "device_orientation": F.when(event_id % 2 == 0, "portrait").otherwise("landscape"),
        "device_screen_on": event_id % 3 == 0,
        "device_charging": event_id % 5 == 0,
    }


def message_text(fields: dict[str, Column]) -> Column:
    return F.to_json(F.struct(*[column.alias(name) for name, column in fields.items()]))


def telemetry_messages(
    rows: DataFrame, keep: tuple[str, ...] = ("event_id", "ts", "event_type"), broken: bool = False
) -> DataFrame:
    """Every event as a full 33-field JSON message in ``value``.

    With ``broken`` some events become an unparsable text and some lose their g-force.
    """
    rows = spread_small(rows)
    fields = telemetry_fields()
    if not broken:
        return computed_once(rows.select(*keep, message_text(fields).alias("value")))
    fields["g_force"] = F.when(F.col("event_id") % NO_G_FORCE_EVERY != 0, F.col("value"))
    text = F.when(F.col("event_id") % UNPARSABLE_EVERY == 0, F.lit("not-json"))
    return computed_once(rows.select(*keep, text.otherwise(message_text(fields)).alias("value")))
