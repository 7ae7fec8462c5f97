"""Event-time conversions between ISO text, epoch seconds and epoch milliseconds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Whole numbers of this many digits or more are milliseconds, and the
# timestamp format used in archive file names.
MILLIS_TEXT = r"^-?[0-9]{12,}$"
SECONDS_TEXT = r"^-?[0-9]{1,11}$"
FILE_TIME_FORMAT = "yyyyMMdd_HHmmss"


def epoch_millis(event_time: Column) -> Column:
    """Epoch milliseconds of an event time given as ISO text, seconds or milliseconds."""
    text = F.trim(event_time.cast("string"))
    return (
        F.when(text.rlike(MILLIS_TEXT), text.try_cast("bigint"))
        .when(text.rlike(SECONDS_TEXT), text.try_cast("bigint") * F.lit(1000))
        .otherwise(F.unix_millis(F.try_to_timestamp(text)))
    )


def epoch_seconds(event_time: Column) -> Column:
    return F.floor(epoch_millis(event_time) / F.lit(1000)).cast("bigint")


def readable(events: DataFrame, event_time: str = "event_time") -> DataFrame:
    """The events with their epoch-seconds time as a timestamp and as UTC wall-clock time."""
    stamp = F.timestamp_seconds(F.col(event_time))
    wall_clock = F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), stamp.cast("timestamp_ntz")
    )
    return events.select("*", stamp.alias("event_timestamp"), wall_clock.alias("event_time_utc"))


def file_time_label(ts: Column) -> Column:
    return F.date_format(ts, FILE_TIME_FORMAT)


def recent(events: DataFrame, ts: str, interval: str = "5 minutes", now: Column | None = None):
    """Events later than ``now`` minus the interval."""
    moment = F.current_timestamp() if now is None else now
    return events.where(F.col(ts) > moment - F.expr(f"INTERVAL {interval}"))


def recent_millis(
    events: DataFrame, event_time: str, interval: str = "5 minutes", now: Column | None = None
) -> DataFrame:
    """The same for an event time in epoch milliseconds; ``now`` is a timestamp."""
    moment = F.current_timestamp() if now is None else now
    start = F.unix_millis(moment - F.expr(f"INTERVAL {interval}"))
    return events.where(F.col(event_time) > start)
