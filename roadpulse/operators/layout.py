"""Archive layout: partition paths, partition columns and balanced writes."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.config import UNKNOWN
from roadpulse.functions import json_fields as jf
from roadpulse.functions.text import strip_driver_prefix
from roadpulse.functions.times import file_time_label

# The words of a partition-path template.
TODAY = "T(java.time.LocalDate).now().toString()"
TEMPLATE_PIECE = re.compile(
    r"'(?P<text>[^']*)'"
    r"|(?P<today>T\(java\.time\.LocalDate\)\.now\(\)\.toString\(\))"
    r"|payload\.(?P<field>[A-Za-z_]\w*)"
    r"|(?P<bare>[^'+\s]+)"
)


def field_or_unknown(message: Column, name: str) -> Column:
    """A message field as path text, 'unknown' when absent, null or unparsable."""
    text = jf.field_text(message, name)
    if name == "driver_id":
        text = strip_driver_prefix(text)
    return F.coalesce(text, F.lit(UNKNOWN))


def partition_path(
    template: str, message: Column | None = None, today: Column | None = None
) -> Column:
    """The path a template stands for; without a message every payload field is 'unknown'."""
    day = (F.current_date() if today is None else today).cast("string")
    if not template.strip():
        return F.concat(F.lit("date="), day)
    pieces = []
    for piece in TEMPLATE_PIECE.finditer(template):
        if piece["today"]:
            pieces.append(day)
        elif piece["field"]:
            pieces.append(
                F.lit(UNKNOWN) if message is None else field_or_unknown(message, piece["field"])
            )
        else:
            pieces.append(F.lit(piece["bare"] or piece["text"] or ""))
    return F.concat(*pieces)


def with_partition_columns(
    messages: DataFrame,
    fields: tuple[str, ...] = ("driver_id",),
    ts: str = "ts",
    value: str = "value",
) -> DataFrame:
    """Adds ``date`` and the wanted message fields as partition columns."""
    if not fields:
        return messages.select("*", F.to_date(ts).alias("date"))
    parsed = messages.withColumn("_message", jf.parse_message(F.col(value)))
    columns = [field_or_unknown(F.col("_message"), name).alias(name) for name in fields]
    return parsed.select("*", F.to_date(ts).alias("date"), *columns).drop("_message")


def balanced(rows: DataFrame, *columns: str) -> DataFrame:
    """Brings rows of equal columns together in files of even size.

    A rebalance lets Spark cut a hot partition value over several tasks and join small ones,
    where a plain repartition would send all of it to one task.
    """
    return rows.hint("rebalance", *columns)


def gathered(rows: DataFrame, columns: tuple[str, ...], splits: int) -> DataFrame:
    """The same for a stream, which is not re-planned while it runs.

    Rows of one partition value go to at most ``splits`` tasks, picked by the rows' own content,
    so that a hot value does not fill one task and a cold one does not make a file per task.
    """
    salt = F.pmod(F.xxhash64(*[F.col(name) for name in rows.columns]), F.lit(splits))
    return rows.repartition(*columns, salt)


def file_label(first_ts: Column, instance: Column, writer: Column, suffix: str = "parquet"):
    """The archive's own name for a file: opening time, instance, writer and milliseconds."""
    millis = F.unix_millis(first_ts.cast("timestamp")).cast("string")
    stem = F.concat_ws("-", F.lit("telemetry"), file_time_label(first_ts), instance, writer, millis)
    return F.concat(stem, F.lit(f".{suffix}"))
