"""Accident detection: the g-force rule, its counters and the sample of normal messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.config import DEFAULT_THRESHOLD, DetectorConfig
from roadpulse.functions import json_fields as jf
from roadpulse.operators.parse import keep_where, lenient_record
from roadpulse.schema import ARCHIVE_TYPES

HASH_SPACE = 1 << 32


def g_force(value: Column) -> Column:
    """The message's g-force; missing, unreadable or unparsable counts as 0."""
    slow = jf.field_number(jf.parse_message(value), "g_force")
    return F.coalesce(jf.quick_number(value, "g_force"), slow, F.lit(0.0))


def exceeds(number: Column, threshold: float) -> Column:
    """``number > threshold`` where NaN is never above it (Spark orders NaN highest)."""
    return F.nanvl(number, F.lit(float("-inf"))) > F.lit(float(threshold))


def accident_filter(
    messages: DataFrame, config: DetectorConfig = DetectorConfig(), value: str = "value"
) -> DataFrame:
    """Messages above the threshold, passed on unchanged. Unparsable ones never pass."""
    condition = exceeds(g_force(F.col(value)), config.threshold)
    if config.threshold < 0:
        parsable = jf.parse_message(F.col(value)).isNotNull() | (F.trim(F.col(value)) == "")
        condition = condition & parsable
    return messages.where(condition)


def detected(
    messages: DataFrame, threshold: float = DEFAULT_THRESHOLD, value: str = "value"
) -> DataFrame:
    """Adds ``is_valid`` and ``is_accident``; each message is parsed once."""
    first_pass = messages.withColumn("_number", jf.quick_number(F.col(value), "g_force"))
    second_pass = first_pass.withColumn(
        "_message", F.when(F.col("_number").isNull(), jf.parse_message(F.col(value)))
    )
    empty = F.coalesce(F.trim(value) == "", F.lit(False))
    valid = F.col("_number").isNotNull() | F.col("_message").isNotNull() | empty
    number = F.coalesce(
        F.col("_number"),
        jf.field_number(F.col("_message"), "g_force"),
        F.lit(0.0),
    )
    return second_pass.select(
        *messages.columns,
        valid.alias("is_valid"),
        (valid & exceeds(number, threshold)).alias("is_accident"),
    )


def detected_record(
    messages: DataFrame, threshold: float = DEFAULT_THRESHOLD, value: str = "value"
) -> DataFrame:
    """Adds ``is_valid``, ``is_accident`` and the typed ``record``, all from one parse of the message.

    For routes that need both the flags and the fields. A message that is not valid has a record of
    empty fields. The messages' own columns may have names of record fields.
    """
    rows = messages.select(F.struct("*").alias("_source"), F.col(value))
    typed = lenient_record(rows, ARCHIVE_TYPES, value, keep=("_source",), valid="_valid")
    valid = F.coalesce("_valid", F.lit(False))
    number = F.coalesce("g_force", F.lit(0.0))
    return typed.select(
        "_source.*",
        valid.alias("is_valid"),
        (valid & exceeds(number, threshold)).alias("is_accident"),
        F.struct(*ARCHIVE_TYPES).alias("record"),
    )


def hash_fraction(key: Column) -> Column:
    """A repeatable number in [0, 1) drawn from the key."""
    head = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")
    return head / F.lit(float(HASH_SPACE))


def normal_sample(
    messages: DataFrame,
    config: DetectorConfig = DetectorConfig(),
    value: str = "value",
    key: str | None = None,
    seed: int | None = None,
) -> DataFrame:
    """A random share of the parsable messages that are not accidents.

    With ``key`` the draw is repeatable (same key, same outcome); otherwise it is random.
    """
    draw = hash_fraction(F.col(key)) if key else F.rand(seed)
    drawn = messages.where(draw < F.lit(config.sample_rate))
    marked = detected(drawn, config.threshold, value)
    normal = keep_where(marked, F.col("is_valid") & ~F.col("is_accident"))
    return normal.select(*messages.columns)
