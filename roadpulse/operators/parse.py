"""From message text to typed columns, and the split into valid and invalid messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.config import DEFAULT_CONTENT_TYPE
from roadpulse.functions import json_fields as jf
from roadpulse.functions.text import is_text_content
from roadpulse.schema import ARCHIVE_TYPES

CONSUMERS = ("detector", "archive", "map")


def parsed(messages: DataFrame, value: str = "value", message: str = "message") -> DataFrame:
    """Adds the parsed message as a VARIANT column, read once for all later fields."""
    return messages.withColumn(message, jf.parse_message(F.col(value)))


def is_valid(value: Column, message: Column, consumer: str) -> Column:
    """Whether a consumer accepts the message.

    The detector and the archive accept any JSON and also an empty text (no fields). The
    table loader needs a JSON object.
    """
    if consumer not in CONSUMERS:
        raise ValueError(f"consumer must be one of {CONSUMERS}, not {consumer!r}")
    if consumer == "map":
        return F.coalesce(F.schema_of_variant(message).startswith("OBJECT"), F.lit(False))
    empty = F.coalesce(F.trim(value) == "", F.lit(False))
    return message.isNotNull() | empty


def with_validity(
    messages: DataFrame, consumer: str, value: str = "value", flag: str = "is_valid"
) -> DataFrame:
    return parsed(messages, value).withColumn(
        flag, is_valid(F.col(value), F.col("message"), consumer)
    )


def computed_once(rows: DataFrame) -> DataFrame:
    """The same rows, with their computed columns evaluated once however they are used later.

    Spark moves a filter below the projection that made its columns and copies their
    expressions into it, so an expensive one (a parse) runs twice. A column that depends on the
    task, and a filter that needs it, hold the projection in place.
    """
    held = rows.withColumn("_task", F.spark_partition_id())
    return held.where(F.col("_task") >= 0).drop("_task")


def keep_where(rows: DataFrame, condition: Column) -> DataFrame:
    """Filters on parsed columns without parsing again."""
    held = rows.withColumn("_task", F.spark_partition_id())
    return held.where(condition & (F.col("_task") >= 0)).drop("_task")


def split_valid(
    messages: DataFrame, consumer: str, value: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """(accepted messages with their parsed form, rejected messages as they came)."""
    marked = with_validity(messages, consumer, value)
    accepted = keep_where(marked, F.col("is_valid")).drop("is_valid")
    rejected = keep_where(marked, ~F.col("is_valid")).drop("is_valid", "message")
    return accepted, rejected


def lenient_record(
    messages: DataFrame,
    fields: dict[str, str],
    value: str = "value",
    keep: tuple[str, ...] = (),
    valid: str | None = None,
) -> DataFrame:
    """The wanted fields of each message, with the lenient rules of ``json_fields``.

    Well-formed messages are read in one pass against the declared types. Only a message that
    this pass finds anything odd in is parsed again, field by field. ``valid`` names an optional
    flag for messages the archive accepts.
    """
    record = jf.strict_record(F.col(value), fields)
    first_pass = messages.select("*", record.alias("_record"))
    clean = jf.is_clean(F.col(value), F.col("_record"), fields)
    second_pass = first_pass.select("*", clean.alias("_clean")).select(
        "*", F.when(~F.col("_clean"), jf.parse_message(F.col(value))).alias("_message")
    )
    arrays = jf.read_fields(F.col("_message"), fields)
    third_pass = second_pass.select(
        "*",
        *[F.when(~F.col("_clean"), odd).alias(f"_odd_{kind}") for kind, odd in arrays.items()],
    )
    accepted = F.col("_clean") | is_valid(F.col(value), F.col("_message"), "archive")
    place: dict[str, int] = {}
    columns = []
    for name, kind in fields.items():
        odd = F.get(F.col(f"_odd_{kind}"), F.lit(place.setdefault(kind, 0)))
        place[kind] += 1
        quick = F.col("_record").getField(name)
        columns.append(F.when(F.col("_clean"), quick).otherwise(odd).alias(name))
    return third_pass.select(*keep, *([accepted.alias(valid)] if valid else []), *columns)


def typed_record(
    messages: DataFrame, value: str = "value", keep: tuple[str, ...] = (), mode: str = "lenient"
) -> DataFrame:
    """Messages as the fixed 33-column record; unknown keys are dropped.

    ``lenient`` replaces a field of the wrong type by its empty value, ``strict`` by NULL.
    """
    if mode == "lenient":
        return lenient_record(messages, ARCHIVE_TYPES, value, keep)
    message = F.col("_message")
    return messages.withColumn("_message", jf.parse_message(F.col(value))).select(
        *keep,
        *[jf.read_field(message, n, kind, mode).alias(n) for n, kind in ARCHIVE_TYPES.items()],
    )


def payload_text(payload: Column, content_type: Column | None = None) -> Column:
    """Payload bytes as text when the content type says text; NULL when it does not."""
    kind = F.lit(DEFAULT_CONTENT_TYPE) if content_type is None else content_type
    kind = F.coalesce(kind, F.lit(DEFAULT_CONTENT_TYPE))
    return F.when(is_text_content(kind), F.decode(payload, "UTF-8"))


def decoded(
    messages: DataFrame, payload: str = "payload", content_type: str | None = None
) -> DataFrame:
    """Adds the text form ``value`` of a binary payload; the bytes stay for other types."""
    kind = None if content_type is None else F.col(content_type)
    return messages.withColumn("value", payload_text(F.col(payload), kind))


def exploded_payloads(messages: DataFrame, payloads: str = "payloads") -> DataFrame:
    """A message that carries a list of payloads becomes one row per payload."""
    return messages.withColumn("payload", F.explode(payloads)).drop(payloads)
