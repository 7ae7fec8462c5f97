"""Order-dependent operators: writer labels, count-or-idle batches and file rolling.

All of them take the event time from the data, so a rerun gives the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.config import DEFAULT_INTAKE_BATCH, DEFAULT_WRITERS, RollConfig
from roadpulse.functions.text import writer_label
from roadpulse.operators.ordered import ordered, with_index, with_row_number, with_running

# Why a file is closed.
AGE, ROWS, SIZE = "age", "message count", "file size"


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def _whole(number: Column) -> Column:
    return F.floor(number).cast("bigint")


def assign_writers(
    rows: DataFrame,
    order: tuple[str, ...],
    writers: int = DEFAULT_WRITERS,
    intake_batch: int = DEFAULT_INTAKE_BATCH,
    slices: int | None = None,
) -> DataFrame:
    """Arrival index, intake batch and round-robin writer; each batch starts at writer A."""
    indexed = with_index(rows, order, "arrival_index", slices)
    place = F.col("arrival_index") % F.lit(intake_batch)
    return indexed.select(
        "*",
        _whole(F.col("arrival_index") / F.lit(intake_batch)).alias("intake_batch"),
        writer_label(place % F.lit(writers)).alias("writer_id"),
    )


def spread(rows: DataFrame, writers: int = DEFAULT_WRITERS) -> DataFrame:
    """The physical form of round-robin: even partitions, one task each."""
    return rows.repartition(writers)


def writer_counts(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("intake_batch", "writer_id").agg(F.count(F.lit(1)).alias("messages"))


def running_count(
    rows: DataFrame, keys: tuple[str, ...], order: tuple[str, ...], name: str = "running_count"
) -> DataFrame:
    """The key's rows so far, the current one included."""
    numbered = with_row_number(ordered(rows, order, keys), name)
    return numbered.select(*rows.columns, name)


def count_idle_rows(
    rows: DataFrame,
    keys: tuple[str, ...],
    ts: str,
    tie_breaker: str,
    batch_size: int,
    idle_micros: int | None,
    slices: int | None = None,
) -> DataFrame:
    """Adds each row's quiet-gap session and its batch of at most ``batch_size`` in it.

    A session ends where the next row of the key comes more than ``idle_micros`` later; None
    means batches are cut by count only.
    """
    needed = rows.select(*dict.fromkeys((*keys, ts, tie_breaker)))
    data = ordered(needed, (ts, tie_breaker), keys, slices)
    if idle_micros is None:
        numbered = with_row_number(data, "_number").withColumn("session", F.lit(1).cast("bigint"))
        place = F.col("_number") - F.lit(1)
        return numbered.select(
            *needed.columns, "session", _whole(place / F.lit(batch_size)).alias("batch_no")
        )
    steps = with_running(data, previous="_previous", count="_number")
    gap = _micros(ts) - _micros("_previous")
    opens = F.col("_previous").isNull() | (gap > F.lit(idle_micros))
    marked = steps.with_columns(
        {"_opens": opens.cast("bigint"), "_opened_at": F.when(opens, F.col("_number"))}
    )
    sessions = with_running(marked, sums={"session": "_opens"}, maxes={"_start": "_opened_at"})
    place = F.col("_number") - F.col("_start")
    return sessions.rows.select(
        *needed.columns, "session", _whole(place / F.lit(batch_size)).alias("batch_no")
    )


def count_idle_batches(
    rows: DataFrame,
    keys: tuple[str, ...],
    ts: str,
    tie_breaker: str,
    batch_size: int,
    idle_micros: int | None,
    slices: int | None = None,
) -> DataFrame:
    """The batches themselves, with what released each: its size, an idle key, or nothing yet."""
    labelled = count_idle_rows(rows, keys, ts, tie_breaker, batch_size, idle_micros, slices)
    partial = F.lit("pending" if idle_micros is None else "idle")
    return labelled.groupBy(*keys, "session", "batch_no").agg(
        F.count(F.lit(1)).alias("batch_rows"),
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
        F.when(F.count(F.lit(1)) == batch_size, F.lit("count")).otherwise(partial).alias("release"),
    )


def roll_reason(rows: Column, size: Column, age_micros: Column, roll: RollConfig) -> Column:
    """Why an open file must close: size before row count before age; NULL to stay open."""
    return (
        F.when(size > roll.max_bytes, F.lit(SIZE))
        .when(rows >= roll.max_rows, F.lit(ROWS))
        .when(age_micros > roll.max_age_micros, F.lit(AGE))
    )


def open_file_state(
    rows: DataFrame,
    ts: str,
    tie_breaker: str,
    size: str,
    roll: RollConfig,
    writer: str = "writer_id",
) -> DataFrame:
    """Per row: rows, bytes and age of its date and writer so far, and the roll reason."""
    keys = ("date", writer)
    keyed = rows.select(F.to_date(ts).alias("date"), writer, ts, tie_breaker, size)
    running = with_running(
        ordered(keyed, (ts, tie_breaker), keys),
        sums={"open_bytes": size},
        count="open_rows",
        first="_opened_at",
    )
    age = _micros(ts) - _micros("_opened_at")
    return running.rows.select(
        *keys,
        ts,
        tie_breaker,
        "open_rows",
        "open_bytes",
        age.alias("age_micros"),
        roll_reason(F.col("open_rows"), F.col("open_bytes"), age, roll).alias("reason"),
    )
