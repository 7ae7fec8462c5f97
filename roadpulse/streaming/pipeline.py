"""The pipeline as streaming queries: archive, detector, table loader and fan-out.

Each consumer is one query with its own checkpoint, so every consumer sees all messages and
replays what it had not committed. Inside a consumer the work is shared by Spark's tasks.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from roadpulse.config import (
    DEFAULT_MAX_ATTEMPTS,
    DEFAULT_TRIGGER_SECONDS,
    ArchiveConfig,
    DetectorConfig,
    TableSinkConfig,
)
from roadpulse.operators.detect import accident_filter, detected
from roadpulse.operators.layout import gathered, with_partition_columns
from roadpulse.operators.mapping import message_frame, missing_count
from roadpulse.operators.metrics import detector_aggregates, metric_rows
from roadpulse.operators.parse import keep_where, lenient_record, with_validity
from roadpulse.schema import ARCHIVE_TYPES
from roadpulse.session import remove, scratch_path
from roadpulse.sinks.archive import COMPRESSION
from roadpulse.sinks.dead_letter import (
    MISFIT,
    Insert,
    Ledger,
    Part,
    dead_letters,
    deliver,
    deliver_each,
    error_class,
    insert_each,
)

DRAIN = {"availableNow": True}

BatchWriter = Callable[[DataFrame, int], None]
PartWriter = Callable[[DataFrame, str], DataFrame | None]


def every(seconds: int) -> dict:
    return {"processingTime": f"{seconds} seconds"}


def every_millis(millis: int) -> dict:
    return {"processingTime": f"{millis} milliseconds"}


def archive_records(
    messages: DataFrame, config: ArchiveConfig, ts: str = "ts", value: str = "value"
) -> DataFrame:
    """Valid messages as archive rows with their partition columns.

    A record field that is also a partition column stays in the file as ``record_<name>``.
    """
    fields = tuple(name for name in config.partition_columns if name != "date")
    places = {name: f"place_{name}" for name in fields}
    placed = with_partition_columns(messages, fields, ts, value).withColumnsRenamed(places)
    rows = lenient_record(
        placed, ARCHIVE_TYPES, value, keep=("date", *places.values()), valid="is_valid"
    )
    rows = keep_where(rows, F.col("is_valid")).drop("is_valid")
    rows = rows.withColumnsRenamed({name: f"record_{name}" for name in fields})
    return rows.withColumnsRenamed({place: name for name, place in places.items()})


def start_archive(
    messages: DataFrame, config: ArchiveConfig, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """All valid messages to the Parquet archive, each exactly once; ``start_quarantine`` takes the rest."""
    rows_per_file = 1 if config.force_flush else config.roll.max_rows
    records = archive_records(messages, config)
    if config.partition_columns != ("date",):
        records = gathered(records, config.partition_columns, config.splits)
    return (
        records.writeStream.format("parquet")
        .option("path", config.path)
        .option("checkpointLocation", checkpoint)
        .option("compression", COMPRESSION)
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*config.partition_columns)
        .trigger(**(trigger or every(config.trigger_seconds)))
        .start()
    )


def start_detector(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    config: DetectorConfig = DetectorConfig(),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Accident messages, unchanged, to a named destination that other queries read."""
    return (
        accident_filter(messages, config)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or every(1)))
        .start()
    )


def start_quarantine(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    ts: str = "ts",
    value: str = "value",
) -> StreamingQuery:
    """The messages that ``start_archive`` leaves out, as dead letters, each exactly once.

    A consumer of its own beside the archive, so neither waits for the other.
    """
    marked = with_validity(messages, "archive", value)
    rejected = keep_where(marked, ~F.col("is_valid"))
    letters = dead_letters(
        rejected.withColumn("date", F.to_date(ts)), error_class(F.col("message")), value, keep=("date",)
    )
    return (
        letters.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or every(DEFAULT_TRIGGER_SECONDS)))
        .start()
    )


def start_log(
    events: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Every event as a line of JSON in log files, beside any other consumer of the stream."""
    return (
        events.writeStream.format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or every(1)))
        .start()
    )


def start_counted_detector(
    messages: DataFrame,
    path: str,
    counters_path: str,
    checkpoint: str,
    config: DetectorConfig = DetectorConfig(),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Accident messages, and each batch's detector counters, taken in the same pass.

    Both are kept by batch, so a repeated batch replaces them; ``counter_totals`` adds them up.
    """
    accidents, counters = repeatable_parquet(path), repeatable_parquet(counters_path)

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        seen = Observation()
        marked = detected(batch, config.threshold).observe(seen, *detector_aggregates())
        accidents(keep_where(marked, F.col("is_accident")).select(*messages.columns), batch_id)
        counted = seen.get
        schema = ", ".join(f"{name} bigint" for name in counted)
        counters(batch.sparkSession.createDataFrame([tuple(counted.values())], schema), batch_id)

    return each_batch(messages, write, checkpoint, trigger or every(1)).start()


def counter_totals(counters: DataFrame) -> DataFrame:
    """The detector counters over all batches, from their written table."""
    names = [name for name in counters.columns if name != "batch_id"]
    return counters.agg(*[F.sum(name).alias(name) for name in names])


def fan_out(
    routes: dict[str, BatchWriter], prepare: Callable[[DataFrame], DataFrame] | None = None
) -> BatchWriter:
    """One batch to several writers, read from the source once.

    ``prepare`` does the work the routes share (such as parsing) before the batch is kept for
    them. It is kept in files, which tasks read in parts of bounded size and only the columns that a route
    needs, however much of the batch one task wrote. An empty batch is skipped.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, rows = batch.sparkSession, prepare(batch) if prepare else batch
        path = scratch_path(spark, "fan-out")
        try:
            rows.write.parquet(path)
            kept = spark.read.schema(rows.schema).parquet(path)
            if not kept.isEmpty():
                for route in routes.values():
                    route(kept, batch_id)
        finally:
            remove(spark, path)

    return write


def repeatable_parquet(path: str, *partition_columns: str) -> BatchWriter:
    """A writer under ``batch_id=…`` that replaces what an earlier try of the batch wrote."""

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("batch_id", F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id", *partition_columns)
            .parquet(path)
        )

    return write


def marked_for_table(
    batch: DataFrame, value: str = "value", fits: Column | None = None
) -> DataFrame:
    """Adds ``error_class``: NULL for messages the table loader can read and the table can hold.

    ``fits`` is a condition on the batch and the parsed ``message``; only false sets a row aside.
    """
    marked = with_validity(batch, "map", value)
    reason = F.when(~F.col("is_valid"), error_class(F.col("message")))
    if fits is not None:
        reason = reason.when(~fits, F.lit(MISFIT))
    return marked.withColumn("error_class", reason).drop("message", "is_valid")


def table_loader(
    write: BatchWriter,
    quarantine: BatchWriter,
    transform: Callable[[DataFrame], DataFrame],
    config: TableSinkConfig = TableSinkConfig(),
    value: str = "value",
    report: BatchWriter | None = None,
    fits: Column | None = None,
) -> BatchWriter:
    """Loads a batch's valid messages; what cannot be parsed or written is quarantined.

    ``fits`` says which messages the table can hold (see ``marked_for_table``), so that one that
    it can't is parked by itself before the write and does not fail its batch. ``report`` receives the batch's metrics, unless the settings turn them off.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        kept = marked_for_table(batch, value, fits).persist()
        try:
            if kept.isEmpty():
                return
            started = time.monotonic()
            readable = F.col("error_class").isNull()
            accepted = kept.where(readable).drop("error_class")
            reason, tries = F.col("error_class"), config.max_attempts
            letters = [dead_letters(kept.where(~readable), reason, value, tries)]
            failures: list[str] = []

            def give_up(rows: DataFrame, failure: str, attempts: int) -> None:
                failures.append(failure)
                letters.append(dead_letters(accepted, F.lit(failure), value, attempts))

            deliver(transform(accepted), lambda rows: write(rows, batch_id), give_up, tries)
            quarantine(reduce(DataFrame.unionByName, letters), batch_id)
            if report and config.enable_metrics:
                seconds = time.monotonic() - started
                failure = failures[0] if failures else None
                report(loader_metrics(kept, config, failure, seconds, value), batch_id)
        finally:
            kept.unpersist()

    return load


def part_parquet(path: str) -> PartWriter:
    """A writer of named parts that replaces what an earlier try of a part wrote."""

    def write(rows: DataFrame, part: str) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/part={part}")

    return write


def row_parquet(path: str, insert: Insert, value: str = "value", max_attempts: int = DEFAULT_MAX_ATTEMPTS) -> PartWriter:
    """The same for a target that can refuse single rows (see ``insert_each``); returns the refused rows with
    their ``error_class``. ``value``, the message itself, is not stored."""

    def write(rows: DataFrame, part: str) -> DataFrame:
        spark, held = rows.sparkSession, scratch_path(rows.sparkSession, "tried")
        tried = insert_each(rows, insert, max_attempts)
        tried.write.parquet(held)
        kept = spark.read.schema(tried.schema).parquet(held)
        taken = kept.where("error_class is null").drop("error_class", value)
        taken.write.mode("overwrite").parquet(f"{path}/part={part}")
        return kept.where("error_class is not null")

    return write


def message_loader(
    write: PartWriter,
    quarantine: PartWriter,
    transform: Callable[[DataFrame], DataFrame],
    ledger: Ledger,
    config: TableSinkConfig = TableSinkConfig(),
    value: str = "value",
    most_parked: int | None = None,
) -> BatchWriter:
    """Loads a batch message by message where it must: only what can't be parsed or what the target
    refuses is quarantined, whatever else is in the batch (see ``deliver_each``).

    ``write`` and ``quarantine`` get rows and the name of their part of the batch. Where ``write`` returns the
    rows that it refused (as ``row_parquet`` does), ``transform`` has to keep ``value``.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        path = scratch_path(batch.sparkSession, "loaded-batch")
        marked_for_table(batch, value).write.parquet(path)
        marked, tries = batch.sparkSession.read.parquet(path), config.max_attempts
        unreadable = marked.where("error_class is not null")
        quarantine(dead_letters(unreadable, F.col("error_class"), value, tries), f"{batch_id}-unreadable")

        def park(rows: DataFrame, failure: str | Column, attempts: int, part: Part) -> None:
            quarantine(dead_letters(rows, F.lit(failure), value, attempts), part.name)

        accepted = marked.where("error_class is null").drop("error_class")
        deliver_each(
            accepted,
            lambda rows, part: write(transform(rows), part.name),
            park,
            ledger,
            batch_id,
            tries,
            most_parked,
        )

    return load


def loader_metrics(
    marked: DataFrame, config: TableSinkConfig, failure: str | None, seconds: float, value: str
) -> DataFrame:
    """A loaded batch's counters and duration as rows of ts, tags, name and value.

    ``failure`` is why the write was given up, if it was.
    """
    frame = message_frame(marked.drop("message"), value)
    error = F.coalesce(F.col("error_class"), F.lit(failure).cast("string"))
    outcome = frame.select(
        F.lit(config.table).alias("table"),
        error.alias("error"),
        F.when(F.col("error_class").isNull(), missing_count(frame, config.columns)).alias("missing"),
    )
    totals = outcome.groupBy("table").agg(
        F.count(F.lit(1)).alias("messages_total"),
        F.count_if(F.col("error").isNull()).alias("messages_success"),
        F.coalesce(F.sum("missing"), F.lit(0)).alias("null_parameters_total"),
        F.lit(seconds).alias("message_duration"),
    )
    errors = (
        outcome.where(F.col("error").isNotNull())
        .groupBy("table", "error")
        .agg(F.count(F.lit(1)).alias("messages_error"))
    )
    now, prefix = F.current_timestamp(), config.metrics_prefix
    return metric_rows(totals, ("table",), prefix, now).unionByName(
        metric_rows(errors, ("table", "error"), prefix, now)
    )


def loader_trigger(config: TableSinkConfig) -> dict:
    """How often the loader takes a batch: after its idle limit, or as soon as it can."""
    return every_millis(config.idle_timeout_ms) if config.idle_timeout_ms > 0 else every(0)


def each_batch(
    stream: DataFrame, write: BatchWriter, checkpoint: str, trigger: dict | None = None
) -> DataStreamWriter:
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or DRAIN))
    )
