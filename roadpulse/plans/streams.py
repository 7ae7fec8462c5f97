"""Streaming entries of the catalogue: each drains the events table as a stream, then reads back."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

import pyarrow as pa
from pyspark.errors import SparkRuntimeException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadpulse.config import ArchiveConfig, DetectorConfig, TableSinkConfig
from roadpulse.operators import detect, mapping
from roadpulse.plans import settings as S
from roadpulse.plans.queries import query, simple_text, with_duration
from roadpulse.schema import TABLE_TEXT_LENGTH
from roadpulse.session import prepare, scratch_path
from roadpulse.sinks.archive import read_archive
from roadpulse.sinks.dead_letter import PARSE_ERROR, Ledger, dead_letters
from roadpulse.sources.messages import stream_rows
from roadpulse.sources.tables import (
    TOO_LONG_EVERY,
    UNPARSABLE_EVERY,
    events,
    telemetry_messages,
)
from roadpulse.streaming import batching, bounded, pipeline
from roadpulse.streaming.counted import sink_totals, start_counted_archive
from roadpulse.streaming.metrics import (
    start_duration_sketches,
    start_rate,
    stored_quantiles,
    stored_rate,
)
from roadpulse.streaming.recent import start_recent, stored_recent

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def streamed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = events(spark, sf_dir).schema
    return stream_rows(prepare(spark), sf_dir, schema, files="events.parquet")


def drained(query_run: StreamingQuery) -> StreamingQuery:
    query_run.awaitTermination()
    return query_run


def broken_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_messages(streamed_events(spark, sf_dir), broken=True)


@query
def stream_accidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = broken_stream(spark, sf_dir)
    path = scratch_path(spark, "accidents")
    checkpoint = scratch_path(spark, "accidents-checkpoint")
    config = DetectorConfig(S.THRESHOLD)
    drained(pipeline.start_detector(messages, path, checkpoint, config, pipeline.DRAIN))
    stored = spark.read.schema(messages.schema).parquet(path)
    return stored.select("event_id", "event_type", detect.g_force(F.col("value")).alias("g_force"))


@query
def stream_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detector counters as its query writes them, added up over its batches."""
    counters = scratch_path(spark, "counters")
    drained(
        pipeline.start_counted_detector(
            broken_stream(spark, sf_dir),
            scratch_path(spark, "counted"),
            counters,
            scratch_path(spark, "counted-checkpoint"),
            DetectorConfig(S.THRESHOLD),
            pipeline.DRAIN,
        )
    )
    return pipeline.counter_totals(spark.read.parquet(counters))


@query
def stream_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per date what the archive stored and what quarantine took; together all messages."""
    config = ArchiveConfig(scratch_path(spark, "stream-archive"))
    letters = scratch_path(spark, "stream-letters")
    stream = broken_stream(spark, sf_dir)
    checkpoints = [scratch_path(spark, f"{label}-checkpoint") for label in ("archive", "letters")]
    drained(pipeline.start_archive(stream, config, checkpoints[0], pipeline.DRAIN))
    drained(pipeline.start_quarantine(stream, letters, checkpoints[1], pipeline.DRAIN))
    stored = spark.read.parquet(config.path).select(F.col("date").cast("date"), "g_force")
    parked = spark.read.schema("date date, payload string").parquet(letters).select("date", "payload")
    both = stored.withColumn("payload", F.lit(None).cast("string")).unionByName(
        parked, allowMissingColumns=True
    )
    return both.groupBy(F.col("date").cast("string").alias("date")).agg(
        F.count_if(F.col("payload").isNull()).alias("messages"),
        F.count("g_force").alias("with_g_force"),
        F.max("g_force").alias("max_g_force"),
        F.count("payload").alias("quarantined"),
    )


@query
def fanout_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One read and one parse of the source, four routes: archive, accidents, their log tap, quarantine."""
    paths = {
        name: scratch_path(spark, f"route-{name}")
        for name in ("archive", "accidents", "log", "quarantine")
    }
    stores = {name: pipeline.repeatable_parquet(path) for name, path in paths.items()}

    def archive(batch: DataFrame, batch_id: int) -> None:
        stores["archive"](batch.where("is_valid").select("event_id", "record.*"), batch_id)

    def accidents(batch: DataFrame, batch_id: int) -> None:
        stores["accidents"](batch.where("is_accident").select("event_id", "value"), batch_id)

    def log(batch: DataFrame, batch_id: int) -> None:
        stores["log"](batch.where("is_accident").select("event_id"), batch_id)

    def quarantine(batch: DataFrame, batch_id: int) -> None:
        rejected = batch.where(~F.col("is_valid"))
        stores["quarantine"](dead_letters(rejected, F.lit(PARSE_ERROR)), batch_id)

    routes = {"archive": archive, "accidents": accidents, "log": log, "quarantine": quarantine}
    checkpoint = scratch_path(spark, "fanout-checkpoint")
    started = pipeline.each_batch(
        broken_stream(spark, sf_dir),
        pipeline.fan_out(routes, lambda batch: detect.detected_record(batch, S.THRESHOLD)),
        checkpoint,
    ).start()
    drained(started)
    counts = [
        spark.read.parquet(path).agg(
            F.lit(name).alias("route"), F.count(F.lit(1)).alias("messages")
        )
        for name, path in paths.items()
    ]
    return counts[0].union(counts[1]).union(counts[2]).union(counts[3])


def loaded_stream(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Runs the loader on short messages; returns where rows, letters and metrics went.

    Some messages are no JSON, and some hold a text that is too long for its column.
    """
    event_id = F.col("event_id")
    value = F.when(event_id % UNPARSABLE_EVERY == 0, F.lit("not-json"))
    long_vin = F.lit("V" * (TABLE_TEXT_LENGTH + 1))
    value = value.when(event_id % TOO_LONG_EVERY == 0, F.replace(simple_text(), F.lit("VIN-"), long_vin))
    value = value.otherwise(simple_text())
    vin = F.try_variant_get(F.col("message"), "$.vin", "string")
    messages = streamed_events(spark, sf_dir).select("event_id", value.alias("value"))
    paths = {name: scratch_path(spark, name) for name in ("rows", "letters", "metrics")}
    config = TableSinkConfig("vehicle_events", S.LOAD_COLUMNS)
    load = pipeline.table_loader(
        write=pipeline.repeatable_parquet(paths["rows"]),
        quarantine=pipeline.repeatable_parquet(paths["letters"]),
        transform=lambda rows: mapping.mapped(rows, config.columns, keep=("event_id",)),
        config=config,
        report=pipeline.repeatable_parquet(paths["metrics"]),
        fits=F.length(vin) <= TABLE_TEXT_LENGTH,
    )
    checkpoint = scratch_path(spark, "load-checkpoint")
    drained(pipeline.each_batch(messages, load, checkpoint).start())
    return paths


@query
def table_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loader end to end: mapped rows to the table, unreadable and too long messages to quarantine."""
    paths = loaded_stream(spark, sf_dir)
    stored = spark.read.parquet(paths["rows"]).groupBy(F.lit("loaded").alias("outcome")).agg(
        F.count(F.lit(1)).alias("messages"),
        F.sum(F.col("policy").cast("bigint")).alias("policy_sum"),
        F.lit(1).alias("attempts"),
    )
    letters = spark.read.parquet(paths["letters"])
    rejected = letters.groupBy(F.col("error_class").alias("outcome")).agg(
        F.count(F.lit(1)).alias("messages"),
        F.lit(None).cast("bigint").alias("policy_sum"),
        F.max("attempts").alias("attempts"),
    )
    return stored.unionByName(rejected)


def refusing_table(rows: pa.RecordBatch) -> None:
    """A target with a constraint: raises if one of the rows breaks it."""
    if any(i is not None and i % S.REFUSED_EVERY == 0 for i in rows["event_id"].to_pylist()):
        raise SparkRuntimeException("the table refuses this row")


@query
def table_load_by_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loader against a target that refuses a few messages: exactly those are parked.

    The target raises while rows are written, as a table with a constraint does.
    """
    event_id = F.col("event_id")
    value = F.when(event_id % UNPARSABLE_EVERY == 0, F.lit("not-json")).otherwise(simple_text())
    messages = streamed_events(spark, sf_dir).select("event_id", value.alias("value"))
    rows, letters, ledger, checkpoint = (scratch_path(spark, n) for n in ("rows", "letters", "ledger", "load-checkpoint"))
    config = TableSinkConfig("vehicle_events", S.LOAD_COLUMNS)
    load = pipeline.message_loader(
        write=pipeline.row_parquet(rows, refusing_table, max_attempts=config.max_attempts),
        quarantine=pipeline.part_parquet(letters),
        transform=lambda part: mapping.mapped(part, config.columns, keep=("event_id", "value")),
        ledger=Ledger(spark, ledger),
        config=config,
    )
    drained(pipeline.each_batch(messages, load, checkpoint).start())
    loaded = spark.read.parquet(rows).groupBy(F.lit("loaded").alias("outcome")).agg(
        F.count(F.lit(1)).alias("messages"),
        F.sum(F.col("policy").cast("bigint")).alias("policy_sum"),
        F.lit(1).alias("attempts"),
    )
    policy = F.get_json_object("payload", "$.policy_id").cast("bigint")
    known = F.when(F.col("error_class") != PARSE_ERROR, policy)
    parked = spark.read.parquet(letters).groupBy(F.col("error_class").alias("outcome")).agg(
        F.count(F.lit(1)).alias("messages"),
        F.sum(known).alias("policy_sum"),
        F.max("attempts").alias("attempts"),
    )
    return loaded.unionByName(parked)


@query
def loader_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loader's own counters, added up over its batches."""
    rows = spark.read.parquet(loaded_stream(spark, sf_dir)["metrics"])
    counters = rows.where(~F.col("name").endswith("_duration"))
    tags = [F.col("tags")[tag].alias(tag) for tag in ("table", "error")]
    return counters.groupBy("name", *tags).agg(F.sum("value").cast("bigint").alias("value"))


@query
def stream_rate_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All windows, the last ones too."""
    path, checkpoint = scratch_path(spark, "rates"), scratch_path(spark, "rates-checkpoint")
    rows = streamed_events(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    drained(start_rate(rows, "ts", ("event_type",), path, checkpoint, trigger=pipeline.DRAIN))
    rates = stored_rate(spark, path, ("event_type",))
    return rates.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def _sketched(spark: SparkSession, sf_dir: str, seconds: int) -> DataFrame:
    """Quantiles of the stream's 5-minute sketches, merged into windows of ``seconds``."""
    path, checkpoint = scratch_path(spark, "sketches"), scratch_path(spark, "sketches-checkpoint")
    rows = with_duration(streamed_events(spark, sf_dir)).withColumn("ts", F.col("ts").cast("timestamp"))
    run = start_duration_sketches(
        rows, "ts", "duration_us", ("event_type",), path, checkpoint, trigger=pipeline.DRAIN
    )
    drained(run)
    found = stored_quantiles(spark, path, S.QUANTILES, ("event_type",), seconds)
    return found.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query
def stream_quantiles_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sketched(spark, sf_dir, 300)


@query
def stream_quantiles_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sketched(spark, sf_dir, 86_400)


@query
def stream_sink_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the archive's own counters say it did, beside what its files hold."""
    config = ArchiveConfig(scratch_path(spark, "counted-archive"))
    checkpoint = scratch_path(spark, "counted-archive-checkpoint")
    drained(start_counted_archive(broken_stream(spark, sf_dir), config, checkpoint, pipeline.DRAIN))
    names = ("messages_received", "messages_rejected", "messages_written", "batch_failures")
    counters = F.array(*[F.struct(F.lit(name).alias("name"), F.col(name).alias("value")) for name in names])
    totals = sink_totals(spark, config.path).select(F.inline(counters))
    stored = read_archive(spark, config.path).groupBy(F.concat(F.lit("rows of "), "date").alias("name"))
    return totals.unionByName(stored.agg(F.count(F.lit(1)).alias("value")))


def in_arrivals(
    spark: SparkSession, sf_dir: str, label: str, start: Callable[[DataFrame], StreamingQuery]
) -> None:
    """Lets the events arrive part by part, some of them a part late, and drains each part.

    After the last part comes one row without a key or id that moves the watermark past everything.
    """
    rows = events(spark, sf_dir).select("event_id", F.col("event_type").alias("key"), "ts")
    first, last = rows.agg(F.min("ts"), F.max("ts")).first()
    if last is None:
        return
    us, least = F.unix_micros(F.col("ts").cast("timestamp")), F.unix_micros(F.lit(first).cast("timestamp"))
    span = F.unix_micros(F.lit(last).cast("timestamp")) - least + F.lit(1)
    part = F.floor((us - least) * F.lit(S.ARRIVALS) / span) + (F.col("event_id") % S.DELAYED_EVERY == 0).cast("int")
    path = scratch_path(spark, f"{label}-arrivals")
    spark.createDataFrame([], rows.schema).write.parquet(path)
    stream = stream_rows(spark, path, rows.schema)
    for number in range(S.ARRIVALS):
        arriving = rows.where(F.least(part, F.lit(S.ARRIVALS - 1)) == number)
        arriving.write.mode("append").parquet(path)
        drained(start(stream))
    beyond = last + timedelta(hours=S.LATE_BY_HOURS, seconds=S.BUCKET_SECONDS, microseconds=2 * S.IDLE_MICROS)
    spark.createDataFrame([(None, None, beyond)], rows.schema).write.mode("append").parquet(path)
    drained(start(stream))


@query
def stream_bounded_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of what is in time, and each event that the watermark had passed; together all events."""
    path, checkpoint = scratch_path(spark, "bounded"), scratch_path(spark, "bounded-checkpoint")

    def start(rows: DataFrame) -> StreamingQuery:
        late_by, idle_ms = f"{S.LATE_BY_HOURS} hours", S.IDLE_MICROS // 1000
        batches = bounded.bounded_batches(
            rows, "key", "ts", S.BATCH_ROWS, idle_ms, late_by, F.col("event_id"), S.BUCKET_SECONDS
        )
        return bounded.start_bounded_batches(batches, path, checkpoint, pipeline.DRAIN)

    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKS_DB)
    try:
        in_arrivals(spark, sf_dir, "bounded", start)
    finally:
        spark.conf.set(STATE_STORE, before)
    one = F.lit(1).cast("bigint").alias("batch_rows")
    late = bounded.late_rows(spark, path).select(
        "key", one, F.col("ts").alias("first_ts"), F.col("ts").alias("last_ts"), "release", "row_id"
    )
    found = bounded.stored_batches(spark, path).drop("shard").unionByName(late, allowMissingColumns=True)
    return found.select(
        "key",
        "batch_rows",
        F.col("first_ts").cast("timestamp_ntz").alias("first_ts"),
        F.col("last_ts").cast("timestamp_ntz").alias("last_ts"),
        "release",
        F.col("row_id").cast("bigint").alias("event_id"),
    )


@query
def stream_recent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live count by type over the last day of the events, read when all parts have arrived."""
    path, checkpoint = scratch_path(spark, "recent"), scratch_path(spark, "recent-checkpoint")
    day = 86_400

    def start(rows: DataFrame) -> StreamingQuery:
        known = rows.where("event_id is not null")
        return start_recent(known, "ts", ("key",), path, checkpoint, day, S.BUCKET_SECONDS, pipeline.DRAIN)

    in_arrivals(spark, sf_dir, "recent", start)
    return stored_recent(spark, path, "key string", ("key",), day)


def closed(
    spark: SparkSession, sf_dir: str, batches: Callable[[DataFrame, str], DataFrame], label: str
) -> DataFrame:
    """All batches of the events by type, those still open at the end of the stream too.

    Rows may be late by the whole span of time, so no order of files loses one. After the drain a
    second run reads one more row, without a key, that moves the watermark past everything.
    """
    first, last = events(spark, sf_dir).agg(F.min("ts"), F.max("ts")).first()
    span = int((last - first).total_seconds()) + 1 if first else 1
    rows = streamed_events(spark, sf_dir).select(F.col("event_type").alias("key"), "ts")
    end, checkpoint = scratch_path(spark, f"{label}-end"), scratch_path(spark, f"{label}-checkpoint")
    spark.createDataFrame([], rows.schema).write.parquet(end)
    path = scratch_path(spark, label)
    stream = batches(rows.unionByName(stream_rows(spark, end, rows.schema)), f"{span} seconds")

    def drain() -> None:
        started = (
            stream.writeStream.format("parquet")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(**pipeline.DRAIN)
            .start()
        )
        drained(started)

    drain()
    if last:
        beyond = last + timedelta(seconds=span + 1, microseconds=2 * S.IDLE_MICROS)
        spark.createDataFrame([(None, beyond)], rows.schema).write.mode("append").parquet(end)
        drain()
    return spark.read.schema(stream.schema).parquet(path)


@query
def stream_session_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    def batches(rows: DataFrame, late_by: str) -> DataFrame:
        return batching.session_batches(rows, "key", "ts", S.BATCH_ROWS, S.IDLE_GAP, late_by)

    found = closed(spark, sf_dir, batches, "sessions")
    return found.withColumn("session_ts", F.col("session_ts").cast("timestamp_ntz"))


@query
def stream_released_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    def batches(rows: DataFrame, late_by: str) -> DataFrame:
        return batching.released_batches(
            rows, "key", "ts", S.BATCH_ROWS, S.IDLE_MICROS // 1000, late_by
        )

    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKS_DB)
    try:
        released = closed(spark, sf_dir, batches, "released")
    finally:
        spark.conf.set(STATE_STORE, before)
    return released.select(
        "key",
        "batch_rows",
        F.col("first_ts").cast("timestamp_ntz").alias("first_ts"),
        F.col("last_ts").cast("timestamp_ntz").alias("last_ts"),
        "release",
    )
