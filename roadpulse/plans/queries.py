"""The query catalogue: every operator over the whole events table.

An event stands for a telemetry message: ``ts`` is its time, ``user_id`` its driver and vehicle,
``value`` its g-force and also a duration, ``event_type = 'error'`` a failed outcome and ``props``
a nested payload.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadpulse.config import ArchiveConfig, DetectorConfig, RollConfig
from roadpulse.functions import text, times
from roadpulse.operators import batching, detect, layout, mapping, metrics, parse
from roadpulse.plans import settings as S
from roadpulse.session import scratch_path
from roadpulse.sinks import archive, commits, dead_letter, lookup, sizing, tables, vehicle_table
from roadpulse.sources.messages import read_messages, write_messages
from roadpulse.sources.tables import (
    TOO_LONG_EVERY,
    events,
    message_text,
    spread_small,
    telemetry_messages,
)
from roadpulse.streaming.pipeline import archive_records

Query = Callable[[SparkSession, str], DataFrame]
CATALOGUE: dict[str, Query] = {}


def query(run: Query) -> Query:
    CATALOGUE[run.__name__] = run
    return run


def broken_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_messages(events(spark, sf_dir), broken=True)


def messages(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    return telemetry_messages(events(spark, sf_dir), keep or ("event_id",))


def is_error() -> Column:
    return F.col("event_type") == "error"


def with_duration(rows: DataFrame) -> DataFrame:
    """Adds a whole-number duration, so that sums are exact."""
    return rows.withColumn("duration_us", F.round(F.col("value") * 1000).cast("bigint"))


def timed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_duration(events(spark, sf_dir))


def loaded_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as outcomes of the table loader: table, and error class where it failed."""
    odd = F.col("event_id") % 2
    kind = F.get_json_object("props", "$.k").cast("int") % 3
    error = (
        F.when(kind == 0, "JsonParseException")
        .when(kind == 1, "DataIntegrityViolationException")
        .otherwise("TransientDataAccessException")
    )
    return events(spark, sf_dir).select(
        "event_id",
        "ts",
        F.when(odd == 0, "vehicle_events").otherwise("messages").alias("table_name"),
        F.when(is_error(), error).alias("error_class"),
    )


# --- detector -------------------------------------------------------------------------


def _accidents(spark: SparkSession, sf_dir: str, threshold: float) -> DataFrame:
    found = detect.accident_filter(broken_messages(spark, sf_dir), DetectorConfig(threshold))
    return found.select("event_id", "event_type", detect.g_force(F.col("value")).alias("g_force"))


@query
def accident_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _accidents(spark, sf_dir, S.THRESHOLD)


@query
def accident_filter_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _accidents(spark, sf_dir, DetectorConfig().threshold)


@query
def accident_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The emitted text is the text that came in."""
    rows = events(spark, sf_dir)
    number = F.format_string("%d", F.col("event_id") % 11)
    value = F.concat(F.lit('{"g_force": '), number, F.lit(', "props": '), "props", F.lit("} "))
    return detect.accident_filter(rows.select("event_id", value.alias("value")))


@query
def invalid_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = parse.split_valid(broken_messages(spark, sf_dir), "detector")
    return rejected.select("event_id", "event_type", "value")


@query
def normal_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = DetectorConfig(S.THRESHOLD)
    sample = detect.normal_sample(broken_messages(spark, sf_dir), config, key="event_id")
    return sample.select("event_id", "event_type")


@query
def detector_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.detector_counters(broken_messages(spark, sf_dir), S.THRESHOLD)


@query
def detector_counters_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.detector_counters(
        broken_messages(spark, sf_dir), S.THRESHOLD, by=("event_type",)
    )


@query
def archive_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.archive_counters(broken_messages(spark, sf_dir), by=("event_type",))


@query
def metric_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    counters = detector_counters_by_type(spark, sf_dir)
    rows = metrics.metric_rows(counters, ("event_type",), "telemetry", F.current_timestamp())
    return rows.select(F.col("tags")["event_type"].alias("event_type"), "name", "value")


# --- parse and projection -------------------------------------------------------------


@query
def typed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.typed_record(messages(spark, sf_dir), keep=("event_id",))


@query
def lenient_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's value in one of ten JSON forms, read as each of the five types."""
    form = F.col("event_id") % 10
    number = F.col("value").cast("string")
    node = (
        F.when(form == 0, number)
        .when(form == 1, F.concat(F.lit('"'), number, F.lit('"')))
        .when(form == 2, F.concat(F.lit('"  '), number, F.lit(' "')))
        .when(form == 3, F.lit("true"))
        .when(form == 4, F.lit('"abc"'))
        .when(form == 5, F.lit('{"a":1}'))
        .when(form == 6, F.lit("[1]"))
        .when(form == 7, F.lit("null"))
        .when(form == 9, (F.lit(1 << 32) + F.col("event_id")).cast("string"))
    )
    fields = {"i": "int", "l": "bigint", "d": "double", "s": "string", "b": "boolean"}
    body = F.concat_ws(",", *[F.concat(F.lit(f'"{name}":'), node) for name in fields])
    value = F.concat(F.lit("{"), body, F.lit("}"))
    rows = spread_small(events(spark, sf_dir)).select("event_id", value.alias("value"))
    return parse.lenient_record(rows, fields, keep=("event_id",))


@query
def json_source_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir)
    fields = {
        "event_id": F.col("event_id"),
        "g_force": F.col("value"),
        "driver_id": F.col("user_id"),
        "current_street": F.col("event_type"),
    }
    path = scratch_path(spark, "messages")
    write_messages(rows.select(message_text(fields).alias("value")), path)
    kinds = {"event_id": "bigint", "g_force": "double", "driver_id": "int"}
    return parse.lenient_record(
        read_messages(spark, path), {**kinds, "current_street": "string"}
    )


@query
def column_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.mapped(messages(spark, sf_dir), S.MAPPING, keep=("event_id",))


def simple_text() -> Column:
    """A short message that keeps ``props`` nested."""
    user = F.col("user_id").cast("string")
    return F.concat(
        F.lit('{"policy_id":'),
        user,
        F.lit(',"vin":"VIN-'),
        user,
        F.lit('","note":null,"props":'),
        "props",
        F.lit("}"),
    )


def simple_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short messages with message headers; every other header map holds a null ``vin``."""
    headers = F.when(
        F.col("event_id") % 2 == 0,
        F.create_map(
            F.lit("source"), F.col("event_type"), F.lit("vin"), F.lit(None).cast("string")
        ),
    ).otherwise(F.create_map(F.lit("source"), F.col("event_type")))
    return spread_small(events(spark, sf_dir)).select(
        "event_id",
        "event_type",
        "ts",
        simple_text().alias("value"),
        headers.alias("message_headers"),
    )


@query
def column_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.mapped_expressions(
        simple_messages(spark, sf_dir),
        S.EXPRESSIONS,
        headers="message_headers",
        keep=("event_id",),
    )


@query
def expression_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expressions over values that don't fit them: NULL or their fallback, and no failed batch."""
    return mapping.mapped_expressions(
        simple_messages(spark, sf_dir),
        S.FAULTY_EXPRESSIONS,
        headers="message_headers",
        keep=("event_id",),
    )


@query
def null_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.null_parameters(
        simple_messages(spark, sf_dir),
        S.EXPRESSIONS,
        headers="message_headers",
        by=("event_type",),
        table="vehicle_events",
    )


def binary_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    form = F.col("event_id") % 4
    kind = (
        F.when(form == 0, "application/json")
        .when(form == 1, "text/plain")
        .when(form == 2, "application/octet-stream")
    )
    return events(spark, sf_dir).select(
        "event_id", F.encode("props", "UTF-8").alias("payload"), kind.alias("content_type")
    )


@query
def payload_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = parse.decoded(binary_messages(spark, sf_dir), content_type="content_type")
    return decoded.select("event_id", "content_type", "value", F.length("payload").alias("bytes"))


@query
def payload_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = binary_messages(spark, sf_dir).withColumn(
        "payloads", F.array("payload", F.encode(F.col("event_id").cast("string"), "UTF-8"))
    )
    single = parse.exploded_payloads(rows.drop("payload"))
    return parse.decoded(single).select("event_id", "value")


@query
def message_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.repeat("props", 12)
    return events(spark, sf_dir).select("event_id", text.preview(value).alias("preview"))


# --- time, layout and tables ----------------------------------------------------------


@query
def event_time_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp, form = F.col("ts").cast("timestamp"), F.col("event_id") % 3
    given = (
        F.when(form == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .when(form == 1, F.unix_seconds(stamp).cast("string"))
        .otherwise(F.unix_millis(stamp).cast("string"))
    )
    return events(spark, sf_dir).select("event_id", times.epoch_millis(given).alias("epoch_ms"))


@query
def readable_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    rows = events(spark, sf_dir).select("event_id", seconds.alias("event_time"))
    return times.readable(rows).select(
        "event_id",
        "event_time",
        F.unix_micros("event_timestamp").alias("event_timestamp_us"),
        "event_time_utc",
    )


@query
def partition_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    user, event_id = F.col("user_id").cast("string"), F.col("event_id")
    driver = F.when(
        event_id % 2 == 0, F.concat(F.lit('"DRIVER-'), user, F.lit('"'))
    ).otherwise(user)
    value = (
        F.when(event_id % 97 == 0, F.lit("not-json"))
        .when(event_id % 89 == 0, F.lit('{"driver_id":null}'))
        .otherwise(F.concat(F.lit('{"policy_id":'), user, F.lit(',"driver_id":'), driver, F.lit("}")))
    )
    rows = events(spark, sf_dir).select("event_id", "ts", value.alias("value"))
    parsed, today = parse.parsed(rows), F.to_date("ts")
    return parsed.select(
        "event_id",
        layout.partition_path(S.PATH_TEMPLATE, F.col("message"), today).alias("path"),
        layout.partition_path(S.PATH_TEMPLATE, None, today).alias("path_without_message"),
        layout.partition_path("", None, today).alias("default_path"),
    )


def written_archive(spark: SparkSession, sf_dir: str, *partition_columns: str) -> DataFrame:
    """All messages through the archive sink and back."""
    config = ArchiveConfig(scratch_path(spark, "archive"), partition_columns or ("date",))
    rows = messages(spark, sf_dir, "event_id", "ts")
    archive.write_archive(archive_records(rows, config), config, mode="errorifexists")
    return archive.read_archive(spark, config.path)


@query
def archive_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = written_archive(spark, sf_dir)
    return stored.withColumn("date", F.col("date").cast("string"))


@query
def archive_partition_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = written_archive(spark, sf_dir)
    wanted = stored.where(F.col("date") >= F.lit(S.SCAN_FROM).cast("date"))
    return wanted.groupBy(F.col("date").cast("string").alias("date")).agg(
        F.count(F.lit(1)).alias("messages"), F.sum("driver_id").alias("driver_sum")
    )


@query
def archive_file_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per date, what the file counters add up to; file names differ from run to run."""
    stats = archive.file_stats(written_archive(spark, sf_dir), by=("date",), min_rows=1)
    counters = archive.file_counters(stats, by=("date",))
    return counters.select(
        F.col("date").cast("string").alias("date"),
        "rows_written",
        "files_too_small",
        (F.col("bytes_written") > 0).alias("has_bytes"),
    )


@query
def archive_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An archive of small files, and the files that are left once those are joined in place."""
    config = ArchiveConfig(scratch_path(spark, "small"), roll=RollConfig(max_rows=S.SMALL_ROWS))
    rows = parse.typed_record(
        messages(spark, sf_dir, "event_id", "ts").withColumn("date", F.to_date("ts")),
        keep=("event_id", "ts", "date"),
    )
    sizing.write_sized(rows, config, "ts", "event_id", by_age=False)
    before = sizing.file_table(spark, config.path, "ts", by=("date",)).groupBy("date")
    held = scratch_path(spark, "before")
    before.agg(F.count(F.lit(1)).alias("small_files")).write.parquet(held)
    sizing.compact_small(spark, config, config.roll.max_bytes, order=("ts", "event_id"))
    after = sizing.file_table(spark, config.path, "ts", by=("date",)).groupBy("date")
    files = after.agg(F.count(F.lit(1)).alias("files"), F.sum("file_rows").alias("messages"))
    joined = files.join(spark.read.parquet(held), "date")
    return joined.withColumn("date", F.col("date").cast("string"))


@query
def archive_file_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = file_roll_plan(spark, sf_dir)
    label = layout.file_label(F.col("first_ts"), F.lit("instance-0"), F.col("writer_id"))
    return plan.select("date", "writer_id", "age_bucket", "file_no", label.alias("file_label"))


@query
def events_table_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table, and the records it can't hold as they were set aside.

    Some vehicle ids are made too large for their column; those rows come from the misfits, with
    that id in ``kept_vehicle_id``.
    """
    records = parse.typed_record(messages(spark, sf_dir), keep=("event_id",))
    too_large = F.when(F.col("event_id") % TOO_LONG_EVERY == 0, S.BEYOND_INT).otherwise(0)
    records = records.withColumn("vehicle_id", F.col("vehicle_id") + too_large)
    fitting, misfits = tables.split_fitting(records)
    typed = tables.as_events_table(fitting, keep=("event_id",))
    path, aside = scratch_path(spark, "events-table"), scratch_path(spark, "misfits")
    name = "vehicle_events_" + path[-12:]
    archive.save_events_table(typed, name, path, buckets=8, mode="errorifexists")
    misfits.write.parquet(aside)
    kept = spark.read.parquet(aside).withColumn("kept_vehicle_id", F.col("vehicle_id"))
    stored = spark.table(name).withColumn("kept_vehicle_id", F.lit(None).cast("bigint"))
    return stored.unionByName(tables.as_events_table(kept, keep=("event_id", "kept_vehicle_id")))


@query
def vehicle_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of each vehicle from the table distributed by vehicle; every third event is of one vehicle."""
    records = parse.typed_record(messages(spark, sf_dir), keep=("event_id",))
    hot = F.when(F.col("event_id") % 3 == 0, S.HOT_VEHICLE).otherwise(F.col("vehicle_id"))
    typed = tables.as_events_table(records.withColumn("vehicle_id", hot), keep=("event_id",))
    path = scratch_path(spark, "vehicle-table")
    name = "by_vehicle_" + path[-12:]
    vehicle_table.save_by_vehicle(typed, name, path, S.BUCKET_ROWS)
    return vehicle_table.per_vehicle(
        spark,
        name,
        {
            "events": ("count", "event_id"),
            "satellites": ("sum", "gps_satellite_count"),
            "least_g_force": ("min", "g_force"),
            "greatest_g_force": ("max", "g_force"),
        },
    )


@query
def events_lookup_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events laid out for lookups by time and id, read back per policy."""
    stored = commits.read(spark, lookup_files(spark, sf_dir))
    return stored.groupBy("policy_id").agg(
        F.count(F.lit(1)).alias("messages"), F.max("event_time").alias("last_event_time")
    )


def lookup_files(spark: SparkSession, sf_dir: str) -> str:
    records = parse.typed_record(messages(spark, sf_dir))
    path = scratch_path(spark, "lookup")
    lookup.write_lookup(tables.as_events_table(records), path, rows_per_file=S.LOOKUP_ROWS)
    return path


@query
def events_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of some vehicles and drivers in a stretch of time and force, from the files that can hold them."""
    found = lookup.look_up(spark, lookup_files(spark, sf_dir), S.LOOKUP)
    return found.select("event_time", "policy_id", "vehicle_id", "driver_id", "g_force", "vin")


@query
def schema_migration(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("event_id", "ts", F.col("ts").alias("event_time"))
    kept = tables.retype_to_epoch(rows.withColumn("kept_time", F.col("ts")), "kept_time")
    return tables.recreate_column(kept, "event_time", "bigint").select(
        "event_id", "event_time", "kept_time"
    )


@query
def jdbc_init_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = parse.typed_record(messages(spark, sf_dir), keep=("event_id",))
    return tables.as_initial_table(
        record.select("event_id", "policy_id", "vin", "event_time", "driver_id", "device_charging")
    )


@query
def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    event_id = F.col("event_id")
    value = (
        F.when(event_id % 97 == 0, F.lit("not-json"))
        .when(event_id % 89 == 0, F.lit("[1]"))
        .otherwise(F.col("props"))
    )
    rows = events(spark, sf_dir).select("event_id", "ts", value.alias("value"))
    marked = parse.keep_where(parse.with_validity(rows, "map"), ~F.col("is_valid"))
    reason = dead_letter.error_class(F.col("message"))
    return dead_letter.dead_letters(marked, reason, at=F.col("ts"), keep=("event_id",))


# --- order-dependent operators --------------------------------------------------------


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their round-robin writer and the size of their payload."""
    rows = events(spark, sf_dir).select(
        "event_id", "ts", F.octet_length("props").cast("bigint").alias("bytes")
    )
    return batching.assign_writers(rows, ("ts", "event_id"))


@query
def round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(spark, sf_dir).select("event_id", "arrival_index", "intake_batch", "writer_id")


@query
def writer_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batching.writer_counts(labelled(spark, sf_dir))


@query
def writer_running_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = labelled(spark, sf_dir).select("event_id", "ts", "writer_id")
    counted = batching.running_count(rows, ("writer_id",), ("ts", "event_id"))
    return counted.select("event_id", "writer_id", "running_count")


@query
def count_idle_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batching.count_idle_batches(
        events(spark, sf_dir), ("event_type",), "ts", "event_id", S.BATCH_ROWS, S.IDLE_MICROS
    )


@query
def count_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batching.count_idle_batches(
        events(spark, sf_dir), ("event_type",), "ts", "event_id", S.BATCH_ROWS, None
    )


def rolled_files(spark: SparkSession, sf_dir: str, roll: RollConfig, by_age: bool) -> DataFrame:
    """One row per file that the archive holds, written under a date and writer within the limits.

    The limit of bytes counts payload bytes here, so that files do not depend on the encoding.
    """
    config = ArchiveConfig(scratch_path(spark, "rolled"), ("date", "writer_id"), roll=roll)
    rows = labelled(spark, sf_dir).select("event_id", "ts", "bytes", "writer_id", F.to_date("ts").alias("date"))
    sizing.write_sized(rows, config, "ts", "event_id", size="bytes", by_age=by_age)
    stored = commits.read_files(spark, config.path, rows.schema)
    return stored.groupBy(F.col("date").cast("string").alias("date"), "writer_id", "file_path").agg(
        F.count(F.lit(1)).alias("file_rows"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        F.sum("bytes").alias("file_bytes"),
        F.min(F.struct("ts", "event_id")).alias("_first"),
    )


def numbered_files(files: DataFrame, *keys: str) -> DataFrame:
    """Numbers the files of a key by their first row; a row of ``files`` is a whole file."""
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("_first")) - F.lit(1)
    return files.withColumn("file_no", number.cast("bigint")).drop("_first", "file_path")


@query
def file_roll_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of an archive limited by age and rows, as written."""
    files = rolled_files(spark, sf_dir, S.ROLL, by_age=True)
    aged = files.withColumn("age_bucket", sizing.age_bucket("first_ts", S.ROLL))
    numbered = numbered_files(aged, "date", "writer_id", "age_bucket")
    return numbered.withColumn("too_small", F.col("file_rows") < S.ROLL.min_rows)


@query
def file_roll_by_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of an archive limited by payload bytes, as written."""
    files = rolled_files(spark, sf_dir, S.SIZE_ROLL, by_age=False)
    return numbered_files(files.drop("first_ts", "last_ts"), "date", "writer_id")


@query
def file_roll_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = batching.open_file_state(
        labelled(spark, sf_dir), "ts", "event_id", "bytes", S.REASON_ROLL
    )
    return state.drop("ts").withColumn("date", F.col("date").cast("string"))


# --- metrics --------------------------------------------------------------------------


@query
def rate_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.rate(events(spark, sf_dir), "ts", ("event_type",))


@query
def rate_5m_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.sliding_rate(events(spark, sf_dir), "ts")


@query
def error_rate_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir)
    return metrics.share_pct(rows, "ts", is_error(), "error_pct", seconds=3600)


@query
def success_rate_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, success = loaded_events(spark, sf_dir), F.col("error_class").isNull()
    return metrics.share_pct(rows, "ts", success, "success_pct", ("table_name",), 3600)


@query
def error_rate_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = loaded_events(spark, sf_dir).where(F.col("error_class").isNotNull())
    return metrics.rate(failed, "ts", ("table_name", "error_class"))


@query
def null_rate_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = mapping.message_frame(simple_messages(spark, sf_dir), headers="message_headers")
    missing = frame.select("ts", mapping.missing_count(frame, S.EXPRESSIONS).alias("missing"))
    return metrics.total_rate(missing, "ts", "missing")


@query
def duration_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounded to 6 places: the engines' interpolations differ in the last bit."""
    found = metrics.exact_quantiles(
        events(spark, sf_dir), "value", S.QUANTILES, ("event_type",)
    )
    names = [metrics.quantile_name(q) for q in S.QUANTILES]
    return found.select("event_type", *[F.round(name, 6).alias(name) for name in names])


@query
def duration_percentiles_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each approximate percentile's rank is within the summary's error bound."""
    rows, accuracy = events(spark, sf_dir).select("event_type", "value"), 10_000
    found = metrics.approximate_quantiles(rows, "value", S.QUANTILES, ("event_type",), accuracy)
    n, value = F.count("value"), F.col("value")

    def in_bound(q: float) -> Column:
        name = metrics.quantile_name(q)
        below, upto = F.count_if(value < F.col(name)), F.count_if(value <= F.col(name))
        low, high = F.floor(n * (q - 1 / accuracy)), F.ceil(n * (q + 1 / accuracy))
        return ((upto >= low) & (below <= high)).alias(f"{name}_in_bound")

    ranked = rows.join(found, "event_type").groupBy("event_type")
    return ranked.agg(n.alias("n"), *[in_bound(q) for q in S.QUANTILES])


@query
def duration_quantiles_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select(
        F.window("ts", "5 minutes").getField("start").alias("window_start"), "value"
    )
    return metrics.histogram_quantiles(
        rows, "value", S.BUCKETS, S.QUANTILES, ("window_start",)
    )


@query
def duration_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.cumulative_buckets(events(spark, sf_dir), "value", S.BUCKETS, ("event_type",))


@query
def duration_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.duration_summary(timed_events(spark, sf_dir), "duration_us", ("event_type",))


@query
def jdbc_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.outcome_counters(
        loaded_events(spark, sf_dir), F.col("error_class").isNotNull()
    )


@query
def error_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.error_counts(loaded_events(spark, sf_dir), "error_class")


@query
def events_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).agg(F.count(F.lit(1)).alias("events"))


@query
def recent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir)
    newest = rows.agg(F.max("ts")).scalar()
    return times.recent(rows, "ts", "1 day", newest).agg(F.count(F.lit(1)).alias("events"))


@query
def recent_events_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select(
        F.unix_millis(F.col("ts").cast("timestamp")).alias("event_time")
    )
    newest = F.timestamp_millis(rows.agg(F.max("event_time")).scalar())
    return times.recent_millis(rows, "event_time", "7 days", newest).agg(
        F.count(F.lit(1)).alias("events")
    )


@query
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = F.col("ts").cast("timestamp")
    spec = F.lit(r"a:b\,c,d")
    return events(spark, sf_dir).select(
        "event_id",
        F.to_date("ts").cast("string").alias("iso_date"),
        times.file_time_label(F.col("ts")).alias("file_time"),
        F.unix_millis(stamp).alias("millis"),
        F.unix_seconds(stamp).alias("seconds"),
        (F.col("ts") - F.expr("INTERVAL 5 MINUTES")).alias("five_minutes_before"),
        text.strip_driver_prefix(F.concat(F.lit("DRIVER-"), "user_id")).alias("driver"),
        F.regexp_replace("props", r"(\d+)", "<$1>").alias("marked_props"),
        F.element_at(F.split(spec, r"(?<!\\),"), 1).alias("first_pair"),
        F.replace(F.trim(F.concat(F.lit("  "), "event_type", F.lit(" "))), F.lit("e"), F.lit("3"))
        .alias("replaced"),
        F.substring("props", 1, 4).alias("head"),
        F.least(F.lit(100), F.length("props")).cast("bigint").alias("shown"),
        text.writer_label(F.col("event_id") % 3).alias("writer"),
        F.pmod(F.col("event_id"), F.lit(7)).alias("remainder"),
        text.megabytes(F.octet_length("props")).alias("megabytes"),
        text.is_text_content(F.concat(F.lit("application/"), "event_type")).alias("is_text"),
        F.get_json_object("props", "$.k").alias("k"),
    )
