"""Streams against their batch forms, restarts, repeats and empty batches."""

from __future__ import annotations

import glob
import os
from datetime import datetime, timedelta

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadpulse.config import ArchiveConfig, DetectorConfig, TableSinkConfig
from roadpulse.operators import detect, mapping
from roadpulse.plans import streams
from roadpulse.plans.oracles import ORACLES
from roadpulse.plans.queries import CATALOGUE
from roadpulse.plans.streams import ROCKS_DB, STATE_STORE
from roadpulse.session import scratch_path
from roadpulse.sources.messages import read_messages, stream_messages, stream_rows, write_messages
from roadpulse.streaming import batching, pipeline
from tests.oracle import connect, difference


@pytest.fixture
def place(spark):
    return scratch_path(spark, "stream-test")


def numbered(spark, start, end):
    text = F.format_string(
        '{"g_force": %d, "driver_id": "DRIVER-%d", "n": %d}',
        F.col("id") % 10,
        F.col("id") % 3,
        F.col("id"),
    )
    return spark.range(start, end).select(text.alias("value"))


def test_messages_roundtrip(spark, place):
    write_messages(numbered(spark, 0, 50), place)
    assert sorted(r.value for r in read_messages(spark, place).collect()) == sorted(
        r.value for r in numbered(spark, 0, 50).collect()
    )


def test_detector_restarts_where_it_stopped(spark, place):
    source = f"{place}/in"
    numbered(spark, 0, 40).coalesce(1).write.text(source)
    messages = stream_messages(spark, source, max_files_per_trigger=1)

    def run():
        pipeline.start_detector(
            messages, f"{place}/out", f"{place}/checkpoint", DetectorConfig(6.0), pipeline.DRAIN
        ).awaitTermination()
        return spark.read.schema("value string").parquet(f"{place}/out").collect()

    assert len(run()) == 12
    assert len(run()) == 12
    numbered(spark, 40, 60).coalesce(1).write.mode("append").text(source)
    found = run()
    batch = detect.accident_filter(numbered(spark, 0, 60), DetectorConfig(6.0))
    assert sorted(row.value for row in found) == sorted(row.value for row in batch.collect())


def test_archive_by_date_and_driver(spark, place):
    numbered(spark, 0, 30).withColumn("ts", F.lit(datetime(2024, 1, 1))).write.parquet(f"{place}/in")
    rows = stream_rows(spark, f"{place}/in", spark.read.parquet(f"{place}/in").schema)
    config = ArchiveConfig(f"{place}/archive", ("date", "driver_id"))
    pipeline.start_archive(rows, config, f"{place}/checkpoint", pipeline.DRAIN).awaitTermination()
    stored = spark.read.parquet(config.path)
    grouped = stored.groupBy("date", "driver_id").count().collect()
    counts = {(str(row.date), row.driver_id): row["count"] for row in grouped}
    assert counts == {("2024-01-01", driver): 10 for driver in (0, 1, 2)}
    # The text with its prefix names the folder; as an int column it reads as 0.
    assert {row.record_driver_id for row in stored.collect()} == {0}
    files = glob.glob(f"{config.path}/date=2024-01-01/driver_id=1/*.parquet")
    assert 1 <= len(files) <= config.splits


def test_fan_out_keeps_a_batch_in_files_while_it_is_routed(spark):
    held = []

    def route(batch, _):
        held.extend(batch.inputFiles())
        assert batch.count() == 40

    pipeline.fan_out({"a": route, "b": route})(spark.range(40), 1)
    assert held and not any(os.path.exists(path.removeprefix("file://")) for path in held)


def test_fan_out_feeds_every_route_and_skips_empty_batches(spark):
    seen = []
    routes = {
        "all": lambda batch, i: seen.append(("all", batch.count(), i)),
        "high": lambda batch, i: seen.append(("high", batch.where("g > 7").count(), i)),
    }
    write = pipeline.fan_out(routes, lambda batch: batch.withColumn("g", F.col("id") % 10))
    write(spark.range(20), 4)
    write(spark.range(0), 5)
    assert seen == [("all", 20, 4), ("high", 4, 4)]


def test_a_repeated_batch_replaces_its_rows(spark, place):
    write = pipeline.repeatable_parquet(place)
    write(spark.range(5), 0)
    write(spark.range(7), 1)
    write(spark.range(5), 0)
    assert spark.read.parquet(place).count() == 12


@pytest.mark.parametrize("broken_writes, loaded, parked", [(0, 8, 2), (2, 8, 2), (5, 0, 10)])
def test_table_loader(spark, texts, broken_writes, loaded, parked):
    batch = texts(*[f'{{"a":{i}}}' for i in range(8)], "not-json", "[1]")
    tries, stored, letters, reports = [], [], [], []

    def write(rows, batch_id):
        tries.append(1)
        if len(tries) <= broken_writes:
            raise ConnectionError("down")
        stored.extend(rows.collect())

    load = pipeline.table_loader(
        write,
        lambda rows, batch_id: letters.extend(rows.collect()),
        lambda rows: mapping.mapped(rows, "a"),
        TableSinkConfig("t", "a,gone"),
        report=lambda rows, batch_id: reports.extend(rows.collect()),
    )
    load(batch, 0)
    assert (len(stored), len(letters)) == (loaded, parked)
    reasons = {row.error_class for row in letters}
    assert {"JsonParseException", "MismatchedInputException"} <= reasons
    assert ("ConnectionError" in reasons) == (broken_writes > 2)
    assert {row.attempts for row in letters} == {3}
    values = {(row.name, row.tags.get("error")): row.value for row in reports}
    assert values["jdbc_consumer_messages_total", None] == 10
    assert values["jdbc_consumer_messages_success", None] == loaded
    assert values["jdbc_consumer_null_parameters_total", None] == 8
    assert values["jdbc_consumer_message_duration", None] > 0
    assert values["jdbc_consumer_messages_error", "JsonParseException"] == 1
    assert values.get(("jdbc_consumer_messages_error", "ConnectionError"), 0) == 8 - loaded


def test_loader_parks_only_the_messages_that_do_not_fit(texts):
    batch = texts('{"a":1}', '{"a":300}', '{"b":1}', "not-json", '{"a":2}')
    stored, letters = [], []
    load = pipeline.table_loader(
        lambda rows, batch_id: stored.extend(rows.collect()),
        lambda rows, batch_id: letters.extend(rows.collect()),
        lambda rows: mapping.mapped(rows, "a"),
        TableSinkConfig("t", "a"),
        fits=F.try_variant_get(F.col("message"), "$.a", "int") < 256,
    )
    load(batch, 0)
    assert len(stored) == 3
    assert sorted((row.payload, row.error_class) for row in letters) == [
        ("not-json", "JsonParseException"),
        ('{"a":300}', "DataIntegrityViolationException"),
    ]


def test_log_keeps_every_event(spark, place):
    numbered(spark, 0, 50).coalesce(1).write.text(f"{place}/in")
    messages = stream_messages(spark, f"{place}/in")
    log = f"{place}/log"
    pipeline.start_log(messages, log, f"{place}/checkpoint", pipeline.DRAIN).awaitTermination()
    assert spark.read.json(log).select("value").distinct().count() == 50


def test_archive_and_quarantine_share_all_messages(spark, place, texts):
    damaged = ("not-json", "[1]", "", "  ", "3", "null", '{"g_force": 1', '{"g_force": "x"}', "{}", None)
    rows = texts(*damaged, '{"g_force": 2}').withColumn("ts", F.lit(datetime(2024, 1, 1)))
    rows.write.parquet(f"{place}/in")
    stream = stream_rows(spark, f"{place}/in", rows.schema)
    config, letters = ArchiveConfig(f"{place}/archive"), f"{place}/letters"
    pipeline.start_archive(stream, config, f"{place}/c1", pipeline.DRAIN).awaitTermination()
    pipeline.start_quarantine(stream, letters, f"{place}/c2", pipeline.DRAIN).awaitTermination()
    stored, parked = spark.read.parquet(config.path).count(), spark.read.parquet(letters).count()
    assert (stored + parked, parked > 0) == (len(damaged) + 1, True)


def test_loader_trigger():
    assert pipeline.loader_trigger(TableSinkConfig(idle_timeout_ms=5000)) == {
        "processingTime": "5000 milliseconds"
    }
    assert pipeline.loader_trigger(TableSinkConfig()) == {"processingTime": "0 seconds"}


def test_counters_add_up_over_more_batches_than_a_query_remembers(spark, place):
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(kept)
    spark.conf.set(kept, "2")
    numbered(spark, 0, 40).repartitionByRange(8, "value").write.text(f"{place}/in")
    messages = stream_messages(spark, f"{place}/in", max_files_per_trigger=1)
    try:
        pipeline.start_counted_detector(
            messages, f"{place}/out", f"{place}/counters", f"{place}/checkpoint",
            DetectorConfig(6.0), pipeline.DRAIN,
        ).awaitTermination()
    finally:
        spark.conf.set(kept, before)
    counters = spark.read.parquet(f"{place}/counters")
    assert counters.count() > 2
    assert pipeline.counter_totals(counters).first().asDict() == {
        "messages_total": 40, "accidents_total": 12, "invalid_total": 0,
    }
    assert spark.read.parquet(f"{place}/out").count() == 12


@given(
    st.lists(st.lists(st.integers(0, 60), min_size=1, max_size=30), min_size=1, max_size=4),
    st.integers(1, 6),
)
def test_split_batches_equals_one_by_one_arrival(chunks, size):
    idle, sent, held = 5, [], None
    for chunk in chunks:
        batches = list(zip(*batching.split_batches(np.sort(np.array(chunk)), held, size, idle)))
        held = tuple(batches.pop()) if batches[-1][0] < size else None
        sent += batches
    expected, rows = [], []
    for chunk in chunks:
        for moment in sorted(chunk):
            if rows and moment - rows[-1] > idle:
                expected.append((len(rows), rows[0], rows[-1]))
                rows = []
            rows.append(moment)
            if len(rows) == size:
                expected.append((size, rows[0], rows[-1]))
                rows = []
    assert [tuple(map(int, batch)) for batch in sent] == expected
    assert (held is None) == (not rows)
    assert held is None or tuple(map(int, held)) == (len(rows), rows[0], rows[-1])


@pytest.mark.parametrize("shards", [1, 3])
def test_released_batches_keep_every_row_over_batches(spark, place, shards):
    """Two files as two batches: an open batch goes on in the next one."""
    start = datetime(2024, 1, 1)
    for part in range(2):
        rows = [(i, "k", start + timedelta(seconds=i)) for i in range(part * 25, part * 25 + 25)]
        if part:
            rows.append((999, "other", start + timedelta(hours=5)))
        frame = spark.createDataFrame(rows, "id bigint, key string, ts timestamp_ntz")
        frame.coalesce(1).write.mode("append").parquet(f"{place}/in")
    schema = spark.read.parquet(f"{place}/in").schema
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKS_DB)
    try:
        stream = stream_rows(spark, f"{place}/in", schema, max_files_per_trigger=1)
        batches = batching.released_batches(
            stream, "key", "ts", 10, 60_000, "1 second", shards=shards, spread_by="id"
        )
        query = (
            batches.writeStream.format("parquet")
            .option("path", f"{place}/out")
            .option("checkpointLocation", f"{place}/checkpoint")
            .trigger(**pipeline.DRAIN)
            .start()
        )
        query.awaitTermination()
    finally:
        spark.conf.set(STATE_STORE, before)
    found = spark.read.schema(batches.schema).parquet(f"{place}/out").where("key = 'k'").collect()
    assert sum(row.batch_rows for row in found) == 50
    assert all((row.batch_rows == 10) == (row.release == "count") for row in found)
    if shards == 1:
        assert sorted(row.batch_rows for row in found) == [10] * 5


def test_a_long_session_is_numbered_in_runs(spark, place, monkeypatch):
    """Batch numbers are gapless where a session has more batches than a run, or exactly as many."""
    monkeypatch.setattr(batching, "RUN", 4)
    start = datetime(2024, 1, 1)
    rows = [("long", start + timedelta(seconds=i)) for i in range(21)]
    rows += [("even", start + timedelta(seconds=i)) for i in range(16)]
    rows.append(("end", start + timedelta(days=1)))
    spark.createDataFrame(rows, "key string, ts timestamp_ntz").coalesce(1).write.parquet(f"{place}/in")
    stream = stream_rows(spark, f"{place}/in", spark.read.parquet(f"{place}/in").schema)
    batches = batching.session_batches(stream, "key", "ts", 2, "1 minute", "1 second")
    run = (
        batches.writeStream.format("parquet")
        .option("path", f"{place}/out")
        .option("checkpointLocation", f"{place}/checkpoint")
        .trigger(**pipeline.DRAIN)
        .start()
    )
    run.awaitTermination()
    found = spark.read.schema(batches.schema).parquet(f"{place}/out").collect()
    assert sorted((r.key, r.batch_no, r.batch_rows) for r in found) == sorted(
        [("long", i, 2 if i < 10 else 1) for i in range(11)] + [("even", i, 2) for i in range(8)]
    )


def interleaved(spark, sf_dir, place):
    """The events in four files whose times overlap, read one file a micro-batch."""
    whole = spark.read.parquet(f"{sf_dir}/events.parquet")
    for part in range(4):
        rows = whole.where(F.pmod(F.xxhash64("event_id"), F.lit(4)) == part).coalesce(1)
        rows.write.parquet(f"{place}/events.parquet", mode="append")
    return f"{place}"


@pytest.mark.parametrize("name", ["stream_released_batches", "stream_session_batches", "stream_rate_5m"])
def test_result_does_not_depend_on_files_or_chunks(spark, sf_dir, place, monkeypatch, name):
    """Four interleaved files, one a micro-batch, in Arrow chunks of 100 rows."""
    folder = interleaved(spark, sf_dir, place)

    def one_file_a_batch(session, _):
        schema = session.read.parquet(f"{folder}/events.parquet").schema
        return stream_rows(session, f"{folder}/events.parquet", schema, max_files_per_trigger=1)

    monkeypatch.setattr(streams, "streamed_events", one_file_a_batch)
    chunk = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(chunk)
    spark.conf.set(chunk, "100")
    try:
        found = CATALOGUE[name](spark, sf_dir)
        assert difference(found, connect(sf_dir), ORACLES[name]) is None
    finally:
        spark.conf.set(chunk, before)
