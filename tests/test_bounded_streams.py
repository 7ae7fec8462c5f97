"""Streams whose state is bounded by time: batches beside their late rows, and the live recent count."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from roadpulse.plans.streams import ROCKS_DB, STATE_STORE
from roadpulse.session import scratch_path
from roadpulse.sources.messages import stream_rows
from roadpulse.streaming import bounded, pipeline
from roadpulse.streaming.recent import live_buckets, start_recent, stored_recent

START = datetime(2024, 1, 1)
SCHEMA = "id bigint, key string, ts timestamp_ntz"


@pytest.fixture
def place(spark):
    return scratch_path(spark, "bounded-test")


@pytest.fixture
def rocks_db(spark):
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKS_DB)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set(STATE_STORE, before)
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def arrive(spark, place, rows):
    """Appends rows (id, key, seconds after the start; None for no time) as one file."""
    timed = [(i, key, None if s is None else START + timedelta(seconds=s)) for i, key, s in rows]
    spark.createDataFrame(timed, SCHEMA).coalesce(1).write.mode("append").parquet(f"{place}/in")


def drain(spark, place, late_by="2 minutes", size=3, idle_ms=30_000):
    rows = stream_rows(spark, f"{place}/in", spark.createDataFrame([], SCHEMA).schema)
    batches = bounded.bounded_batches(rows, "key", "ts", size, idle_ms, late_by, F.col("id"))
    run = bounded.start_bounded_batches(batches, f"{place}/out", f"{place}/checkpoint", pipeline.DRAIN)
    run.awaitTermination()
    return run


def seconds(moment):
    return (moment - START).total_seconds()


def test_batches_and_late_rows_are_all_rows(spark, place, rocks_db):
    """A hot key, out-of-order, repeated, null-key, late and untimed rows over restarts."""
    arrive(spark, place, [(1, "hot", 70), (2, "hot", 10), (3, "hot", 10), (4, None, 20), (5, "hot", None)])
    drain(spark, place)
    arrive(spark, place, [(6, "hot", 15), (7, "hot", 400), (8, "cold", 300)])
    drain(spark, place)
    arrive(spark, place, [(9, "hot", 100), (10, "cold", 279), (11, "cold", 281), (12, "end", 2000)])
    drain(spark, place)
    late = {(r.row_id, r.release) for r in bounded.late_rows(spark, f"{place}/out").collect()}
    assert late == {("5", "untimed"), ("9", "late"), ("10", "late")}
    found = sorted(
        (str(r.key), seconds(r.first_ts), seconds(r.last_ts), r.batch_rows, r.release)
        for r in bounded.stored_batches(spark, f"{place}/out").collect()
    )
    assert found == [
        ("None", 20, 20, 1, "idle"),
        ("cold", 281, 300, 2, "idle"),
        ("hot", 10, 15, 3, "count"),
        ("hot", 70, 70, 1, "idle"),
        ("hot", 400, 400, 1, "idle"),
    ]
    assert sum(row[3] for row in found) + len(late) + 1 == 12  # the last row's batch is open


def test_a_quiet_batch_goes_on_in_a_bucket_that_is_not_over(spark, place, rocks_db):
    """The watermark is past the idle limit of the batch, but its next row waits in the open bucket."""
    arrive(spark, place, [(1, "k", 50), (2, "k", 75)])
    arrive(spark, place, [(3, "other", 215)])
    drain(spark, place)  # the watermark comes to 95: bucket [0, 60) is over, 50 + 30 is passed
    assert bounded.stored_batches(spark, f"{place}/out").count() == 0
    arrive(spark, place, [(4, "k", 100), (5, "other", 900)])
    drain(spark, place)
    batches = bounded.stored_batches(spark, f"{place}/out").where("key = 'k'").collect()
    assert [(r.batch_rows, seconds(r.first_ts), seconds(r.last_ts)) for r in batches] == [(3, 50, 100)]


def test_state_does_not_grow_with_the_stream(spark, place, rocks_db):
    sizes = []
    for step in range(4):
        begin = step * 1800
        arrive(spark, place, [(begin + s, "k", begin + s) for s in range(0, 1800, 2)])
        last = drain(spark, place).lastProgress
        sizes.append(last.stateOperators[0].numRowsTotal)
    # Buckets and timers of two minutes and a minute begun, an open batch and its timer.
    assert max(sizes) <= 2 * 4 + 2, sizes
    out = bounded.stored_batches(spark, f"{place}/out")
    assert out.where("release <> 'count'").isEmpty()
    assert bounded.late_rows(spark, f"{place}/out").isEmpty()
    assert 4 * 900 - 180 / 2 - 3 <= out.agg(F.sum("batch_rows")).first()[0] <= 4 * 900


def test_without_rows_there_are_no_batches(spark, place, rocks_db):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{place}/in")
    drain(spark, place)
    assert bounded.stored_batches(spark, f"{place}/out").isEmpty()
    assert bounded.late_rows(spark, f"{place}/out").isEmpty()


def test_live_recent_count_equals_the_batch_query_after_each_batch(spark, place):
    """Late, repeated, null and untimed rows, a jump in time, and a quiet micro-batch."""
    parts = [
        [(i, "a" if i % 3 else None, i) for i in range(200)],
        [(900, "late", 40), (901, "b", 300), (902, "b", 300), (903, "b", None), (904, "b", 45)],
        [(905, "late", 1), (906, "b", 359)],
        [(907, "c", None)],
        [(908, "c", 5000)],
    ]
    for part in parts:
        arrive(spark, place, part)
        rows = stream_rows(spark, f"{place}/in", spark.createDataFrame([], SCHEMA).schema)
        start_recent(rows, "ts", ("key",), f"{place}/live", f"{place}/checkpoint").awaitTermination()
        live = stored_recent(spark, f"{place}/live", "key string", ("key",)).collect()
        so_far = spark.read.parquet(f"{place}/in")
        newest = so_far.agg(F.max("ts")).first()[0]
        recent = so_far.where(F.col("ts") > F.lit(newest - timedelta(minutes=5)))
        plain = recent.groupBy("key").agg(F.count(F.lit(1)).alias("events")).collect()
        assert sorted(map(str, live)) == sorted(map(str, plain))
        assert len(live_buckets(spark, f"{place}/live")) <= 6


def test_live_recent_count_repeats_nothing_when_a_batch_is_run_again(spark, place):
    arrive(spark, place, [(i, "a", i) for i in range(100)])
    rows = stream_rows(spark, f"{place}/in", spark.createDataFrame([], SCHEMA).schema)
    for checkpoint in ("first", "again"):  # a new checkpoint gives the same rows the same batch number
        start_recent(rows, "ts", ("key",), f"{place}/live", f"{place}/{checkpoint}").awaitTermination()
    assert stored_recent(spark, f"{place}/live", "key string", ("key",)).first().events == 100


def test_live_recent_count_of_nothing_is_empty(spark, place):
    assert stored_recent(spark, f"{place}/live", "key string", ("key",)).isEmpty()
