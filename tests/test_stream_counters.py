"""Counters of the archive's commits and mergeable quantiles of a stream."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadpulse.config import ArchiveConfig
from roadpulse.operators import metrics
from roadpulse.session import scratch_path
from roadpulse.sinks import commits
from roadpulse.sinks.archive import read_archive
from roadpulse.sources.messages import stream_rows
from roadpulse.streaming import counted, pipeline
from roadpulse.streaming.metrics import start_duration_sketches, stored_quantiles

TOTALS = ("batches", "messages_received", "messages_rejected", "messages_written", "batch_failures")


@pytest.fixture
def place(spark):
    return scratch_path(spark, "counter-test")


def messages(spark, start, end, valid=True):
    """Messages of one day; every tenth is no JSON."""
    text = F.format_string('{"driver_id": "%d", "g_force": 1.0}', F.col("id"))
    broken = (F.col("id") % 10 == 0) | F.lit(not valid)
    return spark.range(start, end).select(
        F.lit("2024-03-01 00:00:00").cast("timestamp").alias("ts"),
        F.when(broken, F.lit("no json")).otherwise(text).alias("value"),
    )


def totals(spark, path):
    row = counted.sink_totals(spark, path).first()
    return tuple(row[name] for name in TOTALS)


def agrees_with_files(spark, path):
    """The counters of rows, files and bytes are those of the files that count."""
    row = counted.sink_totals(spark, path).first()
    files = commits.read(spark, path, files=True).groupBy("file_path").agg(
        F.count(F.lit(1)).alias("n"), F.max("file_size").alias("size")
    )
    found = files.agg(F.sum("n"), F.count(F.lit(1)), F.sum("size")).first()
    return tuple(found) == (row.messages_written, row.files_created, row.bytes_written)


@pytest.mark.parametrize("columns", [("date",), ("date", "driver_id")])
def test_counters_are_those_of_the_files(spark, place, columns):
    config = ArchiveConfig(place, columns)
    write = counted.counted_archive(config)
    write(messages(spark, 0, 40), 0)
    write(messages(spark, 40, 60), 1)
    assert totals(spark, place) == (2, 60, 6, 54, 0)
    assert agrees_with_files(spark, place)


def test_a_failed_write_is_counted_and_tried_again(spark, place):
    config, tries = ArchiveConfig(place), []
    put = counted.parquet_store(config)

    def unsteady(records, folder):
        tries.append(folder)
        if len(tries) == 1:
            put(records.limit(3), folder)  # half a write, then the failure
            raise OSError("the disk is gone")
        put(records, folder)

    counted.counted_archive(config, store=unsteady)(messages(spark, 0, 20), 0)
    assert totals(spark, place) == (1, 20, 2, 18, 1)
    assert read_archive(spark, place).count() == 18
    assert agrees_with_files(spark, place)


def test_counters_outlast_a_stream_that_gave_up(spark, place):
    config = ArchiveConfig(place)
    put = counted.parquet_store(config)

    def broken(records, folder):
        raise OSError("the disk is gone")

    counted.counted_archive(config)(messages(spark, 0, 20), 0)
    with pytest.raises(OSError):
        counted.counted_archive(config, max_attempts=3, store=broken)(messages(spark, 20, 30), 1)
    assert totals(spark, place) == (1, 20, 2, 18, 3)
    again = counted.counted_archive(config, store=put)
    again(messages(spark, 20, 30), 1)
    again(messages(spark, 20, 30), 1)  # delivered once more after its commit
    assert totals(spark, place) == (2, 30, 3, 27, 3)
    assert agrees_with_files(spark, place)


def test_a_write_lost_before_its_commit_does_not_count(spark, place, monkeypatch):
    config = ArchiveConfig(place)
    write = counted.counted_archive(config)
    write(messages(spark, 0, 10), 0)
    with monkeypatch.context() as patch:

        def lost(*_):
            raise SystemExit("the driver is gone")

        patch.setattr(counted.commits, "commit", lost)
        with pytest.raises(SystemExit):
            write(messages(spark, 10, 20), 1)
    assert totals(spark, place) == (1, 10, 1, 9, 0)
    write(messages(spark, 10, 20), 1)
    assert totals(spark, place) == (2, 20, 2, 18, 0)
    outcomes = counted.sink_log(spark, place).groupBy("outcome").count().collect()
    assert {row.outcome: row["count"] for row in outcomes} == {"written": 2, "lost": 1}
    assert agrees_with_files(spark, place)


def test_a_batch_without_valid_messages_counts_once(spark, place):
    write = counted.counted_archive(ArchiveConfig(place))
    write(messages(spark, 0, 10), 0)
    for _ in range(2):
        write(messages(spark, 10, 15, valid=False), 1)
    write(messages(spark, 0, 0), 2)
    assert totals(spark, place) == (2, 15, 6, 9, 0)
    assert agrees_with_files(spark, place)


def test_two_streams_share_an_archive(spark, place):
    config = ArchiveConfig(place)
    for source in ("north", "south"):
        counted.counted_archive(config, source)(messages(spark, 0, 10), 0)
    assert totals(spark, place) == (2, 20, 2, 18, 0)


def durations(spark, n):
    """Heavily spread durations over two windows, in a fixed pseudo-random order."""
    return spark.range(n).select(
        (F.col("id") % 2 * 300).cast("timestamp").alias("ts"),
        F.exp(F.pmod(F.xxhash64("id"), F.lit(20_000)) / 1000.0).cast("bigint").alias("duration"),
    )


def test_stream_quantiles_are_near_exact_and_mergeable(spark, place):
    rows = durations(spark, 40_000)
    for part in range(3):
        rows.where(F.pmod(F.col("duration"), F.lit(3)) == part).coalesce(1).write.mode("append").parquet(f"{place}/in")
    stream = stream_rows(spark, f"{place}/in", rows.schema, max_files_per_trigger=1)
    start_duration_sketches(
        stream, "ts", "duration", (), f"{place}/out", f"{place}/ck", trigger=pipeline.DRAIN
    ).awaitTermination()
    assert spark.read.parquet(f"{place}/out").select("batch_id").distinct().count() == 3
    held = rows.toPandas()
    for seconds, windows in ((300, held.groupby("ts")), (600, [(None, held)])):
        found = stored_quantiles(spark, f"{place}/out", (0.5, 0.95, 0.99), (), seconds).orderBy("window_start").collect()
        assert len(found) == len(windows)
        for row, (_, group) in zip(found, windows):
            ordered = np.sort(group["duration"].to_numpy())
            assert row.n == len(ordered)
            for q in (0.5, 0.95, 0.99):
                exact = ordered[int(np.ceil(q * len(ordered))) - 1]
                assert abs(row[metrics.quantile_name(q)] - exact) <= exact / 256
    buckets = metrics.merged_sketch(spark.read.parquet(f"{place}/out"), (), 600).count()
    assert buckets < held["duration"].nunique()


def test_sketch_of_awkward_durations(spark):
    rows = spark.createDataFrame(
        [(1, 0), (1, -5), (1, 1), (1, 2**62), (1, 2**63 - 1), (1, None), (None, 7)], "ts int, d bigint"
    ).withColumn("ts", F.timestamp_seconds("ts"))
    sketch = metrics.duration_sketch(rows, "ts", "d", (), 300)
    assert {row.bucket: row.n for row in sketch.collect()} == {0: 2, 1: 1, 2**62: 1, 255 * 2**55: 1}
    assert metrics.duration_sketch(rows.limit(0), "ts", "d", (), 300).count() == 0
    one = metrics.sketch_quantiles(sketch, (0.5,), ()).first()
    assert (one.n, one.p50) == (5, 1.0)
