"""The events table distributed by vehicle: even buckets, no exchange, hot and null vehicles."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from roadpulse.session import scratch_path
from roadpulse.sinks import vehicle_table

TOTALS = {"n": ("count", "event_id"), "total": ("sum", "event_id"), "low": ("min", "event_id"), "high": ("max", "event_id")}


def events(spark, n, vehicle):
    time = F.timestamp_seconds(F.col("id") % 500)
    return spark.range(n).select(F.col("id").alias("event_id"), vehicle.cast("int").alias("vehicle_id"), time.alias("event_time"))


@pytest.fixture
def saved(spark):
    def save(rows, bucket_rows=100):
        path, name = scratch_path(spark, "by-vehicle"), f"by_vehicle_{uuid.uuid4().hex}"
        return vehicle_table.save_by_vehicle(rows, name, path, bucket_rows), name, path

    return save


def result(spark, name):
    return sorted(map(tuple, vehicle_table.per_vehicle(spark, name, TOTALS).collect()), key=str)


def plain(rows):
    found = rows.groupBy("vehicle_id").agg(F.count("event_id"), F.sum("event_id"), F.min("event_id"), F.max("event_id"))
    return sorted(map(tuple, found.collect()), key=str)


def exchanges(frame):
    return frame._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_buckets_follow_the_volume_and_need_no_exchange(spark, saved):
    rows = events(spark, 3_000, F.col("id") % 97)
    buckets, name, _ = saved(rows)
    assert buckets == 32
    assert saved(events(spark, 6_000, F.col("id") % 97))[0] == 64
    assert exchanges(vehicle_table.per_vehicle(spark, name, TOTALS)) == 0
    assert result(spark, name) == plain(rows)


@pytest.mark.parametrize("hot", [5, None])
def test_a_hot_vehicle_lies_in_several_files(spark, saved, hot):
    rows = events(spark, 3_000, F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.col("id") % 97))
    _, name, _ = saved(rows)
    stored = spark.table(name).where(F.col("vehicle_id").eqNullSafe(F.lit(hot).cast("int")))
    files = stored.groupBy(F.col("_metadata.file_path")).count().collect()
    assert len(files) > 3 and max(row["count"] for row in files) < 400
    assert exchanges(vehicle_table.per_vehicle(spark, name, TOTALS)) == 1
    assert result(spark, name) == plain(rows)


def test_buckets_follow_the_volume_in_small_steps(spark, saved):
    rows = events(spark, 4_000, F.col("id") % 97)
    buckets, name, _ = saved(rows)
    assert buckets == 48 and result(spark, name) == plain(rows)
    files = spark.table(name).select(F.col("_metadata.file_path")).distinct().count()
    assert files <= buckets and vehicle_table.writing_tasks(48, 100) == 3
    assert vehicle_table.writing_tasks(48, vehicle_table.BUCKET_ROWS) == 48


def test_totals_with_a_hot_vehicle_scan_the_table_once(spark, saved):
    rows = events(spark, 3_000, F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") % 97))
    _, name, _ = saved(rows)
    plan = vehicle_table.per_vehicle(spark, name, TOTALS)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == 1


def test_the_events_are_computed_once(spark, saved):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = events(spark, 500, F.col("id") % 7)
    saved(rows.mapInArrow(counted, rows.schema))
    assert seen.value == 500


def test_empty_and_repeated_rows(spark, saved):
    buckets, name, _ = saved(events(spark, 0, F.col("id")))
    assert buckets == 1 and result(spark, name) == []
    repeated = events(spark, 1, F.col("id")).crossJoin(spark.range(250).select()).union(events(spark, 20, F.col("id")))
    _, name, _ = saved(repeated)
    assert result(spark, name) == plain(repeated)
