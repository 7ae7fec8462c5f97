"""The sliced order operators against plain loops, on data with hot keys, ties and NULL keys."""

from __future__ import annotations

from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from roadpulse.config import ArchiveConfig, RollConfig
from roadpulse.operators import batching
from roadpulse.operators.ordered import SLICE, ordered, with_index, with_row_number, with_running
from roadpulse.session import scratch_path
from roadpulse.sinks import sizing

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def rows():
    """A third of the rows on one key, many on one moment, some with NULL key or amount."""
    made = []
    for i in range(900):
        key = "hot" if i % 3 == 0 else (None if i % 50 == 1 else f"k{i % 7}")
        moment = START + timedelta(seconds=0 if i % 4 == 0 else (i * 37) % 5000)
        made.append((i, key, moment, None if i % 11 == 0 else i % 13))
    return made


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(
        rows, "id bigint, key string, ts timestamp_ntz, amount bigint"
    ).repartition(5)


def by_key(rows):
    groups = defaultdict(list)
    for row in sorted(rows, key=lambda row: (row[2], row[0])):
        groups[row[1]].append(row)
    return groups


@pytest.mark.parametrize("slices", [1, 3, 16])
def test_index_is_dense(frame, rows, slices):
    indexed = with_index(frame.select("id", "ts"), ("ts", "id"), slices=slices).collect()
    expected = [row[0] for row in sorted(rows, key=lambda row: (row[2], row[0]))]
    assert [row.id for row in sorted(indexed, key=lambda row: row["index"])] == expected
    assert sorted(row["index"] for row in indexed) == list(range(len(rows)))


@pytest.mark.parametrize("slices", [1, 4, 32])
def test_row_numbers_and_totals(frame, rows, slices):
    data = ordered(frame.select("id", "key", "ts"), ("ts", "id"), ("key",), slices)
    found = {row.id: (row.n, row.all) for row in with_row_number(data, "n", "all").collect()}
    expected = {
        row[0]: (place + 1, len(group))
        for group in by_key(rows).values()
        for place, row in enumerate(group)
    }
    assert found == expected


@pytest.mark.parametrize("slices", [1, 4, 32])
def test_running_values(frame, rows, slices):
    data = ordered(frame, ("ts", "id"), ("key",), slices)
    running = with_running(
        data,
        sums={"total": "amount"},
        maxes={"top": "amount"},
        previous="before",
        first="opened",
        count="n",
    ).result()
    found = {
        row.id: (row.total, row.top, row.before, row.opened, row.n) for row in running.collect()
    }
    expected = {}
    for group in by_key(rows).values():
        for place, row in enumerate(group):
            amounts = [r[3] for r in group[: place + 1] if r[3] is not None]
            expected[row[0]] = (
                sum(amounts) if amounts else None,
                max(amounts, default=None),
                group[place - 1][2] if place else None,
                group[0][2],
                place + 1,
            )
    assert found == expected


def test_a_hot_key_is_spread_over_slices(spark):
    hot = spark.range(60000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("key"),
        F.lit(START).cast("timestamp_ntz").alias("ts"),
    )
    data = ordered(hot, ("ts", "id"), ("key",), slices=12)
    sizes = [row["count"] for row in data.rows.groupBy(SLICE).count().collect()]
    assert sum(sizes) == 60000 and len(sizes) == 12 and max(sizes) < 2 * 60000 / 12
    assert data.rows.where("key = 'hot'").select(SLICE).distinct().count() >= 3


def test_writers_take_turns_and_restart_with_each_batch(spark):
    frame = spark.range(25).select(F.col("id"))
    rows = batching.assign_writers(frame, ("id",), writers=3, intake_batch=10).collect()
    found = {row.id: (row.intake_batch, row.writer_id) for row in rows}
    assert found == {i: (i // 10, "writer-" + "ABC"[i % 10 % 3]) for i in range(25)}


def sequential_batches(times, size, idle):
    """Messages arriving one by one: a batch is sent when full or when the key stays quiet."""
    sent, held = [], []
    for moment in times:
        if held and moment - held[-1] > idle:
            sent.append((len(held), "idle"))
            held = []
        held.append(moment)
        if len(held) == size:
            sent.append((size, "count"))
            held = []
    return sent + ([(len(held), "idle")] if held else [])


@pytest.mark.parametrize("slices", [1, 8])
def test_count_or_idle_batches_equal_one_by_one_arrival(frame, rows, slices):
    idle = timedelta(seconds=20)
    batches = batching.count_idle_batches(
        frame, ("key",), "ts", "id", 4, int(idle.total_seconds() * 1e6), slices
    ).collect()
    found = defaultdict(list)
    for row in sorted(batches, key=lambda row: (row.session, row.batch_no)):
        found[row.key].append((row.batch_rows, row.release))
    expected = {
        key: sequential_batches([row[2] for row in group], 4, idle)
        for key, group in by_key(rows).items()
    }
    assert found == expected


def test_batches_without_idle_limit_stay_pending(frame, rows):
    batches = batching.count_idle_batches(frame, ("key",), "ts", "id", 4, None).collect()
    assert sum(row.batch_rows for row in batches) == len(rows)
    assert all((row.release == "count") == (row.batch_rows == 4) for row in batches)
    assert {row.release for row in batches} == {"count", "pending"}


def test_rolled_files_keep_every_row(spark, frame, rows):
    roll = RollConfig(max_age_minutes=30, max_rows=40)
    config = ArchiveConfig(scratch_path(spark, "rolled"), ("key",), roll=roll)
    sizing.write_sized(frame, config, "ts", "id")
    files = sizing.file_table(spark, config.path, "ts").collect()
    assert sum(row.file_rows for row in files) == len(rows)
    assert max(row.file_rows for row in files) == 40
    assert all((row.last_ts - row.first_ts).total_seconds() <= 1800 for row in files)


def test_roll_reason_prefers_size_then_rows_then_age(spark):
    roll = RollConfig(max_age_minutes=1, max_rows=3, max_size_mb=100 / (1024 * 1024))
    cases = [(1, 100, 0), (1, 101, 0), (3, 100, 0), (3, 101, 9**9), (1, 1, 60_000_001), (3, 1, 9**9)]
    frame = spark.createDataFrame(cases, "n bigint, size bigint, age bigint")
    reason = batching.roll_reason(F.col("n"), F.col("size"), F.col("age"), roll)
    assert [row[0] for row in frame.select(reason).collect()] == [
        None, "file size", "message count", "file size", "age", "message count",
    ]


def test_no_rows_give_no_rows(frame):
    empty = frame.where("id < 0")
    assert with_index(empty.select("id", "ts"), ("ts", "id")).count() == 0
    assert batching.count_idle_batches(empty, ("key",), "ts", "id", 4, 1000).count() == 0
    assert batching.assign_writers(empty, ("id",)).count() == 0
