from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from roadpulse.functions import times
from roadpulse.functions.text import preview, strip_driver_prefix
from roadpulse.operators import layout, parse
from roadpulse.operators.layout import TODAY



def day():
    return F.lit(date(2024, 5, 6))


@pytest.mark.parametrize(
    "template, expected",
    [
        ("", "date=2024-05-06"),
        ("   ", "date=2024-05-06"),
        (f"'date=' + {TODAY}", "date=2024-05-06"),
        (f"{TODAY} + '/' + payload.driverId", "2024-05-06/unknown"),
        ("'driver=' + payload.driver_id", "driver=unknown"),
        ("'plain'", "plain"),
    ],
)
def test_path_without_a_message(spark, template, expected):
    path = layout.partition_path(template, None, day())
    assert spark.range(1).select(path.alias("p")).first().p == expected


def test_path_with_a_message(texts):
    frame = parse.parsed(
        texts(
            '{"driver_id":"DRIVER-730","vehicle_id":7,"policy_id":null}',
            '{"driver_id":730}',
            "not-json",
        )
    )
    template = "'d=' + payload.driver_id + '/v=' + payload.vehicle_id + '/p=' + payload.policy_id"
    path = layout.partition_path(template, F.col("message"), day())
    assert [row.p for row in frame.select(path.alias("p")).collect()] == [
        "d=730/v=7/p=unknown",
        "d=730/v=unknown/p=unknown",
        "d=unknown/v=unknown/p=unknown",
    ]


def test_prefix_is_only_stripped_from_the_front(spark):
    frame = spark.createDataFrame([("DRIVER-1",), ("X-DRIVER-1",), ("DRIVER-DRIVER-1",)], "v string")
    found = frame.select(strip_driver_prefix(F.col("v")).alias("v")).collect()
    assert [row.v for row in found] == ["1", "X-DRIVER-1", "DRIVER-1"]


def test_preview(texts):
    rows = texts("short", "x" * 150).select(preview(F.col("value")).alias("p")).collect()
    assert [row.p for row in rows] == ["short...", "x" * 100 + "..."]


@pytest.mark.parametrize(
    "given, expected",
    [
        ("2025-03-02T08:00:01.500Z", 1740902401500),
        ("2025-03-02T08:00:01.500+02:00", 1740895201500),
        ("1740902401", 1740902401000),
        ("1740902401500", 1740902401500),
        (" 1740902401 ", 1740902401000),
        ("nonsense", None),
        (None, None),
    ],
)
def test_event_time(spark, given, expected):
    frame = spark.createDataFrame([(given,)], "t string")
    assert frame.select(times.epoch_millis(F.col("t")).alias("ms")).first().ms == expected


def test_file_label(spark):
    frame = spark.sql("SELECT timestamp_ntz'2025-03-02 08:00:01.500' AS ts")
    label = layout.file_label(F.col("ts"), F.lit("node-7"), F.lit("writer-A"))
    assert frame.select(label.alias("l")).first().l == (
        "telemetry-20250302_080001-node-7-writer-A-1740902401500.parquet"
    )
