"""The lenient coercion rules, one case per kind of input."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from roadpulse.functions import json_fields as jf
from roadpulse.operators.parse import lenient_record, typed_record
from roadpulse.schema import ARCHIVE_SCHEMA, ARCHIVE_TYPES, FIELD_NAMES

KINDS = {"i": "int", "l": "bigint", "d": "double", "s": "string", "b": "boolean"}

# JSON value: what it reads as an int, a long, a double, a text and a boolean.
CASES = {
    "6.2": (6, 6, 6.2, "6.2", False),
    '"6.2"': (6, 6, 6.2, "6.2", False),
    '" 6.2 "': (6, 6, 6.2, " 6.2 ", False),
    "true": (1, 1, 1.0, "true", True),
    "false": (0, 0, 0.0, "false", False),
    '"true"': (0, 0, 0.0, "true", True),
    '"yes"': (0, 0, 0.0, "yes", False),
    '"abc"': (0, 0, 0.0, "abc", False),
    '""': (0, 0, 0.0, "", False),
    "1": (1, 1, 1.0, "1", True),
    "0": (0, 0, 0.0, "0", False),
    "3.9": (3, 3, 3.9, "3.9", False),
    "-3.9": (-3, -3, -3.9, "-3.9", False),
    "100.0": (100, 100, 100.0, "100.0", False),
    "1e5": (100000, 100000, 100000.0, "100000.0", False),
    "9999999999": (1410065407, 9999999999, 9999999999.0, "9999999999", True),
    "4294967301": (5, 4294967301, 4294967301.0, "4294967301", True),
    "-3e9": (-2147483648, -3000000000, -3e9, "-3.0E9", False),
    '"9999999999"': (0, 9999999999, 9999999999.0, "9999999999", False),
    '"+5"': (5, 5, 5.0, "+5", False),
    '"NaN"': (0, 0, math.nan, "NaN", False),
    '"INF"': (0, 0, 0.0, "INF", False),
    '{"a":1}': (0, 0, 0.0, "", False),
    "[1]": (0, 0, 0.0, "", False),
    "null": (None, None, None, None, None),
}


@pytest.fixture(scope="module")
def coerced(spark):
    rows = [
        (value, name, f'{{"{name}":{value}}}') for value in CASES for name in KINDS
    ]
    frame = spark.createDataFrame(rows, "given string, field string, value string")
    read = lenient_record(frame, KINDS, keep=("given", "field")).collect()
    return {(row.given, row.field): row[row.field] for row in read}


@pytest.mark.parametrize("value", CASES)
def test_lenient_value(value, coerced):
    for name, expected in zip(KINDS, CASES[value]):
        found = coerced[value, name]
        if isinstance(expected, float) and math.isnan(expected):
            assert math.isnan(found)
        else:
            assert found == expected and type(found) is type(expected), name


def test_quick_and_slow_reads_agree(spark):
    """The one-pass read gives exactly what the field-by-field read gives."""
    rows = [(f'{{"{name}":{value}}}',) for value in CASES for name in KINDS]
    frame = spark.createDataFrame(rows, "value string")
    message = jf.parse_message(F.col("value"))
    slow = frame.select(
        "value", *[jf.read_field(message, n, kind).alias(n) for n, kind in KINDS.items()]
    )
    quick = lenient_record(frame, KINDS, keep=("value",))
    assert sorted(map(str, quick.collect())) == sorted(map(str, slow.collect()))


def test_absent_field_is_null(texts):
    assert lenient_record(texts("{}"), KINDS).first() == (None,) * 5


def test_last_duplicate_key_wins(texts):
    row = lenient_record(texts('{"d":1,"d":9}', '{"d":"x","d":"7"}'), KINDS).select("d").collect()
    assert [r.d for r in row] == [9.0, 7.0]


def test_strict_mode_gives_null(texts):
    frame = texts('{"i":"abc"}')
    message = jf.parse_message(F.col("value"))
    assert frame.select(jf.read_field(message, "i", "int", "strict").alias("i")).first().i is None
    with pytest.raises(ValueError):
        jf.read_field(message, "i", "int", "other")


def test_record_has_the_33_columns(texts):
    record = typed_record(texts("{}"))
    assert len(FIELD_NAMES) == 33
    assert record.schema == ARCHIVE_SCHEMA


FULL = (
    '{"policy_id":510,"vehicle_id":620,"vin":"TESTVIN0000000001",'
    '"event_time":"2025-03-02T08:00:01.500Z","speed_mph":41.25,"speed_limit_mph":50,'
    '"g_force":0.75,"driver_id":730,"gps_latitude":48.125,"gps_longitude":11.5,'
    '"device_battery_level":64,"device_charging":true,"extra":{"a":[1,2]}}'
)


def test_sparse_message_fills_the_rest_with_null(texts):
    row = typed_record(texts(FULL)).first().asDict()
    given = {name: value for name, value in row.items() if value is not None}
    assert given == {
        "policy_id": 510,
        "vehicle_id": 620,
        "vin": "TESTVIN0000000001",
        "event_time": "2025-03-02T08:00:01.500Z",
        "speed_mph": 41.25,
        "speed_limit_mph": 50,
        "g_force": 0.75,
        "driver_id": 730,
        "gps_latitude": 48.125,
        "gps_longitude": 11.5,
        "device_battery_level": 64,
        "device_charging": True,
    }


def test_messages_without_known_keys_are_all_null(texts):
    frame = texts('{"id":1}', "", "42", "[1]", "null", '[{"policy_id":1}]', '{"POLICY_ID":1}')
    for row in typed_record(frame).collect():
        assert set(row.asDict().values()) == {None}


def test_nested_legacy_message_keeps_only_flat_fields(texts):
    value = (
        '{"policy_id":510,"timestamp":"2025-03-02T08:00:01.500Z","g_force":0.75,'
        '"sensors":{"gps":{"latitude":48.125}}}'
    )
    row = typed_record(texts(value)).first().asDict()
    assert {k: v for k, v in row.items() if v is not None} == {"policy_id": 510, "g_force": 0.75}


def test_strict_record_reads_good_messages_alike(texts):
    frame = texts(FULL)
    assert typed_record(frame).first() == typed_record(frame, mode="strict").first()
    assert list(ARCHIVE_TYPES) == list(FIELD_NAMES)
