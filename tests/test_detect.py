from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from roadpulse.config import DetectorConfig
from roadpulse.operators import detect, parse

# Message: (parses for the detector, is an accident at threshold 5).
MESSAGES = {
    '{"g_force": 6.2}': (True, True),
    '{"g_force":1.2,"policy_id":1}': (True, False),
    '{"g_force":5.0}': (True, False),
    '{"g_force":6.5,"sensors":{"gps":{"latitude":1}}}': (True, True),
    '{"g_force":"6.2"}': (True, True),
    '{"g_force":" 6.2 "}': (True, True),
    '{"g_force":true}': (True, False),
    '{"g_force":"NaN"}': (True, False),
    '{"g_force":NaN}': (False, False),
    '{"g_force":null}': (True, False),
    '{"g_force":{"x":9}}': (True, False),
    '{"g_force":[9]}': (True, False),
    '{"g_force":"abc"}': (True, False),
    '{"g_force":6.2} tail': (True, True),
    '{"g_force":1,"g_force":9}': (True, True),
    '{"g_force":9,"g_force":null}': (True, False),
    '{"G_FORCE":9}': (True, False),
    '{"g_force":9,': (False, False),
    "{'g_force':9}": (False, False),
    '[{"g_force":9}]': (True, False),
    "not-json": (False, False),
    "": (True, False),
    "42": (True, False),
    "null": (True, False),
    "{}": (True, False),
}


def test_filter_keeps_accidents_unchanged(texts):
    kept = {row.value for row in detect.accident_filter(texts(*MESSAGES)).collect()}
    assert kept == {text for text, (_, accident) in MESSAGES.items() if accident}


def test_marks_agree_with_the_filter(texts):
    rows = detect.detected(texts(*MESSAGES)).collect()
    assert {row.value: (row.is_valid, row.is_accident) for row in rows} == MESSAGES


def test_one_parse_gives_the_same_marks_and_record(texts):
    """Beside a column of the messages that is named like a record field."""
    named = texts(*MESSAGES, None).withColumn("vin", F.lit("own"))
    rows = detect.detected_record(named).collect()
    assert {r.value: (r.is_valid, r.is_accident) for r in rows} == MESSAGES | {None: (False, False)}
    assert {r.vin for r in rows} == {"own"}
    typed = parse.typed_record(texts(*MESSAGES, None), keep=("value",)).collect()
    alone = {r.value: str(tuple(r)[1:]) for r in typed}
    assert {r.value: str(tuple(r.record)) for r in rows} == alone


def test_negative_threshold_takes_valid_messages_only(texts):
    kept = detect.accident_filter(texts(*MESSAGES), DetectorConfig(threshold=-1.0)).collect()
    nan = '{"g_force":"NaN"}'
    assert {row.value for row in kept} == {
        text for text, (valid, _) in MESSAGES.items() if valid and text != nan
    }


@pytest.mark.parametrize("consumer", parse.CONSUMERS)
def test_split_loses_no_message(consumer, texts):
    accepted, rejected = parse.split_valid(texts(*MESSAGES), consumer)
    good = {row.value for row in accepted.collect()}
    bad = {row.value for row in rejected.collect()}
    assert good | bad == set(MESSAGES) and not good & bad
    if consumer == "map":
        assert {"", "42", "null", '[{"g_force":9}]', "not-json"} <= bad
    else:
        assert good == {text for text, (valid, _) in MESSAGES.items() if valid}


def test_null_text_is_rejected(spark):
    frame = spark.createDataFrame([(None,)], "value string")
    accepted, rejected = parse.split_valid(frame, "archive")
    assert (accepted.count(), rejected.count()) == (0, 1)


def test_sample_takes_normal_messages_only(spark):
    frame = spark.range(4000).select(
        F.col("id"), F.format_string('{"g_force": %d}', F.col("id") % 10).alias("value")
    )
    config = DetectorConfig(5.0, sample_rate=0.25)
    first = {row.id for row in detect.normal_sample(frame, config, key="id").collect()}
    again = {row.id for row in detect.normal_sample(frame, config, key="id").collect()}
    assert first == again and all(i % 10 <= 5 for i in first)
    assert 450 < len(first) < 750
    drawn = detect.normal_sample(frame, config, seed=7).count()
    assert 450 < drawn < 750


def test_bytes_and_lists_of_payloads(spark):
    rows = [(bytearray(b'{"a":1}'), kind) for kind in ("application/json", "text/plain", None)]
    rows.append((bytearray(b"\x00"), "application/octet-stream"))
    frame = spark.createDataFrame(rows, "payload binary, content_type string")
    decoded = parse.decoded(frame, content_type="content_type").collect()
    assert [row.value for row in decoded] == ['{"a":1}'] * 3 + [None]
    assert bytes(decoded[3].payload) == b"\x00"
    listed = spark.createDataFrame([([bytearray(b"x"), bytearray(b"y")],)], "payloads array<binary>")
    single = parse.decoded(parse.exploded_payloads(listed)).collect()
    assert [row.value for row in single] == ["x", "y"]
