from __future__ import annotations

import pytest

from roadpulse.config import DEFAULT_COLUMNS
from roadpulse.operators import mapping


@pytest.mark.parametrize(
    "spec, expected",
    [
        ("id:payload.id,message:payload.message", {"id": "payload.id", "message": "payload.message"}),
        ("a,b", {"a": "a", "b": "b"}),
        (" a : x , , b ", {"a": "x", "b": "b"}),
        ("policy_id,event_timestamp:timestamp", {"policy_id": "policy_id", "event_timestamp": "timestamp"}),
        (r"a:concat(x\,y),b", {"a": "concat(x,y)", "b": "b"}),
        (r"a:x\:y", {"a": "x:y"}),
        (r"a\:b", {"a:b": "a:b"}),
        ("a:", {"a": "a"}),
        ("a:1,a:2", {"a": "2"}),
        ("", {}),
        (DEFAULT_COLUMNS, {"payload": "payload.toString()"}),
    ],
)
def test_column_map(spec, expected):
    assert mapping.column_map(spec) == expected
    assert list(mapping.column_map(spec)) == list(expected)


def test_too_many_colons_is_an_error():
    with pytest.raises(ValueError, match="a:b:c"):
        mapping.column_map("a:b:c")


def test_mapped_columns(texts):
    frame = texts('{"a":1,"b":"x","c":null,"d":{"e":[1]},"f":1.50,"g":true}')
    row = mapping.mapped(frame, "one:a,b,c,d,f,g,gone").first()
    assert row.asDict() == {
        "one": "1", "b": "x", "c": None, "d": '{"e":[1]}', "f": "1.5", "g": "true", "gone": None,
    }


@pytest.fixture
def frame(spark):
    return spark.createDataFrame(
        [
            ('{"a":1,"b":null,"n":{"k":2}}', {"a": "header"}),
            ('{"a":1}', {"b": None}),
            ('{"b":5}', None),
        ],
        "value string, h map<string,string>",
    )


def test_first_place_that_has_the_name_wins(frame):
    rows = mapping.mapped_expressions(
        frame, {"a": "a", "b": "b", "only": "payload.a", "k": "payload.n.k"}, headers="h"
    ).collect()
    assert [tuple(row) for row in rows] == [
        ("header", None, "1", "2"),
        ("1", None, "1", None),
        (None, "5", None, None),
    ]


def test_sql_expressions_and_whole_payload(frame):
    rows = mapping.mapped_expressions(
        frame, {"x": "cast(payload.a as int) + 1", "text": "payload"}, headers="h"
    ).collect()
    assert [row.x for row in rows] == [2, 2, None]
    assert rows[2].text == '{"b":5}'


def test_present_null_is_not_a_missing_parameter(frame):
    counts = mapping.null_parameters(frame, {"a": "a", "b": "b", "c": "c"}, headers="h").collect()
    assert {row.column_name: row.null_parameters for row in counts} == {"a": 1, "b": 0, "c": 3}
    assert {row.messages for row in counts} == {3}


def test_composed_expressions_find_bare_names(frame):
    columns = {"x": "a || '-' || payload.a", "twice": "b * 2", "gone": "upper(nowhere)", "sure": "1 + 1"}
    rows = mapping.mapped_expressions(frame, columns, headers="h").collect()
    assert [(row.x, row.twice, row.gone, row.sure) for row in rows] == [
        ("header-1", None, None, 2), ("1-1", None, None, 2), (None, 10.0, None, 2),
    ]
    counts = mapping.null_parameters(frame, columns, headers="h").collect()
    missing = {row.column_name: row.null_parameters for row in counts}
    assert missing == {"x": 1, "twice": 0, "gone": 3, "sure": 0}


def test_a_mapping_key_is_taken_as_written(texts):
    frame = texts('{"a.b":1,"it\'s":2,"a":{"b":3}}', '{"a":{"b":3}}')
    rows = mapping.mapped(frame, {"dotted": "a.b", "quoted": "it's", "whole": "a"}).collect()
    assert [tuple(row) for row in rows] == [("1", "2", '{"b":3}'), (None, None, '{"b":3}')]


def test_a_value_that_fails_an_expression_gives_null(texts):
    frame = texts(
        '{"n":"x","big":"2147483647","zero":"0"}',
        '{"n":"7","big":"1","zero":"2"}',
        '{"n":null}',
        "{}",
    )
    columns = {
        "cast": "cast(n as int)",
        "same_cast": "cast(n as int) + 1",
        "implicit": "n + 1",
        "compared": "n > 3",
        "fallback": "coalesce(cast(n as int), -1)",
        "overflow": "cast(big as int) + 1",
        "negated": "-cast(big as int)",
        "ratio": "10 / zero",
        "rest": "10 % cast(zero as int)",
        "item": "array(1, 2)[cast(n as int)]",
        "listed": "transform(array(n), v -> cast(v as int))",
        "date": "to_date(n, 'yyyy-MM-dd')",
        "cased": "case when cast(n as int) > 5 then 'many' else 'few' end",
    }
    rows = [row.asDict() for row in mapping.mapped_expressions(frame, columns).collect()]
    bad, good, null, gone = rows
    assert bad == dict.fromkeys(columns) | {
        "fallback": -1, "negated": -2147483647, "listed": [None], "cased": "few"
    }
    assert good == {
        "cast": 7, "same_cast": 8, "implicit": 8.0, "compared": True, "fallback": 7, "overflow": 2,
        "negated": -1, "ratio": 5.0, "rest": 0, "item": None, "listed": [7], "date": None, "cased": "many",
    }
    assert null == gone == dict.fromkeys(columns) | {"fallback": -1, "listed": [None], "cased": "few"}


def test_expressions_leave_the_session_as_it_was(spark, texts):
    before = spark.conf.get("spark.sql.ansi.enabled")
    mapping.mapped_expressions(texts('{"n":"x"}'), {"x": "n * 2"}).collect()
    with pytest.raises(Exception, match="nowhere_function"):
        mapping.mapped_expressions(texts('{"n":"x"}'), {"x": "nowhere_function(n)"})
    assert spark.conf.get("spark.sql.ansi.enabled") == before
