"""Column mapping of the table loader: shorthand lists, expressions, fallbacks, null counts."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.config import DEFAULT_TABLE
from roadpulse.functions import json_fields as jf
from roadpulse.operators.lenient import with_lenient

# What ends an entry and what divides name and key (after the mark both are plain
# characters), and the expression that stands for the whole message text.
ENTRY_END, DIVIDER, PLAIN_MARK = ",", ":", "\\"
WHOLE_PAYLOAD = ("payload", "payload.toString()")

FIELD_PATH = re.compile(r"^[A-Za-z_]\w*(\.[A-Za-z_]\w*)*$")


def column_map(spec: str) -> dict[str, str]:
    """``"a:x,b"`` as ``{"a": "x", "b": "b"}``, in the order given; the last of equals wins.

    An entry is a name, or a name, a divider and a key; without a key the name is the key.
    """
    pairs: dict[str, str] = {}
    name, key, dividers, marked = "", "", 0, False
    for char in spec + ENTRY_END:
        if marked and char not in (ENTRY_END, DIVIDER):
            name, key = (name, key + PLAIN_MARK) if dividers else (name + PLAIN_MARK, key)
        if char == PLAIN_MARK:
            marked = True
            continue
        bare, marked = not marked, False
        if bare and char == DIVIDER:
            dividers += 1
        elif bare and char == ENTRY_END:
            if name.strip() or key.strip():
                pairs[name.strip()] = key.strip() or name.strip()
            name, key, dividers = "", "", 0
        elif dividers > 1 and char.strip():
            raise ValueError(f"{name}:{key}:{char}… is not a 'column:key' pair or a single column name")
        elif dividers:
            key += char
        else:
            name += char
    return pairs


def mapped(
    messages: DataFrame, columns: str | dict[str, str], value: str = "value", keep: tuple = ()
) -> DataFrame:
    """One text column per mapping entry, read from the message key; a missing key is NULL.

    A key is taken as it is written: ``a.b`` is the top-level key of that name.
    """
    pairs = column_map(columns) if isinstance(columns, str) else columns
    parsed = messages.withColumn("_message", jf.parse_message(F.col(value)))
    return parsed.select(
        *keep,
        *[jf.field_text(F.col("_message"), key, literal=True).alias(name) for name, key in pairs.items()],
    )


def message_frame(
    messages: DataFrame, value: str = "value", headers: str | None = None
) -> DataFrame:
    """Messages ready for column expressions.

    ``payload`` is the message as a map, so ``payload.vin`` works in Spark SQL expressions;
    ``payload_text`` is the message itself; ``headers`` is a map of message headers.
    """
    parsed = messages.withColumn("message", jf.parse_message(F.col(value)))
    header_map = (
        F.col(headers) if headers else F.lit(None).cast("map<string,string>")
    )
    return (
        parsed.withColumn(
            "payload", F.try_variant_get(F.col("message"), "$", "map<string,string>")
        )
        .withColumn("payload_text", F.col(value))
        .withColumn("headers", header_map)
    )


def _candidates(expression: str) -> list[tuple[str, str]]:
    """Places to look a plain name up, in order: as written, then inside the payload."""
    head, _, rest = expression.partition(".")
    if head in ("payload", "headers") and rest:
        return [(head, rest)]
    return [("headers", expression), ("payload", expression)]


def _found(place: str, key: str) -> Column:
    if place == "payload":
        return F.coalesce(jf.has_field(F.col("message"), key), F.lit(False))
    return F.coalesce(F.map_contains_key(F.col("headers"), F.lit(key)), F.lit(False))


def _value(place: str, key: str) -> Column:
    if place == "payload":
        return jf.field_text(F.col("message"), key)
    return F.col("headers").getItem(key)


def is_plain(expression: str) -> bool:
    return expression not in WHOLE_PAYLOAD and FIELD_PATH.match(expression) is not None


def _looked_up(expression: str) -> Column:
    """The value of the first place that has a plain name, even a null there."""
    chain = F
    for place, key in _candidates(expression):
        chain = chain.when(_found(place, key), _value(place, key))
    return chain.otherwise(F.lit(None).cast("string"))


def references(spark: SparkSession, expression: str) -> list[str]:
    """The column names in a Spark SQL expression, as Spark's own parser finds them."""
    leaves = spark._jsparkSession.sessionState().sqlParser().parseExpression(expression).collectLeaves()
    found = [leaves.apply(i) for i in range(leaves.size())]
    names = [leaf.nameParts() for leaf in found if leaf.getClass().getSimpleName() == "UnresolvedAttribute"]
    return [".".join(parts.apply(i) for i in range(parts.size())) for parts in names]


def _with_bare_names(frame: DataFrame, expressions: Iterable[str]) -> DataFrame:
    """Adds a column for each bare name that a composed expression uses and the frame lacks."""
    known = {name.lower() for name in frame.columns}
    wanted = {
        name
        for text in expressions
        if not is_plain(text) and text not in WHOLE_PAYLOAD
        for name in references(frame.sparkSession, text)
        if "." not in name and name.lower() not in known
    }
    return frame.withColumns({name: _looked_up(name) for name in sorted(wanted)}) if wanted else frame


def expression_column(expression: str) -> Column:
    """A mapping expression over a ``message_frame``.

    A plain name or path takes the first place that has it (even with a null there); the
    whole payload gives the text; anything else is a Spark SQL expression, in which a bare name
    that is no column stands for the header or field of that name, as text.
    """
    if expression in WHOLE_PAYLOAD:
        return F.col("payload_text")
    if not is_plain(expression):
        return F.expr(expression)
    return _looked_up(expression)


def is_missing(expression: str, names: Iterable[str] = ()) -> Column:
    """True when no place has the plain name or, of a composed expression, any of its ``names``."""
    if expression in WHOLE_PAYLOAD or not (is_plain(expression) or names):
        return F.lit(False)
    found = F.lit(False)
    for name in [expression] if is_plain(expression) else names:
        for place, key in _candidates(name):
            found = found | _found(place, key)
    return ~found


def _missing(frame: DataFrame, expression: str) -> Column:
    """``is_missing`` for an expression over this frame; its own columns are never missing."""
    if is_plain(expression) or expression in WHOLE_PAYLOAD:
        return is_missing(expression)
    own = {name.lower() for name in frame.columns} - {"payload", "headers"}
    names = references(frame.sparkSession, expression)
    if any(name.split(".")[0].lower() in own or name in ("payload", "headers") for name in names):
        return F.lit(False)
    return is_missing(expression, names)


def missing_count(frame: DataFrame, columns: str | dict[str, str]) -> Column:
    """How many of a message's parameters no expression has a value for."""
    pairs = column_map(columns) if isinstance(columns, str) else columns
    return reduce(add, [_missing(frame, text).cast("bigint") for text in pairs.values()])


def mapped_expressions(
    messages: DataFrame,
    columns: str | dict[str, str],
    value: str = "value",
    headers: str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One column for each mapping expression (see ``expression_column``).

    A composed expression that fails for a message (a text that is no number, an overflow, a division by
    zero) gives NULL there, or what its own ``coalesce`` falls back to; it never fails the batch.
    """
    pairs = column_map(columns) if isinstance(columns, str) else columns
    frame = _with_bare_names(message_frame(messages, value, headers), pairs.values())
    composed = {
        f"_composed_{i}": text
        for i, text in enumerate(pairs.values())
        if not is_plain(text) and text not in WHOLE_PAYLOAD
    }
    places = {text: F.col(place) for place, text in composed.items()}
    return with_lenient(frame, composed).select(
        *keep, *[(places[text] if text in places else expression_column(text)).alias(name) for name, text in pairs.items()]
    )


def null_parameters(
    messages: DataFrame,
    columns: str | dict[str, str],
    value: str = "value",
    headers: str | None = None,
    by: tuple[str, ...] = (),
    table: str = DEFAULT_TABLE,
) -> DataFrame:
    """Per column, in how many messages no expression had a value to give.

    One aggregation pass with a counter per column; the counters are turned into rows only
    after they are final.
    """
    pairs = column_map(columns) if isinstance(columns, str) else columns
    frame = message_frame(messages, value, headers)
    counters = [
        F.count_if(_missing(frame, text)).alias(f"_missing_{i}") for i, text in enumerate(pairs.values())
    ]
    totals = frame.groupBy(*by).agg(*counters, F.count(F.lit(1)).alias("messages"))
    per_column = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"), F.col(f"_missing_{i}").alias("null_parameters")
            )
            for i, name in enumerate(pairs)
        ]
    )
    return totals.select(
        *by, F.lit(table).alias("table_name"), "messages", F.inline(per_column)
    )
