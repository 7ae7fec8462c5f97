"""Lenient reads of one field from a parsed JSON message (a VARIANT column).

Each reader first asks Spark for the typed value, which covers well-formed messages, and
only falls back to the coercion rules when that gives NULL. An absent or JSON-null field is
NULL; a field that cannot be read as the wanted type becomes the type's empty value (0, 0.0,
false, '').
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_MAX, INT_MIN = 2147483647, -2147483648
LONG_MAX, LONG_MIN = 9223372036854775807, -9223372036854775808
ODD = "_odd"
DOUBTFUL_TEXT = r'^["\[{]|^[-+0-9.eE]*$'
# The texts besides numbers that read as a number (Spark takes more of them).
NUMBER_WORDS = r"^\s*([+-]?Infinity|[+-]?NaN)\s*$"
# Whole numbers beyond 64 bits are decimals of this type; 100.0 is DECIMAL(3,0).
LONG_WHOLE = r"^DECIMAL\((19|[23][0-9]),0\)$"
WHOLE_NUMBER = r"^\s*[+-]?[0-9]+\s*$"


def parse_message(value: Column) -> Column:
    """The message as VARIANT; NULL when it is not JSON."""
    return F.try_parse_json(value)


def strict_record(value: Column, fields: dict[str, str]) -> Column:
    """All wanted fields in one pass; ``_odd`` is set when any does not have its type."""
    columns = ", ".join(f"`{name}` {kind}" for name, kind in fields.items())
    return F.from_json(
        value,
        f"{columns}, {ODD} string",
        {
            "columnNameOfCorruptRecord": ODD,
            "allowSingleQuotes": "false",
            "allowNonNumericNumbers": "false",
        },
    )


def quick_number(value: Column, name: str) -> Column:
    """A number field of a well-formed message in one cheap pass; NULL leaves it undecided."""
    found = strict_record(value, {name: "double"}).getField(name)
    return F.when(F.ltrim(value).startswith("{"), found)


def is_clean(value: Column, record: Column, fields: dict[str, str]) -> Column:
    """True when the strict pass reads the message exactly as the lenient rules would.

    That needs an object at the top, no field of another type, and no text field that may
    have been a number or a nested value.
    """
    clean = F.ltrim(value).startswith("{") & record.isNotNull() & record.getField(ODD).isNull()
    for name, kind in fields.items():
        if kind == "string":
            doubtful = record.getField(name).rlike(DOUBTFUL_TEXT)
            clean = clean & ~F.coalesce(doubtful, F.lit(False))
    return F.coalesce(clean, F.lit(False))


def path(name: str, literal: bool = False) -> str:
    """Spark's path of a field: dots nest, unless the name is one ``literal`` key.

    A key with an apostrophe is put in double quotes; Spark has no path for one with both marks.
    """
    parts = [name] if literal else name.split(".")
    return "$" + "".join(f'["{part}"]' if "'" in part else f"['{part}']" for part in parts)


def node(message: Column, name: str, literal: bool = False) -> Column:
    """The field itself as VARIANT; NULL when absent, a VARIANT null when JSON null."""
    return F.try_variant_get(message, path(name, literal), "variant")


def has_field(message: Column, name: str) -> Column:
    """True when the field exists, even with a JSON null."""
    return node(message, name).isNotNull()


def has_value(found: Column) -> Column:
    return found.isNotNull() & ~F.is_variant_null(found)


def _as(found: Column, kind: str) -> Column:
    return F.try_variant_get(found, "$", kind)


def kind_of(found: Column) -> Column:
    """The field's JSON type as Spark names it: BIGINT, DECIMAL(2,1), STRING, OBJECT<…>, …"""
    return F.schema_of_variant(found)


def _truncate(number: Column, low: int, high: int, kind: str) -> Column:
    """Cut a double to a whole number, holding it at the type's limits."""
    return (
        F.when(number.isNull() | F.isnan(number), F.lit(0))
        .when(number >= F.lit(float(high)), F.lit(high))
        .when(number <= F.lit(float(low)), F.lit(low))
        .otherwise(number.try_cast(kind))
        .cast(kind)
    )


def _low_32_bits(number: Column) -> Column:
    low = number.bitwiseAND(F.lit(0xFFFFFFFF))
    return F.when(low > INT_MAX, low - F.lit(1 << 32)).otherwise(low).cast("int")


def _is_whole_text(found: Column, kind: Column) -> Column:
    return (kind == "STRING") & _as(found, "string").rlike(WHOLE_NUMBER)


def number(found: Column, kind: Column) -> Column:
    """The field as a double; NULL when absent, null or not readable as a number."""
    typed = _as(found, "double")
    special = F.isnan(typed) | (F.abs(typed) == F.lit(float("inf")))
    foreign = special & (kind == "STRING") & ~_as(found, "string").rlike(NUMBER_WORDS)
    return F.when(~F.coalesce(foreign, F.lit(False)), typed)


def read_double(found: Column, kind: Column) -> Column:
    return F.coalesce(number(found, kind), F.when(has_value(found), F.lit(0.0)))


def read_int(found: Column, kind: Column) -> Column:
    coerced = (
        F.when(kind == "BIGINT", _low_32_bits(_as(found, "bigint")))
        .when(_is_whole_text(found, kind), F.lit(0))
        .otherwise(_truncate(number(found, kind), INT_MIN, INT_MAX, "int"))
    )
    return F.coalesce(_as(found, "int"), F.when(has_value(found), coerced))


def read_long(found: Column, kind: Column) -> Column:
    coerced = F.when(_is_whole_text(found, kind), F.lit(0).cast("bigint")).otherwise(
        _truncate(number(found, kind), LONG_MIN, LONG_MAX, "bigint")
    )
    return F.coalesce(_as(found, "bigint"), F.when(has_value(found), coerced))


def read_text(found: Column, kind: Column) -> Column:
    """Text of a scalar; a nested object or array has none and reads as ''."""
    nested = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    return F.when(has_value(found), F.when(nested, F.lit("")).otherwise(json_text(found, kind)))


def read_boolean(found: Column, kind: Column) -> Column:
    return F.when(
        has_value(found),
        F.when(kind == "BOOLEAN", _as(found, "boolean"))
        .when(kind == "BIGINT", _as(found, "bigint") != 0)
        .when(kind == "STRING", F.trim(_as(found, "string")) == "true")
        .otherwise(F.lit(False)),
    )


def json_text(found: Column, kind: Column) -> Column:
    """Text fields as they are, any other field as its JSON text; NULL if absent or null.

    A number with a fraction is written as a double, so that 100.0 stays '100.0'.
    """
    fractional = (kind == "DOUBLE") | (kind.startswith("DECIMAL") & ~kind.rlike(LONG_WHOLE))
    return F.when(
        has_value(found),
        F.when(fractional, _as(found, "double").cast("string")).otherwise(_as(found, "string")),
    )


LENIENT_READERS = {
    "string": read_text,
    "int": read_int,
    "bigint": read_long,
    "double": read_double,
    "boolean": read_boolean,
}


def _pair_reader(reader):
    return lambda pair: reader(pair["node"], pair["kind"])


def read_fields(message: Column, fields: dict[str, str]) -> dict[str, Column]:
    """Lenient reads of many fields of a message: an array per type, to be indexed by field.

    One rule per type, applied to the array of that type's fields, keeps the plan small.
    """
    arrays = {}
    for kind in dict.fromkeys(fields.values()):
        names = [name for name, wanted in fields.items() if wanted == kind]
        found = [node(message, name) for name in names]
        pairs = F.array(*[F.struct(f.alias("node"), kind_of(f).alias("kind")) for f in found])
        arrays[kind] = F.transform(pairs, _pair_reader(LENIENT_READERS[kind]))
    return arrays


def field_number(message: Column, name: str) -> Column:
    found = node(message, name)
    return number(found, kind_of(found))


def field_text(message: Column, name: str, literal: bool = False) -> Column:
    """The field's JSON text; NULL if absent or null."""
    found = node(message, name, literal)
    return json_text(found, kind_of(found))


def read_field(message: Column, name: str, kind: str, mode: str = "lenient") -> Column:
    """One typed field: ``lenient`` replaces unreadable values, ``strict`` gives NULL."""
    if mode == "lenient":
        found = node(message, name)
        return LENIENT_READERS[kind](found, kind_of(found))
    if mode == "strict":
        return F.try_variant_get(message, path(name), kind)
    raise ValueError(f"mode must be 'lenient' or 'strict', not {mode!r}")
