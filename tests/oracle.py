"""Runs a query and its SQL on the same tables and compares the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(frame, connection, sql: str) -> str | None:
    """What differs, or None if the results are equal."""
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    ours = _rows(frame.columns, frame.collect())
    theirs = _rows(names, result.fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)} rows; {ours[:2]} / {theirs[:2]}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{sorted(names)}: {a} != {b}"
    return None
