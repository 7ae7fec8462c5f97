"""Row numbers, running sums and previous rows over ordered data of any size.

A plain window over the data would put a whole group in one task; here a group may hold a
third of all rows. So the data is range-partitioned by (keys, order) into even slices and written
once to the shared folder, which also fixes the slices, whatever tasks are lost later. Each
(slice, key) part is then numbered on its own, and what a key brings along from earlier slices
is added from a small carry table.

A key's rows are contiguous, so only a slice's first and last key can reach into another slice.
The carry table holds just those: at most two rows per slice, however many rows and keys there
are. That bound is what allows it to be broadcast.

The order columns must make each row's place unique.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.session import default_slices, scratch_path

SLICE, POSITION = "_slice", "_position"
_POSITION_BITS = (1 << 33) - 1


@dataclass(frozen=True)
class Ordered:
    """Sliced rows. ``edge_rows`` are those of the keys that may reach into another slice."""

    rows: DataFrame
    edge_rows: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]

    def with_columns(self, columns: dict[str, Column]) -> Ordered:
        return self.each(lambda rows: rows.withColumns(columns))

    def each(self, change: Callable[[DataFrame], DataFrame]) -> Ordered:
        """The same row-wise change to all rows and to the edge rows."""
        return replace(self, rows=change(self.rows), edge_rows=change(self.edge_rows))

    def result(self) -> DataFrame:
        return self.rows.drop(SLICE, POSITION)


def _with_edges(rows: DataFrame, edges: DataFrame, keys: tuple[str, ...], how: str) -> DataFrame:
    """Joins a table of at most two rows per slice on (slice, key); NULL keys match."""
    names = (SLICE, *keys)
    renamed = edges.withColumnsRenamed({name: f"_edge{name}" for name in names})
    condition = reduce(
        lambda a, b: a & b,
        [F.col(name).eqNullSafe(F.col(f"_edge{name}")) for name in keys],
        F.col(SLICE) == F.col(f"_edge{SLICE}"),
    )
    return rows.join(F.broadcast(renamed), condition, how).drop(*[f"_edge{n}" for n in names])


def ordered(
    rows: DataFrame, order: tuple[str, ...], keys: tuple[str, ...] = (), slices: int | None = None
) -> Ordered:
    """Slices the rows by (keys, order). Pass only the columns that are needed."""
    spark = rows.sparkSession
    n = slices or default_slices(spark)
    sort = [F.col(name) for name in (*keys, *order)]
    placed = (
        rows.repartitionByRange(n, *sort)
        .sortWithinPartitions(*sort)
        .withColumn(SLICE, F.spark_partition_id())
        .withColumn(
            POSITION, F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS))
        )
    )
    path = scratch_path(spark, "ordered")
    placed.write.parquet(path)
    sliced = spark.read.schema(placed.schema).parquet(path)
    return Ordered(sliced, _edge_rows(sliced, tuple(keys)), tuple(keys), tuple(order))


def _edge_rows(sliced: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The rows of every slice's first and last key; those keys are looked up and kept once."""
    if not keys:
        return sliced
    ends = sliced.groupBy(SLICE).agg(F.max(POSITION).alias("_end"))
    at_edge = (F.col(POSITION) == 0) | (F.col(POSITION) == F.col("_end"))
    found = sliced.join(F.broadcast(ends), SLICE).where(at_edge).select(SLICE, *keys).distinct()
    path = scratch_path(sliced.sparkSession, "edges")
    found.write.parquet(path)
    edges = sliced.sparkSession.read.schema(found.schema).parquet(path)
    return _with_edges(sliced, edges, keys, "left_semi")


def with_index(
    rows: DataFrame, order: tuple[str, ...], name: str = "index", slices: int | None = None
) -> DataFrame:
    """Adds the row's place (from 0) in the order of the whole data.

    Without keys the place inside the slice is already written; only counts are carried.
    """
    data = ordered(rows, order, slices=slices)
    before = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    counts = data.rows.groupBy(SLICE).agg(F.count(F.lit(1)).alias("_n"))
    earlier = counts.select(SLICE, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_earlier"))
    numbered = data.rows.join(F.broadcast(earlier), SLICE)
    return numbered.select(*rows.columns, (F.col(POSITION) + F.col("_earlier")).alias(name))


def with_row_number(data: Ordered, name: str = "row_number", total: str | None = None) -> DataFrame:
    """Numbers each key's rows from 1; ``total`` names an optional column with their count."""
    totals = {total: F.lit(1)} if total else {}
    return with_running(data, count=name, totals=totals).result()


def with_running(
    data: Ordered,
    sums: dict[str, str] | None = None,
    maxes: dict[str, str] | None = None,
    previous: str | None = None,
    first: str | None = None,
    count: str | None = None,
    totals: dict[str, str | Column] | None = None,
) -> Ordered:
    """Running values of each key in order, the current row included.

    ``sums`` and ``maxes`` map an output to the column it runs over, ``totals`` to the column
    summed over the whole key; ``count`` names a running count; ``previous`` and ``first`` name
    outputs with the leading order column of the key's row before and of its first row.

    The rows shuffle once, by (slice, key), so a hot key's work stays spread over its slices. More
    steps on the result need no further shuffle.
    """
    sums, maxes, totals, lead = sums or {}, maxes or {}, totals or {}, data.order[0]
    carry = _carry(data, sums, maxes, totals)
    part = Window.partitionBy(SLICE, *data.keys)
    inside = part.orderBy(POSITION)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = [
        F.row_number().over(inside).alias("_rn"),
        *[F.sum(column).over(running).alias(f"_run_{out}") for out, column in sums.items()],
        *[F.max(column).over(running).alias(f"_run_{out}") for out, column in maxes.items()],
        *([F.lag(lead).over(inside).alias("_row_before")] if previous else []),
        *([F.first(lead).over(running).alias("_first_here")] if first else []),
        *[F.sum(column).over(part).alias(f"_here_{out}") for out, column in totals.items()],
    ]
    outputs: list[Column] = []
    if count:
        number = F.col("_rn") + F.coalesce(F.col("_rows_before"), F.lit(0))
        outputs.append(number.cast("bigint").alias(count))
    for out in sums:
        own, earlier = F.col(f"_run_{out}"), F.col(f"_before_{out}")
        outputs.append(F.coalesce(own + earlier, own, earlier).alias(out))
    for out in maxes:
        outputs.append(F.greatest(f"_run_{out}", f"_before_{out}").alias(out))
    if previous:
        opens, before = F.col("_rn") == 1, F.col("_last_before")
        outputs.append(F.when(opens, before).otherwise(F.col("_row_before")).alias(previous))
    if first:
        spans, here = F.col("_spans").isNotNull(), F.col("_first_here")
        outputs.append(F.when(spans, F.col("_first_of_key")).otherwise(here).alias(first))
    for out in totals:
        outputs.append(F.coalesce(f"_whole_{out}", f"_here_{out}").alias(out))

    def add(rows: DataFrame) -> DataFrame:
        joined = _with_edges(rows.select("*", *local), carry, data.keys, "left")
        return joined.select(*rows.columns, *outputs)

    return data.each(add)


def _carry(data: Ordered, sums: dict, maxes: dict, totals: dict) -> DataFrame:
    """What each edge key of a slice brings along from the slices before it."""
    lead = F.col(data.order[0])
    parts = data.edge_rows.groupBy(SLICE, *data.keys).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(column).alias(f"_part_{out}") for out, column in sums.items()],
        *[F.max(column).alias(f"_part_{out}") for out, column in maxes.items()],
        *[F.sum(column).alias(f"_part_{out}") for out, column in totals.items()],
        # The order puts NULL first, so one NULL makes the first one NULL.
        F.when(F.count(lead) == F.count(F.lit(1)), F.min(lead)).alias("_head"),
        F.max(lead).alias("_tail"),
    )
    key = Window.partitionBy(*data.keys)
    steps = key.orderBy(SLICE)
    before = steps.rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(
        SLICE,
        *data.keys,
        F.lit(True).alias("_spans"),
        F.sum("_n").over(before).alias("_rows_before"),
        *[F.sum(f"_part_{out}").over(key).alias(f"_whole_{out}") for out in totals],
        *[F.sum(f"_part_{out}").over(before).alias(f"_before_{out}") for out in sums],
        *[F.max(f"_part_{out}").over(before).alias(f"_before_{out}") for out in maxes],
        F.lag("_tail").over(steps).alias("_last_before"),
        F.first("_head").over(steps).alias("_first_of_key"),
    )
