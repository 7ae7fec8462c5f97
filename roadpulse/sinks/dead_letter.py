"""Bounded retries and the dead-letter table."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.config import DEFAULT_MAX_ATTEMPTS
from roadpulse.operators.ordered import with_index
from roadpulse.session import scratch_path

# Error classes of rejected messages.
PARSE_ERROR = "JsonParseException"
NOT_AN_OBJECT = "MismatchedInputException"
MISFIT = "DataIntegrityViolationException"


def error_class(message: Column) -> Column:
    """Why the table loader rejects a message: not JSON, or JSON that is no object."""
    return F.when(message.isNull(), F.lit(PARSE_ERROR)).otherwise(F.lit(NOT_AN_OBJECT))


def dead_letters(
    rejected: DataFrame,
    reason: Column,
    value: str = "value",
    attempts: int = DEFAULT_MAX_ATTEMPTS,
    at: Column | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Rejected messages as quarantine rows.

    A message that cannot be parsed fails the same way each time, so it counts as tried
    ``attempts`` times without being parsed again.
    """
    return rejected.select(
        *keep,
        F.col(value).alias("payload"),
        reason.alias("error_class"),
        F.lit(attempts).alias("attempts"),
        (F.current_timestamp() if at is None else at).alias("ts"),
    )


def deliver(
    rows: DataFrame,
    write: Callable[[DataFrame], None],
    quarantine: Callable[[DataFrame, str, int], None],
    max_attempts: int = DEFAULT_MAX_ATTEMPTS,
) -> int:
    """Writes the rows, trying again after a failure; then hands them to ``quarantine``.

    Returns the number of attempts. Writing must be safe to repeat, or the target gets the
    rows of a half-done attempt twice (at-least-once).
    """
    for attempt in range(1, max_attempts + 1):
        try:
            write(rows)
            return attempt
        except Exception as error:
            if attempt == max_attempts:
                quarantine(rows, type(error).__name__, attempt)
    return max_attempts


@dataclass(frozen=True)
class Part:
    """Messages ``first`` to ``end`` (not included) of a batch, numbered in the order of their content."""

    batch_id: int
    first: int
    end: int

    @property
    def name(self) -> str:
        return f"{self.batch_id}-{self.first}-{self.end}"


class Ledger:
    """Which parts of which batches were written or parked, kept over restarts.

    A part is a file of its own in a shared folder, made after its write; it holds how many of the part's
    messages the target refused, or nothing.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def _file(self, part: Part, outcome: str):
        found = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{part.batch_id}/{outcome}-{part.name}")
        return found.getFileSystem(self.spark._jsc.hadoopConfiguration()), found

    def has(self, part: Part, outcome: str) -> bool:
        system, found = self._file(part, outcome)
        return system.exists(found)

    def add(self, part: Part, outcome: str, refused: int = 0) -> None:
        system, found = self._file(part, outcome)
        out = system.create(found, True)
        if refused:
            out.writeBytes(str(refused))
        out.close()

    def refused(self, part: Part, outcome: str) -> int:
        system, found = self._file(part, outcome)
        length = system.getFileStatus(found).getLen()
        if not length:
            return 0
        held = system.open(found)
        digits = "".join(chr(held.readByte()) for _ in range(length))
        held.close()
        return int(digits)


# What became of a part.
WRITTEN, SPLIT, PARKED = "written", "split", "parked"


#: Gives rows to a target; raises if it does not take all of them.
Insert = Callable[[pa.RecordBatch], None]


def refusals(rows: pa.RecordBatch, insert: Insert, max_attempts: int) -> list[str | None]:
    """The error class of each row that the target does not take; rows whose insert fails are halved."""
    found: list[str | None] = [None] * rows.num_rows
    todo = [(0, rows.num_rows)]
    while todo:
        first, end = todo.pop()
        alone, middle = end - first == 1, (first + end) // 2
        for _ in range(max_attempts if alone else 1):
            try:
                if end > first:
                    insert(rows.slice(first, end - first))
                break
            except Exception as error:
                failure = type(error).__name__
        else:
            if alone:
                found[first] = failure
            else:
                todo += [(middle, end), (first, middle)]
    return found


def insert_each(rows: DataFrame, insert: Insert, max_attempts: int = DEFAULT_MAX_ATTEMPTS) -> DataFrame:
    """The rows with ``error_class``: why the target refused a row, NULL where it took it.

    Every task gives its own rows to the target, so refused rows cost no jobs of their own. A single row
    that fails is tried ``max_attempts`` times. A task may run again, so inserts must be safe to repeat.
    """

    def tried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array(refusals(batch, insert, max_attempts), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "error_class"])

    schema = T.StructType([*rows.schema.fields, T.StructField("error_class", T.StringType())])
    return rows.mapInArrow(tried, schema)


def deliver_each(
    rows: DataFrame,
    write: Callable[[DataFrame, Part], DataFrame | None],
    quarantine: Callable[[DataFrame, str | Column, int, Part], None],
    ledger: Ledger,
    batch_id: int,
    max_attempts: int = DEFAULT_MAX_ATTEMPTS,
    most_parked: int | None = None,
) -> int:
    """Writes all messages that the target takes and parks the others one by one; returns how many.

    The batch is numbered and written down once. A part whose write fails is halved, down to single
    messages; only those are tried ``max_attempts`` times and then parked. So k bad messages among n
    cost about 2 k log n writes. The ledger keeps what was done with each part: a batch that is delivered
    again goes on where it stopped, and a part is written twice only if the job was lost between its write
    and its entry, which a writer that replaces what it wrote under ``part.name`` makes good.

    A ``write`` that finds the refused messages itself (with ``insert_each``, after ``max_attempts`` tries of
    each) returns them with their ``error_class``: those are parked together, and a batch costs one write,
    however many they are.

    With more than ``most_parked`` messages refused the target itself is taken to be broken: the error
    is raised, and the stream delivers the batch again later.
    """
    spark = rows.sparkSession
    names = rows.columns
    content = rows.withColumn("_content", F.xxhash64(*names)).withColumn("_text", F.to_json(F.struct(*names)))
    path = scratch_path(spark, "delivery")
    with_index(content, ("_content", "_text"), "_place").drop("_content", "_text").write.parquet(path)
    held = spark.read.parquet(path)
    parked = 0
    todo = [Part(batch_id, 0, held.count())]
    while todo:
        part = todo.pop()
        if part.first == part.end:
            continue
        if ledger.has(part, WRITTEN):
            parked += ledger.refused(part, WRITTEN)
            continue
        if ledger.has(part, PARKED):
            parked += 1
            continue
        alone, middle = part.end - part.first == 1, (part.first + part.end) // 2
        halves = [Part(batch_id, middle, part.end), Part(batch_id, part.first, middle)]
        if ledger.has(part, SPLIT):
            todo += halves
            continue
        own = held.where((F.col("_place") >= part.first) & (F.col("_place") < part.end)).select(*names)
        for attempt in range(1, (max_attempts if alone else 1) + 1):
            try:
                refused = write(own, part)
                break
            except Exception as error:
                failure = error
        else:
            if not alone:
                ledger.add(part, SPLIT)
                todo += halves
                continue
            if most_parked is not None and parked >= most_parked:
                raise failure
            quarantine(own, type(failure).__name__, attempt, part)
            ledger.add(part, PARKED)
            parked += 1
            continue
        several = 0 if refused is None else refused.count()
        if most_parked is not None and parked + several > most_parked:
            raise RuntimeError(f"the target refused {parked + several} messages")
        if several:
            quarantine(refused, F.col("error_class"), max_attempts, part)
        ledger.add(part, WRITTEN, several)
        parked += several
    return parked
