"""Events laid out so that a lookup by any of five columns reads few files.

Each column is cut into ranges of about equally many rows, and the bits of the five range numbers are interleaved
to one key along a space-filling curve, so rows that are near in all columns lie in one file. A table beside
the files has the least and greatest value of each column in each file; a lookup reads the files whose values can
meet its conditions and no others.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.schema import LOOKUP_COLUMNS
from roadpulse.session import scratch_path
from roadpulse.sinks import commits

# Fixed value: the archive's compression.
COMPRESSION = "snappy"
#: Bits of a column's range number.
BITS = 4
ROWS_PER_FILE = 1_000_000
_ACCURACY = 1000


def range_cuts(events: DataFrame, columns: tuple[str, ...], bits: int = BITS) -> dict[str, list]:
    """Values that cut each column into at most ``2 ** bits`` ranges of about equally many rows."""
    shares = [i / 2**bits for i in range(1, 2**bits)]
    found = events.agg(*[F.percentile_approx(c, shares, _ACCURACY).alias(c) for c in columns]).first()
    return {c: sorted(set(found[c] or [])) for c in columns}


def curve_key(cuts: dict[str, list], bits: int = BITS) -> Column:
    """The interleaved range numbers; NULL counts as the lowest range."""
    key = F.lit(0).cast("bigint")
    for at, (column, values) in enumerate(cuts.items()):
        number = sum((F.coalesce(F.col(column) > F.lit(v), F.lit(False)).cast("bigint") for v in values), F.lit(0).cast("bigint"))
        for bit in range(bits):
            key = key + F.shiftleft(F.shiftright(number, bit).bitwiseAND(F.lit(1)), bit * len(cuts) + at)
    return key


def write_lookup(
    events: DataFrame,
    path: str,
    columns: tuple[str, ...] = tuple(LOOKUP_COLUMNS),
    rows_per_file: int = ROWS_PER_FILE,
    bits: int = BITS,
) -> None:
    """Adds the events to the lookup files and their ranges to the table of files.

    The events are computed once and held, as they are read for their number, their cuts and their places.
    """
    spark = events.sparkSession
    held = scratch_path(spark, "lookup-rows")
    events.write.parquet(held)
    events = spark.read.schema(events.schema).parquet(held)
    rows = events.count()
    if not rows:
        return
    key = curve_key(range_cuts(events, columns, bits), bits)
    files = max(1, -(-rows // rows_per_file))
    change = commits.new_change()
    folder = commits.data_folder(path, change)
    placed = events.withColumn("_key", key).repartitionByRange(files, "_key", *columns)
    writer = placed.sortWithinPartitions("_key", *columns).drop("_key").write.option("compression", COMPRESSION)
    for name in columns:
        if name.endswith("_id"):
            writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
            # without it every filter takes the most bytes allowed, however few rows the file has
            writer = writer.option(f"parquet.bloom.filter.expected.ndv#{name}", min(rows, rows_per_file))
    writer.parquet(folder)
    ends = [f(c).alias(f"{end}_{c}") for c in columns for f, end in ((F.min, "least"), (F.max, "greatest"))]
    written = spark.read.parquet(folder)
    ranges = written.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count(F.lit(1)).alias("file_rows"), *ends)
    ranges.write.parquet(f"{path}/_ranges/{change}")
    commits.commit(spark, path, change)


def file_ranges(spark: SparkSession, path: str) -> DataFrame:
    """Rows, least and greatest values of every file that counts."""
    return spark.read.parquet(*[f"{path}/_ranges/{change}" for change in commits.committed(spark, path)])


def matching_files(spark: SparkSession, path: str, conditions: dict[str, tuple]) -> list[str]:
    """Files that can hold rows with each column between its two values; None leaves an end open."""
    ranges = file_ranges(spark, path)
    for column, (low, high) in conditions.items():
        if low is not None:
            ranges = ranges.where(F.col(f"greatest_{column}") >= F.lit(low))
        if high is not None:
            ranges = ranges.where(F.col(f"least_{column}") <= F.lit(high))
    return [unquote(row.file_path) for row in ranges.select("file_path").toLocalIterator()]


def look_up(spark: SparkSession, path: str, conditions: dict[str, tuple]) -> DataFrame:
    """The events that meet all conditions. A NULL value meets none."""
    files = matching_files(spark, path, conditions)
    schema = spark.read.parquet(*[commits.data_folder(path, c) for c in commits.committed(spark, path)[:1]]).schema
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    for column, (low, high) in conditions.items():
        if low is not None:
            rows = rows.where(F.col(column) >= F.lit(low))
        if high is not None:
            rows = rows.where(F.col(column) <= F.lit(high))
    return rows
