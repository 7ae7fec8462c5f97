"""The Parquet archive: partitioned writes, file statistics and compaction of small files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.config import ArchiveConfig
from roadpulse.operators.layout import balanced
from roadpulse.schema import LOOKUP_COLUMNS
from roadpulse.sinks import commits

# Fixed value: the archive's compression.
COMPRESSION = "snappy"


def write_archive(
    records: DataFrame, config: ArchiveConfig, mode: str = "append", limit_rows: bool = True
) -> None:
    """Writes records under their partition columns in files of even size.

    ``mode='errorifexists'`` refuses an archive that is already there. Spark creates missing
    folders and names the files. ``force_flush`` gives every record its own file. Without
    ``limit_rows`` only the rebalance sizes the files, by Spark's advisory partition size.
    """
    columns = list(config.partition_columns)
    rows_per_file = 1 if config.force_flush else config.roll.max_rows if limit_rows else 0
    (
        balanced(records, *columns)
        .write.mode(mode)
        .option("compression", COMPRESSION)
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*columns)
        .parquet(config.path)
    )


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The archive with all changes that count; filters on its partition columns skip whole folders."""
    return commits.read(spark, path) if commits.committed(spark, path) else spark.read.parquet(path)


def with_file_columns(archive: DataFrame) -> DataFrame:
    return archive.select(
        "*",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_size").alias("file_size"),
    )


def file_stats(archive: DataFrame, by: tuple[str, ...] = (), min_rows: int = 0) -> DataFrame:
    """One row per archive file: rows, size in bytes, and whether it is under the minimum."""
    return (
        with_file_columns(archive)
        .groupBy(*by, "file_path")
        .agg(
            F.count(F.lit(1)).alias("file_rows"),
            F.max("file_size").alias("file_bytes"),
        )
        .withColumn("too_small", F.col("file_rows") < F.lit(min_rows))
    )


def file_counters(stats: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Files created, files under the minimum, and the rows and bytes written."""
    return stats.groupBy(*by).agg(
        F.count(F.lit(1)).alias("files_created"),
        F.count_if("too_small").alias("files_too_small"),
        F.sum("file_rows").alias("rows_written"),
        F.sum("file_bytes").alias("bytes_written"),
    )


def compact(spark: SparkSession, source: str, config: ArchiveConfig) -> None:
    """Rewrites an archive's small files into few large ones at ``config.path``.

    Small files are joined, never deleted with their rows. The row limit of the intake does not
    bind here; ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` is the target size.
    """
    write_archive(read_archive(spark, source), config, mode="errorifexists", limit_rows=False)


def write_lookup_files(events: DataFrame, path: str, mode: str = "append") -> None:
    """Events laid out for lookups: sorted for min/max skipping, bloom filters on the ids."""
    writer = events.sortWithinPartitions("event_time").write.mode(mode)
    for name in LOOKUP_COLUMNS:
        if name.endswith("_id"):
            writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
    writer.option("compression", COMPRESSION).parquet(path)


def save_events_table(
    events: DataFrame, table: str, path: str, buckets: int, mode: str = "append"
) -> None:
    """The typed events table, hash-distributed by vehicle.

    The rebalance keeps a vehicle's rows in few tasks, yet splits a vehicle that holds a large
    share of all rows over several files of its bucket.
    """
    (
        balanced(events, "vehicle_id")
        .write.mode(mode)
        .format("parquet")
        .option("path", path)
        .bucketBy(buckets, "vehicle_id")
        .sortBy("event_time")
        .saveAsTable(table)
    )
