"""An archive stream that records what each of its commits wrote, tried and failed to write.

Every micro-batch is one change of the archive (see ``sinks.commits``). Beside the changes lies a log with a
row for each try: what it received, rejected and wrote, measured from the files it left. A try counts as
written only if its change was committed, so the log and the files agree whatever was lost in between, and a
batch that is delivered again after its commit is skipped.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadpulse.config import DEFAULT_MAX_ATTEMPTS, ArchiveConfig
from roadpulse.operators.layout import gathered
from roadpulse.sinks import commits
from roadpulse.sinks.archive import COMPRESSION
from roadpulse.streaming.pipeline import BatchWriter, archive_records, each_batch, every

LOG = "source string, batch_id bigint, change string, error string, received bigint, written bigint, files bigint, bytes bigint"
Store = Callable[[DataFrame, str], None]


def log_folder(path: str) -> str:
    return f"{path}/{commits.FOLDER}/counters"


def parquet_store(config: ArchiveConfig) -> Store:
    """Writes records under their partition columns into a folder."""

    def store(records: DataFrame, folder: str) -> None:
        (
            records.write.mode("errorifexists")
            .option("compression", COMPRESSION)
            .option("maxRecordsPerFile", 1 if config.force_flush else config.roll.max_rows)
            .partitionBy(*config.partition_columns)
            .parquet(folder)
        )

    return store


def _measured(spark: SparkSession, folder: str, records: DataFrame) -> tuple[int, int, int]:
    """Rows, files and bytes that a write has left in a folder."""
    rows = spark.read.schema(records.schema).parquet(folder)
    files = rows.groupBy(F.col("_metadata.file_path")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.col("_metadata.file_size")).alias("bytes")
    )
    total = files.agg(F.sum("n"), F.count(F.lit(1)), F.sum("bytes")).first()
    return total[0] or 0, total[1], total[2] or 0


def counted_archive(
    config: ArchiveConfig,
    source: str = "archive",
    max_attempts: int = DEFAULT_MAX_ATTEMPTS,
    store: Store | None = None,
) -> BatchWriter:
    """A writer of micro-batches that logs every try and commits a batch once.

    ``source`` tells the streams apart that write to one archive. The last failure is raised, so the
    stream stops and delivers the batch again. A batch of which nothing is valid leaves a log row and no
    change. ``received`` is taken while the records are written; a task that Spark runs again after a shuffle
    (archives partitioned by a field) may count twice there, never in ``written``.
    """
    put = store or parquet_store(config)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        prefix = f"{source}-{batch_id}-"
        if any(name.startswith(prefix) for name in commits.committed(spark, config.path)) or batch.isEmpty():
            return

        def log(change: str, error: str | None, *numbers: int | None) -> None:
            row = spark.createDataFrame([(source, batch_id, change, error, *numbers)], LOG)
            row.coalesce(1).write.mode("append").parquet(log_folder(config.path))

        for attempt in range(1, max_attempts + 1):
            change, seen = f"{prefix}{uuid.uuid4().hex}", Observation()
            folder = commits.data_folder(config.path, change)
            counted = batch.observe(seen, F.count(F.lit(1)).alias("received"))
            records = archive_records(counted, config)
            if config.partition_columns != ("date",):
                records = gathered(records, config.partition_columns, config.splits)
            try:
                put(records, folder)
            except Exception as error:
                log(change, type(error).__name__, None, None, None, None)
                if attempt == max_attempts:
                    raise
                continue
            rows, files, size = _measured(spark, folder, records)
            log(change, None, seen.get["received"], rows, files, size)
            if files:
                commits.commit(spark, config.path, change)
            return

    return write


def start_counted_archive(
    messages: DataFrame,
    config: ArchiveConfig,
    checkpoint: str,
    trigger: dict | None = None,
    source: str = "archive",
) -> StreamingQuery:
    """All valid messages to the archive, each once, with the counters of ``sink_totals``."""
    write = counted_archive(config, source)
    return each_batch(messages, write, checkpoint, trigger or every(config.trigger_seconds)).start()


def sink_log(spark: SparkSession, path: str) -> DataFrame:
    """Every try: its row of the log and ``outcome``: written, failed, or lost before its commit."""
    done = spark.createDataFrame([(name,) for name in commits.committed(spark, path)], "change string")
    rows = spark.read.schema(LOG).parquet(log_folder(path))
    marked = rows.join(done.withColumn("_done", F.lit(True)), "change", "left")
    outcome = (
        F.when(F.col("error").isNotNull(), "failed")
        .when((F.col("files") == 0) | F.col("_done"), "written")
        .otherwise("lost")
    )
    return marked.withColumn("outcome", outcome).drop("_done")


def sink_totals(spark: SparkSession, path: str) -> DataFrame:
    """The archive's counters over all its streams and restarts, in one row.

    A batch without valid messages that was delivered twice has two log rows and counts once.
    """
    tries = sink_log(spark, path)
    written = F.col("outcome") == "written"
    batches = tries.groupBy("source", "batch_id").agg(
        *[F.max(F.when(written, F.col(name))).alias(name) for name in ("received", "written", "files", "bytes")],
        F.count_if(F.col("outcome") == "failed").alias("failures"),
    )

    def total(name: str):
        return F.coalesce(F.sum(name), F.lit(0))

    return batches.agg(
        F.count("written").alias("batches"),
        total("received").alias("messages_received"),
        (total("received") - total("written")).alias("messages_rejected"),
        total("written").alias("messages_written"),
        total("failures").alias("batch_failures"),
        total("files").alias("files_created"),
        total("bytes").alias("bytes_written"),
    )
