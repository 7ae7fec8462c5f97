"""The live count of recent events, kept up by a stream in time buckets that expire.

Each micro-batch adds its counts by key and time to the buckets of the interval before the newest event;
buckets that the interval has left are removed. A reader sees the newest time and counts exactly what is
later than the interval before it, from a few buckets however long the stream has run. No watermark: an
event counts as long as it is recent, however late it comes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadpulse.functions import times
from roadpulse.streaming.pipeline import each_batch

RECENT_SECONDS = 300
BUCKET_SECONDS = 60
_BUCKET, _BATCH = "bucket", "batch_id"


def _folder(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def live_buckets(spark: SparkSession, path: str) -> list[int]:
    """The buckets kept now, in order."""
    system, found = _folder(spark, path)
    if not system.exists(found):
        return []
    names = [status.getPath().getName() for status in system.listStatus(found)]
    return sorted(int(n.removeprefix(f"{_BUCKET}=")) for n in names if n.startswith(f"{_BUCKET}="))


def _expire(spark: SparkSession, path: str, before: int) -> None:
    system, _ = _folder(spark, path)
    for bucket in live_buckets(spark, path):
        if bucket < before:
            system.delete(_folder(spark, f"{path}/{_BUCKET}={bucket}")[1], True)


def start_recent(
    rows: DataFrame,
    ts: str,
    by: tuple[str, ...],
    path: str,
    checkpoint: str,
    seconds: int = RECENT_SECONDS,
    bucket_seconds: int = BUCKET_SECONDS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keeps the counts of the last ``seconds`` before the newest event under ``path``.

    A repeated micro-batch replaces its own counts. Rows without a time are left out, as by a
    comparison with their time; null keys are keys. The newest event is always in a bucket that stays.
    A micro-batch is read twice: for its newest time, then for its counts.
    """
    moment = F.col(ts).cast("timestamp")
    counted = rows.where(moment.isNotNull()).select(*by, moment.alias("ts"))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        bucket = F.floor(F.unix_micros("ts") / F.lit(bucket_seconds * 1_000_000)).cast("bigint")
        counts = batch.groupBy(*by, "ts").agg(F.count(F.lit(1)).alias("n")).withColumn(_BUCKET, bucket)
        newest = batch.agg(F.max(bucket)).first()[0]
        if newest is None:
            return
        kept = live_buckets(spark, path)
        least = max([newest, *kept[-1:]]) - -(-seconds // bucket_seconds)
        (
            counts.where(F.col(_BUCKET) >= least)
            .withColumn(_BATCH, F.lit(batch_id))
            .hint("rebalance", _BUCKET)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(_BUCKET, _BATCH)
            .parquet(path)
        )
        _expire(spark, path, least)

    return each_batch(counted, write, checkpoint, trigger).start()


def stored_recent(
    spark: SparkSession, path: str, schema: str, by: tuple[str, ...], seconds: int = RECENT_SECONDS
) -> DataFrame:
    """Events by key later than ``seconds`` before the newest event; ``schema`` names the keys' types.

    Read while the stream stands between two micro-batches. Without events there are no rows.
    """
    columns = f"{schema + ', ' if schema else ''}ts timestamp, n bigint, {_BUCKET} bigint, {_BATCH} bigint"
    if not live_buckets(spark, path):
        counts = spark.createDataFrame([], columns)
    else:
        counts = spark.read.schema(columns).parquet(path)
    recent = times.recent(counts, "ts", f"{seconds} seconds", counts.agg(F.max("ts")).scalar())
    return recent.groupBy(*by).agg(F.sum("n").alias("events"))
