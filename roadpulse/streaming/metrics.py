"""Windowed metrics on a stream: the batch operators with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadpulse.config import RATE_WINDOW_SECONDS
from roadpulse.operators.metrics import (
    SKETCH_BITS,
    duration_sketch,
    merged_sketch,
    rate,
    sketch_quantiles,
)
from roadpulse.streaming.pipeline import each_batch, repeatable_parquet


def start_rate(
    rows: DataFrame,
    ts: str,
    by: tuple[str, ...],
    path: str,
    checkpoint: str,
    seconds: int = RATE_WINDOW_SECONDS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Each micro-batch's counts per window to ``path``; ``stored_rate`` adds them up.

    Counts are kept by batch and need no watermark: a row counts however late it comes, a repeated
    batch replaces its counts, and windows still open are there as well.
    """
    store = repeatable_parquet(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        store(rate(batch, ts, by, seconds).drop("rate"), batch_id)

    return each_batch(rows, write, checkpoint, trigger).start()


def stored_rate(
    spark: SparkSession, path: str, by: tuple[str, ...], seconds: int = RATE_WINDOW_SECONDS
) -> DataFrame:
    """Rows per second in each window over all batches that ``start_rate`` has written."""
    totals = spark.read.parquet(path).groupBy("window_start", *by)
    return totals.agg(F.sum("events").alias("events")).withColumn(
        "rate", F.col("events") / F.lit(float(seconds))
    )


def start_duration_sketches(
    rows: DataFrame,
    ts: str,
    duration: str,
    by: tuple[str, ...],
    path: str,
    checkpoint: str,
    seconds: int = RATE_WINDOW_SECONDS,
    bits: int = SKETCH_BITS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Each micro-batch's sketch of durations per window to ``path``; ``stored_quantiles`` merges them.

    Kept by batch like the counts of ``start_rate``: late rows count and a repeated batch replaces its own.
    """
    store = repeatable_parquet(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        store(duration_sketch(batch, ts, duration, by, seconds, bits), batch_id)

    return each_batch(rows, write, checkpoint, trigger).start()


def stored_quantiles(
    spark: SparkSession,
    path: str,
    quantiles: tuple[float, ...],
    by: tuple[str, ...],
    seconds: int = RATE_WINDOW_SECONDS,
    bits: int = SKETCH_BITS,
) -> DataFrame:
    """Quantiles per window over all batches; ``seconds`` may be a multiple of what was written."""
    merged = merged_sketch(spark.read.parquet(path), by, seconds)
    return sketch_quantiles(merged, quantiles, by, bits)
