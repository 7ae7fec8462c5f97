"""Count-or-idle batching on a stream whose state is bounded by time and which keeps late rows.

Times wait in state by time bucket. When the watermark has passed a bucket's end, its timer cuts the
bucket into batches and frees it, so state holds the buckets of the last ``late_by`` and one open batch
a key, and a cut reads one bucket at a time. Rows that the watermark has passed, and rows without a time,
go to a side table beside the batches: every row that comes in is in one of them.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from roadpulse.streaming.batching import OPEN_BATCH, split_batches

BUCKET_SECONDS = 60
#: Batches that a task gives out at once.
FRAME_ROWS = 4096
BATCHES, LATE = "batch", "late"
OUTPUT = (
    "key string, shard int, batch_rows bigint, first_ts timestamp, last_ts timestamp, "
    "release string, row_id string, kind string"
)

# The processor travels with its query, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class BucketedBatches(StatefulProcessor):
    """Batches of a key and shard in event-time order, cut bucket by bucket."""

    def __init__(self, batch_size: int, idle_ms: int, bucket_ms: int):
        self.batch_size = batch_size
        self.idle_us = idle_ms * 1000
        self.bucket_us = bucket_ms * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", OPEN_BATCH)
        self.buckets = handle.getMapState("buckets", "bucket bigint", "us binary")
        self.cut_at: dict[tuple, int] = {}

    def _frame(self, key, rows, first, last, release, row_id, kind) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "key": key[0],
                "shard": key[1],
                "batch_rows": rows,
                "first_ts": pd.to_datetime(first, unit="us"),
                "last_ts": pd.to_datetime(last, unit="us"),
                "release": release,
                "row_id": row_id,
                "kind": kind,
            },
            columns=[part.split()[0] for part in OUTPUT.split(", ")],
        )

    def _batches(self, key, rows, first, last) -> pd.DataFrame:
        release = np.where(rows == self.batch_size, "count", "idle")
        return self._frame(key, rows, first, last, release, None, BATCHES)

    def _times(self, bucket: int) -> np.ndarray:
        return np.frombuffer(bytes(self.buckets.getValue((bucket,))[0]), np.int64)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        for chunk in rows:
            aside = chunk[~(chunk["us"] > passed)]
            if len(aside):
                moment = pd.to_datetime(aside["us"].astype("Int64"), unit="us").to_numpy("datetime64[us]")
                release = np.where(aside["us"].isna(), "untimed", "late")
                yield self._frame(key, 1, moment, moment, release, aside["row_id"].to_numpy(), LATE)
            us = chunk["us"][chunk["us"] > passed].to_numpy(np.int64)
            us = np.sort(us)
            owner = us // self.bucket_us
            cuts = np.flatnonzero(np.diff(owner)) + 1
            for part in np.split(us, cuts) if len(us) else ():
                bucket = int(part[0] // self.bucket_us)
                if self.buckets.containsKey((bucket,)):
                    part = np.concatenate((self._times(bucket), part))
                else:
                    self.handle.registerTimer((bucket + 1) * self.bucket_us // 1000)
                self.buckets.updateValue((bucket,), (part.tobytes(),))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        if self.cut_at.get(tuple(key)) == passed:  # the first of this key's timers has done it all
            return
        waiting = sorted(bucket[0] for bucket in self.buckets.keys())
        held = tuple(self.open.get()) if self.open.exists() else None
        whole = [bucket for bucket in waiting if (bucket + 1) * self.bucket_us <= passed + 1]
        if len(whole) > 1:
            self.cut_at[tuple(key)] = passed
        ready, count = [], 0
        for bucket in whole:
            batches = split_batches(np.sort(self._times(bucket)), held, self.batch_size, self.idle_us)
            held = None
            if batches[0][-1] < self.batch_size:
                held = tuple(int(part[-1]) for part in batches)
                batches = tuple(part[:-1] for part in batches)
            ready.append(batches)
            count += len(batches[0])
            if count > FRAME_ROWS:
                yield self._batches(key, *map(np.concatenate, zip(*ready)))
                ready, count = [], 0
            self.buckets.removeKey((bucket,))
        if held and held[2] + self.idle_us <= passed:
            later = waiting[len(whole) :]
            if not later or self._times(later[0]).min() - held[2] > self.idle_us:
                ready.append(tuple(np.array([part]) for part in held))
                count += 1
                held = None
        elif held:
            self.handle.registerTimer((held[2] + self.idle_us) // 1000 + 1)
        if held:
            self.open.update(held)
        else:
            self.open.clear()
        if count:
            yield self._batches(key, *map(np.concatenate, zip(*ready)))

    def close(self) -> None:
        pass


def bounded_batches(
    rows: DataFrame,
    key: str,
    ts: str,
    batch_size: int,
    idle_ms: int,
    late_by: str,
    row_id: Column | None = None,
    bucket_seconds: int = BUCKET_SECONDS,
    shards: int = 1,
    spread_by: str | None = None,
) -> DataFrame:
    """Batches as they are released (``kind`` batch) and each row that came too late (``kind`` late).

    A row is late if the watermark of its micro-batch, ``late_by`` behind the newest time of the micro-batches
    before, has reached its time; it comes out by itself with its ``row_id`` and the release 'late', a row
    without a time with 'untimed'. A null key is a key. Batches of rows that are in time are the same for any
    micro-batches. Times before 1970 are late from the start, because watermarks begin there. The open batch of
    a quiet key goes out once the watermark is ``idle_ms`` past it. ``shards`` splits a busy key by
    ``spread_by``; each shard batches by itself. A micro-batch writes again the buckets that it adds to, so
    ``bucket_seconds`` should be near the time between two of them. Needs the RocksDB state store.
    """
    shard = F.pmod(F.hash(spread_by), F.lit(shards)) if spread_by and shards > 1 else F.lit(0)
    own = F.lit(None) if row_id is None else row_id
    timed = rows.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late_by)
    # Only a number goes on: Spark itself would drop late rows by a column that has the watermark.
    keyed = timed.select(
        F.col(key).cast("string").alias("key"),
        shard.cast("int").alias("shard"),
        F.unix_micros("_ts").alias("us"),
        own.cast("string").alias("row_id"),
    )
    return keyed.groupBy("key", "shard").transformWithStateInPandas(
        statefulProcessor=BucketedBatches(batch_size, idle_ms, bucket_seconds * 1000),
        outputStructType=OUTPUT,
        outputMode="Append",
        timeMode="EventTime",
    )


def start_bounded_batches(
    batches: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Writes what ``bounded_batches`` gives; batches and late rows are partitions of one table."""
    return (
        batches.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("kind")
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )


def _stored(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return spark.read.schema(OUTPUT).parquet(path).where(F.col("kind") == kind).drop("kind")


def stored_batches(spark: SparkSession, path: str) -> DataFrame:
    return _stored(spark, path, BATCHES).drop("row_id")


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """One row for each that came too late or has no time; ``first_ts`` is its time."""
    found = _stored(spark, path, LATE)
    return found.select("key", "shard", F.col("first_ts").alias("ts"), "release", "row_id")
