"""Count-or-idle batching on a stream.

``released_batches`` keeps the open batch of each key in state and releases it when it is full
or its key stays quiet. ``session_batches`` lists the same batches once a quiet gap has closed
the session, from counts alone.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

RELEASED = (
    "key string, shard int, batch_rows bigint, first_ts timestamp, last_ts timestamp, "
    "release string"
)
OPEN_BATCH = "batch_rows bigint, first_us bigint, last_us bigint"
WAITING = "us array<bigint>"
#: Batch numbers of a session that are made at once.
RUN = 4096

# The processor travels with its query, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def split_batches(moments: np.ndarray, held: tuple | None, size: int, idle: int):
    """Cuts sorted times into batches, going on with the ``held`` one (rows, first, last).

    Returns the rows, first and last time of each batch, as arrays; only the last may be open.
    """
    before = np.concatenate(([held[2] if held else moments[0]], moments[:-1]))
    opens = moments - before > idle
    opens[0] |= held is None
    session = np.cumsum(opens)
    place = np.arange(len(moments)) + (held[0] if held else 0)
    starts = np.flatnonzero(opens)
    if len(starts):
        in_session = session > 0
        place[in_session] = (np.arange(len(moments)) - starts[session - 1])[in_session]
    number = place // size
    cuts = np.flatnonzero((np.diff(session) != 0) | (np.diff(number) != 0)) + 1
    begins, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(moments)]))
    rows, first, last = ends - begins, moments[begins], moments[ends - 1]
    if held and not opens[0]:
        rows[0], first[0] = rows[0] + held[0], held[1]
    elif held:
        rows, first, last = (np.concatenate(([h], x)) for h, x in zip(held, (rows, first, last)))
    return rows, first, last


class CountOrIdle(StatefulProcessor):
    """Batches of a key and shard in event-time order, whatever order its rows arrive in.

    Times wait in state until the watermark has passed them, so no earlier row can follow; only
    then are they cut into batches. Beside them the open batch is kept: rows, first and last time.
    """

    def __init__(self, batch_size: int, idle_ms: int):
        self.batch_size = batch_size
        self.idle_us = idle_ms * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", OPEN_BATCH)
        self.waiting = handle.getListState("waiting", WAITING)

    def _released(self, key, rows, first, last) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "key": key[0],
                "shard": key[1],
                "batch_rows": rows,
                "first_ts": pd.to_datetime(first, unit="us"),
                "last_ts": pd.to_datetime(last, unit="us"),
                "release": np.where(rows == self.batch_size, "count", "idle"),
            }
        )

    def _cut(self, key, watermark_us: int) -> Iterator[pd.DataFrame]:
        parts = [np.asarray(part[0], np.int64) for part in self.waiting.get()]
        moments = np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.int64)
        ready, later = np.split(moments, [np.searchsorted(moments, watermark_us, "right")])
        held = tuple(self.open.get()) if self.open.exists() else None
        if len(ready):
            batches = split_batches(ready, held, self.batch_size, self.idle_us)
            held = None
            if batches[0][-1] < self.batch_size:
                held = tuple(int(part[-1]) for part in batches)
                batches = tuple(part[:-1] for part in batches)
            if len(batches[0]):
                yield self._released(key, *batches)
            if len(later):
                self.waiting.put([(later.tolist(),)])
            else:
                self.waiting.clear()
        if held and held[2] + self.idle_us <= watermark_us:
            yield self._released(key, *(np.array([part]) for part in held))
            held = None
        if held:
            self.open.update(held)
        else:
            self.open.clear()
        due = [int(later[0])] if len(later) else []
        due += [held[2] + self.idle_us] if held else []
        if due:
            self.handle.registerTimer(min(due) // 1000 + 1)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for chunk in rows:
            moments = chunk["ts"].dropna().to_numpy("datetime64[us]").astype("int64")
            if len(moments):
                self.waiting.appendValue((moments.tolist(),))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        yield from self._cut(key, timerValues.getCurrentWatermarkInMs() * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._cut(key, timerValues.getCurrentWatermarkInMs() * 1000)

    def close(self) -> None:
        pass


def released_batches(
    rows: DataFrame,
    key: str,
    ts: str,
    batch_size: int,
    idle_ms: int,
    late_by: str,
    shards: int = 1,
    spread_by: str | None = None,
) -> DataFrame:
    """Batches of a stream as they are released, the same for any files, chunks and micro-batches.

    A row may come up to ``late_by`` after later ones; what comes later still is dropped, and the
    query's progress counts it. State holds one time per row of the last ``late_by``.
    Like several loader instances that batch side by side, ``shards`` splits a busy key by
    ``spread_by`` so that one task need not take all of it. Needs the RocksDB state store.
    """
    shard = F.pmod(F.hash(spread_by), F.lit(shards)) if spread_by and shards > 1 else F.lit(0)
    keyed = rows.select(
        F.col(key).cast("string").alias("key"),
        shard.cast("int").alias("shard"),
        F.col(ts).cast("timestamp").alias("ts"),
    )
    return (
        keyed.withWatermark("ts", late_by)
        .groupBy("key", "shard")
        .transformWithStateInPandas(
            statefulProcessor=CountOrIdle(batch_size, idle_ms),
            outputStructType=RELEASED,
            outputMode="Append",
            timeMode="EventTime",
        )
    )


def session_batches(
    rows: DataFrame, key: str, ts: str, batch_size: int, idle: str, late_by: str
) -> DataFrame:
    """The batches of each closed session, from one merged count per session."""
    timed = rows.select(F.col(key).alias("key"), F.col(ts).cast("timestamp").alias("ts"))
    sessions = (
        timed.withWatermark("ts", late_by)
        .groupBy("key", F.session_window("ts", idle))
        .agg(F.count(F.lit(1)).alias("session_rows"), F.min("ts").alias("first_ts"))
    )
    last = F.floor((F.col("session_rows") - F.lit(1)) / F.lit(batch_size)).cast("bigint")
    # Numbers come in runs, so that no array grows with a session's batches.
    run = F.lit(RUN).cast("bigint")
    runs = sessions.withColumn("_last", last).select(
        "*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("_last") / run).cast("bigint"))).alias("_run")
    )
    begin = F.col("_run") * run
    end = F.least(begin + run - F.lit(1), F.col("_last"))
    numbered = runs.select("*", F.explode(F.sequence(begin, end)).alias("batch_no"))
    size = F.least(
        F.lit(batch_size).cast("bigint"),
        F.col("session_rows") - F.col("batch_no") * F.lit(batch_size),
    )
    return numbered.select(
        "key", F.col("first_ts").alias("session_ts"), "batch_no", size.alias("batch_rows")
    )
