"""Written intermediate tables and size-bounded broadcasts that the operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.tokens import mix
from roadpulse.session import app_folder

FILTER_BITS = 1 << 26
_CHUNK_BITS = 1 << 18


#: Bytes of rows that go to or from Python at once; a longer row goes alone.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Let no more than ``BATCH_BYTES`` of rows into one Arrow batch of this session.

    Spark's own limit of 64 MB holds for each of a stage's Python workers and for the executor's
    side of each; with several copies of a text inside a worker that is more than small executors have.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(name)
    if not held.isdigit() or int(held) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))
    return spark


def folder(spark: SparkSession) -> str:
    """A folder of this application that the driver and all executors share."""
    return f"{app_folder(spark)}/llm"


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Write the rows to the shared folder and read them again.

    The written table ends the lineage: lost executors cost no more than the running job. Shuffle
    files of the job that wrote it are no longer needed and are given back at once.
    """
    spark = frame.sparkSession
    path = f"{folder(spark)}/{label}-{uuid.uuid4().hex}"
    option = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(option, "false")
    spark.conf.set(option, "true")
    try:
        frame.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(option, before)
    return spark.read.schema(frame.schema).parquet(path)


class KeyFilter:
    """A bitmap of hashed keys: False means that the key is certainly absent.

    Its size is fixed whatever the number of keys, so it may be broadcast; with too many keys it
    lets more rows through, and an exact join has to follow.
    """

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits

    @staticmethod
    def slots(keys: np.ndarray, bits: int) -> np.ndarray:
        return (mix(keys.view(np.uint64) + np.uint64(0x5851F42D4C957F2D)) & np.uint64(bits - 1)).astype(np.int64)

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        slot = self.slots(keys, len(self.bits) * 8)
        return (self.bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def key_filter(keys: DataFrame, bits: int = FILTER_BITS):
    """Broadcast a :class:`KeyFilter` of the only (long) column of ``keys``."""
    spark = keys.sparkSession

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = np.unique(KeyFilter.slots(batch.column(0).drop_null().to_numpy(), bits))
            yield pa.RecordBatch.from_arrays([pa.array(slot // _CHUNK_BITS), pa.array(slot)], ["chunk", "slot"])

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            chunk, slot = (batch.column(i).to_numpy() for i in (0, 1))
            for c in np.unique(chunk):
                held.setdefault(int(c), np.zeros(_CHUNK_BITS, bool))[slot[chunk == c] % _CHUNK_BITS] = True
        if held:
            packed = [np.packbits(v, bitorder="little").tobytes() for v in held.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(packed)], ["chunk", "bits"])

    rows = (
        keys.mapInArrow(slots, "chunk long, slot long")
        .repartition(F.col("chunk"))
        .mapInArrow(chunks, "chunk long, bits binary")
        .collect()
    )
    whole = np.zeros(max(bits, _CHUNK_BITS) // 8, np.uint8)
    for chunk, packed in rows:
        whole[chunk * _CHUNK_BITS // 8 : (chunk + 1) * _CHUNK_BITS // 8] |= np.frombuffer(packed, np.uint8)
    return spark.sparkContext.broadcast(KeyFilter(whole))


def repeated(rows: DataFrame, key: str, owner: str, label: str) -> DataFrame:
    """Keys that belong to at least two owners, with the smallest owner, as a written table.

    Only minimum and maximum are kept, so a key that a third of all rows hold costs one row a task.
    """
    found = rows.groupBy(key).agg(F.min(owner).alias("first"), F.max(owner).alias("last"))
    return stored(found.where("first < last").select(key, "first"), label)


def arrow_rows(columns: dict[str, pa.Array | np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v) for v in columns.values()], list(columns))


def by_batch(function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]):
    """Lift a function on one Arrow batch to the form that mapInArrow takes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from function(batch)
            pa.default_memory_pool().release_unused()  # executors keep several workers alive

    return run
