"""The events table distributed by vehicle, by its measured volume, for aggregates without an exchange.

The rows of each vehicle are counted first. Buckets are as many as hold ``bucket_rows`` rows each; a vehicle
with more rows than that is dealt over several slots, and (vehicle, slot) is the bucket key. So each bucket is
one task's and one file's on writing and on reading, whatever share of the rows one vehicle has. A row's slot
comes from its content, so that a repeated task deals it alike; rows equal in all columns share a slot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.session import scratch_path
from roadpulse.sinks.archive import COMPRESSION

#: Rows of one bucket, some hundred megabytes of the 33-column record.
BUCKET_ROWS = 2_000_000
#: Buckets come in multiples of this, and as many small ones are written by one task.
STEP = 16
MOST_BUCKETS = "spark.sql.sources.bucketing.maxBuckets"
# How partial results of an aggregate are combined.
MERGE = {"count": "sum", "sum": "sum", "min": "min", "max": "max"}
HOT_PROPERTY = "hot_vehicles"


def measured(events: DataFrame, bucket_rows: int = BUCKET_ROWS) -> tuple[int, DataFrame]:
    """How many buckets the events need, and the vehicles that need several ``slots``.

    Those are fewer than rows / ``bucket_rows``, that is than buckets.
    """
    counted = events.groupBy("vehicle_id").agg(F.count(F.lit(1)).alias("n"))
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    wanted, buckets = -(-total // bucket_rows), 1
    while buckets < min(wanted, STEP):
        buckets *= 2
    buckets = max(buckets, -(-wanted // STEP) * STEP if wanted > STEP else 1)
    hot = counted.where(F.col("n") > bucket_rows)
    return buckets, hot.select("vehicle_id", F.ceil(F.col("n") / F.lit(bucket_rows)).cast("int").alias("slots"))


def writing_tasks(buckets: int, bucket_rows: int) -> int:
    """How many tasks write the buckets: small buckets share one. It divides ``buckets``, so that each bucket
    is still one task's and one file."""
    shared = STEP
    while shared > 1 and (buckets % shared or shared * bucket_rows > BUCKET_ROWS):
        shared //= 2
    return buckets // shared


def save_by_vehicle(events: DataFrame, table: str, path: str, bucket_rows: int = BUCKET_ROWS) -> int:
    """Writes a new events table at ``path``; returns its number of buckets.

    ``events`` is computed once and held; it needs ``vehicle_id`` and ``event_time``; null is a vehicle like any other.
    The table gets two more columns: the row's ``slot`` and in how many ``slots`` its vehicle lies. Beyond
    Spark's limit on buckets they hold more rows each.
    """
    spark = events.sparkSession
    held = scratch_path(spark, "vehicle-rows")
    events.write.parquet(held)
    events = spark.read.schema(events.schema).parquet(held)
    buckets, found = measured(events, bucket_rows)
    buckets = min(buckets, int(spark.conf.get(MOST_BUCKETS)))
    hot = spark.createDataFrame(found.collect(), found.schema).withColumnsRenamed({"vehicle_id": "_hot"})
    slots = F.coalesce("slots", F.lit(1))
    content = F.xxhash64(*[F.col(name) for name in events.columns])
    dealt = (
        events.withColumn("_content", content)
        .join(F.broadcast(hot), F.col("vehicle_id").eqNullSafe(F.col("_hot")), "left")
        .withColumn("slots", slots)
        .withColumn("slot", F.pmod("_content", "slots").cast("int"))
        .drop("_hot", "_content")
    )
    (
        dealt.repartition(writing_tasks(buckets, bucket_rows), "vehicle_id", "slot")
        .write.format("parquet")
        .option("path", path)
        .option("compression", COMPRESSION)
        .bucketBy(buckets, "vehicle_id", "slot")
        .sortBy("event_time")
        .saveAsTable(table)
    )
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{HOT_PROPERTY}' = '{hot.count()}')")
    return buckets


def hot_vehicles(spark: SparkSession, table: str) -> int:
    found = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == HOT_PROPERTY).first()
    return int(found.value) if found else 0


def per_vehicle(spark: SparkSession, table: str, aggregates: dict[str, tuple[str, str]]) -> DataFrame:
    """Aggregates of each vehicle: result name to function (count, sum, min, max) and column.

    Buckets hold vehicles whole, so they are aggregated where they lie. Where some lie in several slots, the
    one row of each vehicle and slot is exchanged.
    """
    rows = spark.table(table)

    def results(of: dict[str, tuple[str, str]]) -> list[Column]:
        return [getattr(F, function)(column).alias(name) for name, (function, column) in of.items()]

    placed = rows.groupBy("vehicle_id", "slot").agg(*results(aggregates))
    if not hot_vehicles(spark, table):
        return placed.drop("slot")
    return placed.groupBy("vehicle_id").agg(*results({n: (MERGE[f], n) for n, (f, _) in aggregates.items()}))
