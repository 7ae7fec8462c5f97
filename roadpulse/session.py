"""Session settings the operators rely on, and the shared folder for written tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Set the SQL options the operators need: UTC times, last duplicate JSON key wins."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the driver and all executors can reach, as named by ``spark.checkpoint.dir``.

    Where that is unset, a folder in the warehouse, which they share as well.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder.rstrip("/") if folder else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"


def app_folder(spark: SparkSession) -> str:
    """Where this application keeps its written intermediate tables."""
    return f"{shared_folder(spark)}/roadpulse/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{app_folder(spark)}/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> bool:
    """Remove one intermediate table that nothing reads any more."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


def clean_up(spark: SparkSession) -> bool:
    """Remove all that this application has written as intermediate tables.

    Call it when the results have been consumed: they may still read those tables until then.
    """
    return remove(spark, app_folder(spark))


def default_slices(spark: SparkSession) -> int:
    """How many ranges to cut ordered data into: the session's shuffle width."""
    return max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        spark.sparkContext.defaultParallelism,
    )
