"""Message sources: JSON texts from files or a broker, batch and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """One message per line, as the text came."""
    return spark.read.text(path)


def stream_messages(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema("value string").format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def stream_rows(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    files: str = "*.parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(folder)


def stream_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    group: str,
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """A named destination on Kafka; needs Spark's Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("groupIdPrefix", group)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    content_type = F.expr("filter(headers, h -> h.key = 'contentType')[0].value")
    return reader.option("includeHeaders", "true").load().select(
        F.col("value").alias("payload"),
        F.decode(content_type, "UTF-8").alias("content_type"),
        "timestamp",
        "partition",
        "offset",
    )


def write_messages(messages: DataFrame, path: str, value: str = "value") -> None:
    """Messages as text files, one per line. JSON texts hold no raw line breaks."""
    messages.select(F.col(value).alias("value")).write.mode("errorifexists").text(path)
