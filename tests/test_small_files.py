"""Files that tasks write and list by themselves: the same rows and paths as Spark reads, in fewer tasks."""

from __future__ import annotations

import datetime
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from roadpulse.config import ArchiveConfig, RollConfig
from roadpulse.plans.queries import CATALOGUE
from roadpulse.session import shared_folder
from roadpulse.sinks import commits, sizing, small_files


@pytest.fixture
def folder(spark):
    return f"{shared_folder(spark)}/small-{uuid.uuid4().hex}"


def odd_rows(spark, rows: int = 480):
    """Rows of many types under folders with odd names."""
    places = [F.lit(x) for x in ("a b", "", None, "x/y%z", "ü=1 ", "it's [1]")]
    kind, i = F.element_at(F.array(*places), (F.col("id") % 6 + 1).cast("int")), F.col("id")
    return spark.range(rows).select(
        "id",
        kind.alias("place"),
        F.when(i % 5 > 0, i % 2 == 0).alias("even"),
        F.expr("date'1500-03-01' + cast(id % 3 as int)").alias("day"),
        F.timestamp_seconds(i * 100_000_000 - 20_000_000_000).alias("ts"),
        F.timestamp_seconds(i).cast("timestamp_ntz").alias("plain_ts"),
        F.when(i % 7 > 0, (i / 3).cast("decimal(12,4)")).alias("part"),
        F.when(i % 4 > 0, F.sha2(i.cast("string"), 256)).alias("text"),
        F.lit(3).cast("tinyint").alias("tiny"),
        F.unhex(F.hex(i)).alias("bytes"),
        F.lit(1).cast("bigint").alias("size"),
    )


def texts(rows) -> list[str]:
    return sorted(map(str, rows.collect()))


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_files_are_those_that_spark_reads(spark, folder, zone):
    config = ArchiveConfig(folder, ("place", "even", "day"), roll=RollConfig(max_rows=7))
    rows, before = odd_rows(spark), spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        sizing.write_sized(rows, config, "ts", "id", size="size", by_age=False, slices=4)
        columns = [*rows.columns, *commits.FILE_COLUMNS]
        found = commits.read_files(spark, folder, rows.schema).select(columns)
        assert found.select(rows.columns).dtypes == rows.dtypes
        # An empty text comes back as NULL from Spark's folders only.
        as_folder = F.when(F.col("place") != "", F.col("place"))
        by_spark = commits.read(spark, folder, files=True).withColumn("even", F.col("even").cast("boolean"))
        assert texts(found.withColumn("place", as_folder)) == texts(by_spark.select(columns))
        assert texts(found.select(rows.columns)) == texts(rows)
        sizes = found.groupBy("file_path").agg(F.count("id").alias("n"), F.count_distinct("place", "even", "day").alias("m"))
        assert sizes.where("n > 7 or m > 1").isEmpty() and sizes.count() >= 480 / 7
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_files_of_one_folder_share_tasks(spark, folder, monkeypatch):
    ran = []
    write = sizing.write_files
    monkeypatch.setattr(sizing, "write_files", lambda *args: ran.append(write(*args)) or ran[-1])
    rows = spark.range(2000).select("id", F.lit("x").alias("place"), F.timestamp_seconds("id").alias("ts"), F.lit(1).cast("bigint").alias("size"))
    sizing.write_sized(rows, ArchiveConfig(folder, ("place",), roll=RollConfig(max_rows=5)), "ts", "id", size="size", by_age=False)
    assert ran[0] < 400  # a task for each of them before
    files = commits.read_files(spark, folder, rows.schema).groupBy("file_path").agg(F.min("id").alias("a"), F.max("id").alias("b"), F.count("id").alias("n"))
    assert sorted((r.a, r.b, r.n) for r in files.collect()) == [(i, i + 4, 5) for i in range(0, 2000, 5)]


def test_a_large_file_is_written_and_read_in_parts(spark, folder, monkeypatch):
    monkeypatch.setattr(small_files, "HELD_BYTES", 100_000)
    monkeypatch.setattr(small_files, "ROWS_READ", 500)
    rows = spark.range(60_000).select("id", F.lit(datetime.date(2024, 1, 1)).alias("date"), F.timestamp_seconds("id").alias("ts"), F.lit(1).cast("bigint").alias("size"))
    roll = RollConfig(max_rows=50_000)
    sizing.write_sized(rows, ArchiveConfig(folder, roll=roll), "ts", "id", size="size", by_age=False)
    found = commits.read_files(spark, folder, rows.schema)
    assert sorted(r["count"] for r in found.groupBy("file_path").count().collect()) == [10_000, 50_000]
    assert texts(found.agg(F.sum("id"), F.count_distinct("id"))) == texts(rows.agg(F.sum("id"), F.count_distinct("id")))
    assert not [p for p in Path(folder.removeprefix("file:")).rglob(".part*") if not p.name.endswith(".crc")]


def test_keys_that_name_no_folder_go_to_sparks_writer(spark, folder):
    rows = spark.range(40).select("id", (F.col("id") % 2 / F.lit(0.5)).alias("half"), F.timestamp_seconds("id").alias("ts"), F.lit(1).cast("bigint").alias("size"))
    change = sizing.write_sized(rows, ArchiveConfig(folder, ("half",), roll=RollConfig(max_rows=5)), "ts", "id", size="size", by_age=False)
    assert not Path(commits.list_folder(folder, change).removeprefix("file:")).exists()
    assert texts(commits.read_files(spark, folder, rows.schema).select(rows.columns)) == texts(rows)


def test_lists_follow_compaction_and_vacuum(spark, folder):
    rows = spark.range(300).select("id", F.lit("x").alias("place"), F.timestamp_seconds("id").alias("ts"), F.lit(1).cast("bigint").alias("size"))
    config = ArchiveConfig(folder, ("place",), roll=RollConfig(max_rows=10))
    for part in ("id < 200", "id >= 200"):
        sizing.write_sized(rows.where(part), config, "ts", "id", size="size", by_age=False)
    assert commits.read_files(spark, folder, rows.schema).select("file_path").distinct().count() == 30
    for _ in range(2):
        found = commits.read_files(spark, folder, rows.schema)
        assert texts(found.select(rows.columns)) == texts(rows)
        sizing.compact_small(spark, config, 1 << 20)
        commits.vacuum(spark, folder)
    assert commits.read_files(spark, folder, rows.schema).select("file_path").distinct().count() == 1
    sizing.write_sized(rows.where("id < 20"), config, "ts", "id", size="size", by_age=False)
    assert commits.read_files(spark, folder, rows.schema).count() == 320


def test_labels_of_files_written_by_few_tasks(spark, tmp_path, monkeypatch):
    ran = []
    write = sizing.write_files
    monkeypatch.setattr(sizing, "write_files", lambda *args: ran.append(write(*args)) or ran[-1])
    moment = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") % 3_000).cast("timestamp_ntz")
    events = spark.range(4_800).select(F.col("id").alias("event_id"), moment.alias("ts"), F.lit('{"k": 1}').alias("props"))
    events.write.parquet(f"{tmp_path}/events.parquet")
    files = CATALOGUE["archive_file_labels"](spark, str(tmp_path)).collect()
    # 4,800 rows of one age bucket, dealt to writers in turn by batches of 500: 1,603, 1,603 and 1,594 rows
    assert sorted((f.writer_id, f.file_no) for f in files) == [(f"writer-{w}", i) for w, n in zip("ABC", (81, 81, 80), strict=True) for i in range(n)]
    first = [f.file_label for f in files if f.file_no == 0]
    assert sorted(first) == [f"telemetry-20240101_00000{s}-instance-0-writer-{w}-170406720{s}000.parquet" for w, s in (("A", 0), ("B", 0), ("C", 1))]
    assert ran[0] < 81  # a task for each file of the fullest folder before
