"""Archive files that obey limits of bytes, rows and time span, and compaction of small files.

The records are ranged by (keys, age bucket, time) into slices and written once. What a row takes when
encoded is measured there: a slice file's bytes, shared out by the raw length of its rows. Prefix sums along
each key then cut the rows into files where either limit is reached; a file never reaches over
two age buckets. A task writes many files, each in a folder of its own there (or by itself, see ``small_files``,
where a given size binds), so that tasks are far fewer than small files. Whether all files keep the byte limit is
read from the written files before they count; otherwise they are cut anew, finer by what they were over.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.config import ArchiveConfig, RollConfig
from roadpulse.operators.layout import balanced
from roadpulse.operators.ordered import SLICE, Ordered, ordered, with_index, with_running
from roadpulse.session import default_slices, scratch_path
from roadpulse.sinks import commits, small_files

# Fixed value: the archive's compression.
COMPRESSION = "snappy"
#: Share of the byte limit that a cut aims at, as encoding varies from file to file.
FILL = 0.9
MOST_ATTEMPTS = 5
#: Files that one task writes one after another, where folders are many enough.
FILES_PER_TASK = 100
#: The same where tasks write files by themselves, which needs no folders of their own and takes about a millisecond a file.
SMALL_FILES_PER_TASK = 1000
TASK, FILE_NO, BUCKET = "_task_no", "_file_no", "_age_bucket"


def age_bucket(ts: str, roll: RollConfig) -> Column:
    """Which fixed stretch of the file age limit the row falls in."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    return F.floor(micros / F.lit(roll.max_age_micros)).cast("bigint")


def raw_length(rows: DataFrame) -> Column:
    """Bytes of a row before encoding, near enough to share out a file's bytes."""
    parts = [F.coalesce(F.octet_length(c), F.lit(0)) if k in ("string", "binary") else F.lit(8) for c, k in rows.dtypes]
    return sum(parts[1:], parts[0]).cast("bigint")


def measured(data: Ordered) -> Ordered:
    """Adds ``_bytes``, what a row takes in the written slices, rounded up."""
    sized = data.rows.groupBy(SLICE).agg(F.max("_metadata.file_size").alias("_size"), F.sum("_raw").alias("_all"))
    path = scratch_path(data.rows.sparkSession, "slice-sizes")
    sized.write.parquet(path)
    known = F.broadcast(data.rows.sparkSession.read.schema(sized.schema).parquet(path))  # a row per slice
    share = F.ceil(F.col("_size") * F.col("_raw") / F.greatest("_all", F.lit(1))).cast("bigint")
    return data.each(lambda rows: rows.join(known, SLICE).withColumn("_bytes", share).drop("_size", "_all"))


def cut(data: Ordered, roll: RollConfig, size: str, share: float = 1.0) -> DataFrame:
    """Adds the number of each row's file within its key.

    A file is full when its bytes reach ``share`` of the limit or its rows the row limit, whichever comes
    first: both are counted in one whole number, of which a full file has ``max_bytes * max_rows``.
    """
    most = max(int(roll.max_bytes * share), 1)
    weight = F.greatest(F.col(size) * F.lit(roll.max_rows), F.lit(most)).cast("bigint")
    filled = with_running(data.with_columns({"_fill": weight}), sums={"_filled": "_fill"}).result()
    number = F.floor((F.col("_filled") - F.col("_fill")) / F.lit(most * roll.max_rows))
    return filled.withColumn(FILE_NO, number.cast("bigint")).drop("_fill", "_filled")


def in_folders(rows: DataFrame, named: tuple[str, ...], partitions: tuple[str, ...]) -> tuple[DataFrame, list[str]]:
    """(the files, a row for each value of ``named``, with the columns of their folders; those columns)."""
    # NULL and the empty text are one folder.
    folders = {f"_d{i}": F.nullif(F.col(name).cast("string"), F.lit("")) for i, name in enumerate(partitions)}
    return rows.select(*named).distinct().withColumns(folders), [*folders]


def file_counts(files: DataFrame, folders: list[str]) -> tuple[int, int]:
    """(all files, files of the fullest folder)."""
    in_folder = files.groupBy(*folders).agg(F.count(F.lit(1)).alias("_n"))
    return tuple(in_folder.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.max("_n"), F.lit(0))).first())


def dealt_files(rows: DataFrame, keys: tuple[str, ...], partitions: tuple[str, ...]) -> tuple[DataFrame, int]:
    """(the task of each (keys, file number), number of tasks), dealt so that no task has two files of one folder.

    So a task's files are kept apart by their folders. The files are numbered folder by folder and dealt in
    turn to at least as many tasks as the fullest folder has files.
    """
    spark = rows.sparkSession
    named = (*keys, FILE_NO)
    files, folders = in_folders(rows, named, partitions)
    numbered = with_index(files, (*folders, *named), "_at")
    held = scratch_path(spark, "files")
    numbered.write.parquet(held)
    numbered = spark.read.schema(numbered.schema).parquet(held)
    total, most = file_counts(numbered, folders)
    tasks = max(most, -(-total // FILES_PER_TASK), min(total, default_slices(spark)))
    return numbered.select(*named, (F.col("_at") % F.lit(max(tasks, 1))).cast("int").alias(TASK)), tasks


def write_files(rows: DataFrame, keys: tuple[str, ...], order: tuple[str, ...], partitions: tuple[str, ...], path: str, drop: tuple[str, ...] = (), listed: str | None = None) -> int:
    """One file for each (keys, file number); returns the number of tasks that wrote them.

    With ``listed`` the tasks write the files by themselves, where they can, and list them there.
    """
    named = (*keys, FILE_NO)
    folder = small_files.local_folder(rows.sparkSession, path) if listed else None
    if folder and small_files.plain(rows, named):
        total, most = file_counts(*in_folders(rows, named, partitions))
        slices = default_slices(rows.sparkSession)
        tasks = max(min(most, 4 * slices), -(-total // SMALL_FILES_PER_TASK), min(total, slices))
        if tasks:
            written = small_files.write_small(rows, named, order, partitions, folder, (*drop, FILE_NO), COMPRESSION, tasks)
            balanced(written).write.parquet(listed)
        return tasks
    files, tasks = dealt_files(rows, keys, partitions)
    renamed = files.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(named)], TASK)
    same = [F.col(f"_k{i}").eqNullSafe(F.col(c)) for i, c in enumerate(named)]
    placed = rows.join(renamed, same).drop(*[f"_k{i}" for i in range(len(named))], FILE_NO)
    (
        placed.repartitionById(max(tasks, 1), F.col(TASK))
        .sortWithinPartitions(*partitions, *order)
        .drop(TASK, *drop)
        .write.option("compression", COMPRESSION)
        .option("maxRecordsPerFile", 0)
        .partitionBy(*partitions)
        .parquet(path)
    )
    return tasks


def write_sized(
    records: DataFrame,
    config: ArchiveConfig,
    ts: str,
    tie_breaker: str,
    size: str | None = None,
    by_age: bool = True,
    slices: int | None = None,
) -> str | None:
    """Adds the records to the archive in files that obey ``config.roll``; returns the change's name, or
    None if there are no records.

    ``size`` names a column with the bytes of a row, which then bind instead of the encoded ones.
    """
    spark, roll, partitions = records.sparkSession, config.roll, tuple(config.partition_columns)
    keys = (*partitions, BUCKET)
    bucket = age_bucket(ts, roll) if by_age else F.lit(0).cast("bigint")
    data = ordered(records.withColumns({BUCKET: bucket, "_raw": raw_length(records)}), (ts, tie_breaker), keys, slices)
    data = data if size else measured(data)
    share = 1.0 if size else FILL
    for _ in range(MOST_ATTEMPTS):
        change = commits.new_change()
        folder = commits.data_folder(config.path, change)
        rows = cut(data, roll, size or "_bytes", share).drop("_raw", *([] if size else ["_bytes"]))
        # Limits of encoded bytes are held by the encoder that the slices were measured with.
        listed = commits.list_folder(config.path, change) if size else None
        if not write_files(rows, keys, (ts, tie_breaker), partitions, folder, (BUCKET,), listed):
            return None
        if size:
            commits.commit(spark, config.path, change)
            return change
        written = spark.read.schema(f"`{ts}` {records.schema[ts].dataType.simpleString()}").parquet(folder)
        largest = written.agg(F.max("_metadata.file_size")).first()[0]
        if largest <= roll.max_bytes:
            commits.commit(spark, config.path, change)
            return change
        share *= 0.95 * roll.max_bytes / largest
    raise ValueError(f"a file of {largest} bytes could not be cut to {roll.max_bytes}")


def file_table(spark: SparkSession, path: str, ts: str, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per file of the archive: its rows, bytes and first and last time."""
    return commits.read(spark, path, files=True).groupBy(*by, "file_path").agg(
        F.count(F.lit(1)).alias("file_rows"),
        F.max("file_size").alias("file_bytes"),
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
    )


def pack_small(files: DataFrame, keys: tuple[str, ...], target: int, small: float) -> DataFrame:
    """(keys, file_path, file number) of the small files that share a new file with others.

    ``files`` are rows of metadata: keys, file_path, file_bytes. Files of one key are joined in order of their
    path until they reach the target; a file that would be alone stays as it is.
    """
    rows = files.where(F.col("file_bytes") < F.lit(target * small)).select(*keys, "file_path", "file_bytes")
    filled = with_running(ordered(rows, ("file_path",), keys), sums={"_filled": "file_bytes"}).result()
    numbered = filled.withColumn(FILE_NO, F.floor((F.col("_filled") - F.col("file_bytes")) / F.lit(target)).cast("bigint"))
    several = numbered.groupBy(*keys, FILE_NO).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    same = [numbered[c].eqNullSafe(several[c]) for c in (*keys, FILE_NO)]
    return numbered.join(several, same, "left_semi").select(*keys, "file_path", FILE_NO)


def compact_small(
    spark: SparkSession, config: ArchiveConfig, target: int, small: float = 0.5, order: tuple[str, ...] = ()
) -> str | None:
    """Joins the archive's small files, in place; returns the change's name, or None if there are none to join.

    A file is small below ``small`` of the target bytes. Only small files are read and rewritten; they and the
    files that replace them change places in one commit.
    """
    keys = tuple(config.partition_columns)
    archive = commits.read(spark, config.path, files=True)
    files = archive.groupBy(*keys, "file_path").agg(F.max("file_size").alias("file_bytes"))
    held = scratch_path(spark, "packed")
    pack_small(files, keys, target, small).write.parquet(held)
    packed = spark.read.parquet(held)
    paths = [unquote(row.file_path) for row in packed.select("file_path").toLocalIterator()]
    if not paths:
        return None
    own = [f for f in archive.schema.fields if f.name not in (*keys, *commits.FILE_COLUMNS)]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own)
    rows = spark.read.schema(schema).parquet(*paths).select("*", F.col("_metadata.file_path").alias("file_path"))
    rows = rows.join(packed, "file_path").drop("file_path")
    change = commits.new_change()
    write_files(rows, keys, order, keys, commits.data_folder(config.path, change))
    commits.commit(spark, config.path, change, packed)
    return change
