"""Many small Parquet files of one change, written and read by Python tasks without the driver's help.

Spark's own writer is slow for files of a few rows on a local file system: without Hadoop's native library it starts
processes for the rights of each file, the driver moves every file at the commit, and lists all of them to read them. Here a task
writes its files one after another to their place, under names that depend only on what they hold, each put there
whole by a rename: a task that runs again replaces its files by equal ones. The files are listed in a table, from
which tasks read them again. Folders and Parquet types are those of Spark's writer, so Spark reads them too.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from roadpulse.session import default_slices

# The types that keep their meaning on the way through Arrow, and those that are fit for folder names.
PLAIN = re.compile(r"(tinyint|smallint|int|bigint|float|double|string|binary|boolean|date|timestamp|timestamp_ntz|decimal\(.*\))$")
FOLDER_TYPES = ("tinyint", "smallint", "int", "bigint", "string", "boolean", "date")
# How Spark names the folder of a value, and writes a path as a URI.
DEFAULT_FOLDER = "__HIVE_DEFAULT_PARTITION__"
ESCAPED = re.compile(r"[\x01-\x1f\"#%'*/:=?\\\x7f{\[\]^]")
NOT_IN_URI = re.compile(r"[\x00-\x20\"#%<>?\[\\\]^`{|}\x7f-\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Bytes of a file's rows that a task holds at a time.
HELD_BYTES = 16 << 20
#: Rows from which on a dictionary makes up for its place in a file.
DICTIONARY_ROWS = 1000
#: Files that a task reads, and rows that it hands on at a time.
FILES_READ, ROWS_READ = 1000, 10_000


def local_folder(spark: SparkSession, path: str) -> str | None:
    """The folder as the operating system knows it, None on another file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = found.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(found).toUri().getPath() if system.getUri().getScheme() == "file" else None


def plain(rows: DataFrame, named: tuple[str, ...]) -> bool:
    """Whether the rows can be written here, in files told apart by the columns ``named``."""
    types = dict(rows.dtypes)
    return all(map(PLAIN.match, types.values())) and all(types.get(name) in FOLDER_TYPES for name in named)


def listing(fields: list[StructField]) -> StructType:
    return StructType([*fields, StructField("file_path", StringType()), StructField("file_size", LongType())])


def write_small(
    rows: DataFrame, named: tuple[str, ...], order: tuple[str, ...], partitions: tuple[str, ...], folder: str, drop: tuple[str, ...], compression: str, tasks: int
) -> DataFrame:
    """Writes a file for each value of ``named``, which holds ``partitions``, below a folder of ``local_folder``.

    Returns the list of files, which writes them when it is written itself: ``partitions``, path and size.
    """
    folders = [f"_folder_{i}" for i in range(len(partitions))]
    stored = [name for name in rows.columns if name not in (*partitions, *drop)]
    # The value as text, as Spark names folders; an empty text and NULL are one folder.
    texts = [F.coalesce(F.nullif(F.col(name).cast("string"), F.lit("")), F.lit(DEFAULT_FOLDER)) for name in partitions]
    placed = rows.repartition(max(tasks, 1), *named).sortWithinPartitions(*named, *order)
    placed = placed.select(*rows.columns, *[text.alias(name) for text, name in zip(texts, folders, strict=True)])
    schema = listing([rows.schema[name] for name in partitions])
    listed, version = to_arrow_schema(schema), rows.sparkSession.version
    escaped, not_in_uri, held_bytes, dictionary_rows = ESCAPED, NOT_IN_URI, HELD_BYTES, DICTIONARY_ROWS

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        made, done = set(), []
        key = place = writer = out = hidden = None
        held, size = [], 0

        def escape(text: str) -> str:
            return escaped.sub(lambda m: f"%{ord(m[0]):02X}", text)

        def flush() -> None:
            """Writes the held rows of the open file as a group of rows."""
            nonlocal writer, out, hidden, size
            table = pa.Table.from_batches(held)
            if writer is None:
                at, name = os.path.split(place)
                if at not in made:
                    os.makedirs(at, exist_ok=True)
                    made.add(at)
                hidden = f"{at}/.{name}.{uuid.uuid4().hex}"
                out = pa.OSFile(hidden, "wb")
                writer = pq.ParquetWriter(out, table.schema, compression=compression, store_schema=False, use_dictionary=table.num_rows >= dictionary_rows)
                writer.add_key_value_metadata({"org.apache.spark.version": version})  # dates are as Spark writes them
            writer.write_table(table)
            held.clear()
            size = 0

        def close() -> None:
            nonlocal writer, out, hidden
            flush()
            writer.close()
            length = out.tell()
            out.close()
            os.rename(hidden, place)
            done.append((*key[: len(partitions)], "file:" + not_in_uri.sub(lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), place), length))
            writer = out = hidden = None

        def finished() -> pa.RecordBatch:
            columns = zip(*done, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, listed, strict=True)], schema=listed)

        try:
            for batch in batches:
                n = batch.num_rows
                if not n:
                    continue
                # a new file starts where a column of ``named`` differs from the row before
                differs = pa.array([False] * (n - 1), pa.bool_())
                for name in named:
                    before, after = batch.column(name).slice(0, n - 1), batch.column(name).slice(1)
                    other = pc.coalesce(pc.not_equal(before, after), pc.xor(pc.is_null(before), pc.is_null(after)))
                    differs = pc.or_(differs, other)
                starts = [0, *(i + 1 for i in pc.indices_nonzero(differs).to_pylist())]
                own = batch.select(stored)
                keys = zip(*(batch.column(name).take(pa.array(starts)).to_pylist() for name in (*partitions, *named, *folders)), strict=True)
                for start, end, found in zip(starts, [*starts[1:], n], keys, strict=True):
                    if found != key:
                        if key is not None:
                            close()
                        key = found
                        at = "".join(f"/{escape(name)}={escape(text)}" for name, text in zip(partitions, found[len(found) - len(folders) :], strict=True))
                        place = f"{folder}{at}/part-{hashlib.md5(repr(found).encode()).hexdigest()}.{compression}.parquet"
                    elif size >= held_bytes:
                        flush()
                    rows_here = own.slice(start, end - start)
                    held.append(rows_here)
                    size += rows_here.nbytes
                if done:
                    yield finished()
                    done.clear()
            if key is not None:
                close()
                yield finished()
        finally:
            if hidden is not None:  # the task has failed
                out.close()
                os.unlink(hidden)

    return placed.mapInArrow(write, schema)


def read_small(files: DataFrame, count: int, schema: StructType) -> DataFrame:
    """The rows of listed files, with path and size of each row's file; ``count`` is how many files there are.

    ``schema`` names the columns to read; those of the list itself come from there.
    """
    spark = files.sparkSession
    out = listing(schema.fields)
    target = to_arrow_schema(out)
    inside = [f.name for f in schema.fields if f.name not in files.columns]
    files_read, rows_read = FILES_READ, ROWS_READ

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from urllib.parse import unquote

        import numpy as np
        import pyarrow.parquet as pq

        def joined(tables: list[pa.Table], of: list[int], lines: pa.Table) -> list[pa.RecordBatch]:
            whole, around = pa.concat_tables(tables), lines.take(np.repeat(of, [t.num_rows for t in tables]))
            columns = [(whole if f.name in inside else around).column(f.name).cast(f.type) for f in target]
            return pa.Table.from_arrays(columns, schema=target).combine_chunks().to_batches(max_chunksize=rows_read)

        for batch in batches:
            lines, tables, of, n = pa.Table.from_batches([batch]), [], [], 0
            for i, path in enumerate(batch.column("file_path").to_pylist()):
                with pa.OSFile(unquote(path.removeprefix("file:"))) as file:
                    parts = pq.ParquetFile(file)
                    for part in range(parts.num_row_groups):
                        tables.append(parts.read_row_group(part, columns=inside, use_threads=False))
                        of.append(i)
                        n += tables[-1].num_rows
                        if n >= rows_read:
                            yield from joined(tables, of, lines)
                            tables, of, n = [], [], 0
            if tables:
                yield from joined(tables, of, lines)

    tasks = max(-(-count // files_read), min(count, default_slices(spark)), 1)
    return files.repartition(tasks).mapInArrow(read, out)
