"""Changes to a folder of Parquet files that readers see as a whole or not at all.

A change writes its files under a hidden folder of the archive and lists the files it replaces in a
table beside them. It counts from the moment an empty marker file exists, and creating that is one step
of the file system. A job that is lost before it leaves files that no reader looks at; ``vacuum`` removes
those and the files that changes have replaced. Plain appends to the folder go on as before. One
maintenance job at a time may change a folder; readers need no lock, but a reader that started before a
``vacuum`` may miss files that it removes.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from roadpulse.sinks.small_files import read_small

FOLDER = "_commits"
FILE_COLUMNS = ("file_path", "file_size")
_CHANGE = "_change"


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def _names(spark: SparkSession, path: str) -> list[str]:
    system, found = _path(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(found)) if system.exists(found) else []


def new_change() -> str:
    return uuid.uuid4().hex


def data_folder(path: str, change: str) -> str:
    """Where the files of a change are written."""
    return f"{path}/{FOLDER}/data/{_CHANGE}={change}"


def _replaced_folder(path: str, change: str) -> str:
    return f"{path}/{FOLDER}/replaced/{change}"


def list_folder(path: str, change: str) -> str:
    """Where the files of a change are listed, if its tasks wrote them by themselves."""
    return f"{path}/{FOLDER}/files/{change}"


def commit(spark: SparkSession, path: str, change: str, replaced: DataFrame | None = None) -> None:
    """Makes a change count. ``replaced`` has the ``file_path`` of each file that it stands for."""
    if replaced is not None:
        replaced.select("file_path").write.parquet(_replaced_folder(path, change))
    system, marker = _path(spark, f"{path}/{FOLDER}/done/{change}")
    system.create(marker, False).close()


def committed(spark: SparkSession, path: str) -> list[str]:
    return _names(spark, f"{path}/{FOLDER}/done")


def _replaced(spark: SparkSession, path: str, changes: list[str]) -> DataFrame | None:
    listed = set(_names(spark, f"{path}/{FOLDER}/replaced"))
    paths = [_replaced_folder(path, change) for change in changes if change in listed]
    return spark.read.schema("file_path string").parquet(*paths) if paths else None


def read(spark: SparkSession, path: str, files: bool = False) -> DataFrame:
    """The rows that count; with ``files`` also the path and size of each row's file."""

    def loaded(*paths: str, base: str, schema: StructType | None = None) -> DataFrame:
        reader = spark.read.option("basePath", base)
        rows = (reader.schema(schema) if schema else reader).parquet(*paths)
        return rows.select("*", *[F.col(f"_metadata.{name}").alias(name) for name in FILE_COLUMNS]).drop(_CHANGE)

    changes = committed(spark, path)
    if not changes:
        rows = loaded(path, base=path)
    else:
        rows = loaded(*[data_folder(path, c) for c in changes], base=f"{path}/{FOLDER}/data")
        if any(not name.startswith(("_", ".")) for name in _names(spark, path)):
            # its folders may hold no files any more, so that they have no schema of their own
            own = StructType([f for f in rows.schema.fields if f.name not in FILE_COLUMNS])
            rows = loaded(path, base=path, schema=own).unionByName(rows)
    gone = _replaced(spark, path, changes)
    if gone is not None:
        rows = rows.join(gone, "file_path", "left_anti").select(rows.columns)
    return rows if files else rows.drop(*FILE_COLUMNS)


def read_files(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The columns of ``schema`` of ``read`` with ``files``, partition columns in the types named there.

    Where all changes have lists of their files, tasks open those and the driver needs no list of its own.
    """
    changes = committed(spark, path)
    own = any(not name.startswith(("_", ".")) for name in _names(spark, path))
    if not changes or own or set(changes) - set(_names(spark, f"{path}/{FOLDER}/files")):
        rows = read(spark, path, files=True)
        return rows.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields], *FILE_COLUMNS)
    files = spark.read.parquet(*[list_folder(path, change) for change in changes])
    gone = _replaced(spark, path, changes)
    if gone is not None:
        files = files.join(gone, "file_path", "left_anti").select(files.columns)
    return read_small(files, files.count(), schema)


def vacuum(spark: SparkSession, path: str) -> int:
    """Removes replaced files and what unfinished changes have left; returns how many files or folders."""
    changes, removed = committed(spark, path), 0
    gone = _replaced(spark, path, changes)
    for row in gone.toLocalIterator() if gone is not None else ():
        system, found = _path(spark, unquote(row.file_path))
        removed += system.delete(found, False)
    # What lists removed files goes before the tables that tell which are removed.
    lists = changes if gone is None else []
    for kind, names in (("data", [f"{_CHANGE}={c}" for c in changes]), ("files", lists), ("replaced", [])):
        for name in _names(spark, f"{path}/{FOLDER}/{kind}"):
            if name not in names:
                system, found = _path(spark, f"{path}/{FOLDER}/{kind}/{name}")
                removed += kind == "data"
                system.delete(found, True)
    return removed
