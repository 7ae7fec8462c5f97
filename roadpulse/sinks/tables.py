"""The table loader: typed casts, JDBC writes and table initialisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from roadpulse.config import TableSinkConfig
from roadpulse.functions.times import epoch_seconds, readable
from roadpulse.operators.mapping import column_map
from roadpulse.operators.parse import keep_where
from roadpulse.schema import ARCHIVE_TYPES, TABLE_TEXT_LENGTH, TABLE_TYPES

# The columns whose archive value can be out of the table column's reach.
NARROWED = [
    name
    for name, kind in TABLE_TYPES.items()
    if kind == "string" or (kind != ARCHIVE_TYPES[name] and kind != "float")
]

# Fixed value: type of every column in a table made from the mapping alone.
INITIAL_COLUMN_TYPE = "VARCHAR(2000)"


def as_events_table(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Archive records with the events table's types; event times become epoch seconds.

    A value its column cannot hold is NULL; ``split_fitting`` sets such records aside first.
    """
    return records.select(*keep, *[_table_value(name).alias(name) for name in TABLE_TYPES])


def _table_value(name: str) -> Column:
    column = F.col(name)
    if name == "event_time":
        return epoch_seconds(column)
    kind = TABLE_TYPES[name]
    if kind == "string":
        return F.when(F.length(column) <= TABLE_TEXT_LENGTH, column)
    return column.try_cast(kind)


def split_fitting(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records whose every value fits its table column, records to quarantine)."""
    fits = F.lit(True)
    for name in NARROWED:
        fits = fits & (F.col(name).isNull() | _table_value(name).isNotNull())
    marked = records.withColumn("_fits", fits)
    fitting = keep_where(marked, F.col("_fits")).drop("_fits")
    return fitting, keep_where(marked, ~F.col("_fits")).drop("_fits")


def initial_column_types(columns: str | dict[str, str]) -> str:
    """Column DDL of a freshly initialised table: every mapped column as text."""
    names = column_map(columns) if isinstance(columns, str) else columns
    return ", ".join(f"{name} {INITIAL_COLUMN_TYPE}" for name in names)


def as_initial_table(rows: DataFrame) -> DataFrame:
    """All columns as text, as the initialised table stores them."""
    return rows.select(*[F.col(name).cast("string").alias(name) for name in rows.columns])


def jdbc_writer(
    rows: DataFrame, url: str, table: str, batch_size: int = 1, properties: dict | None = None
) -> DataFrameWriter:
    """A writer that inserts into the table; each task sends batches of ``batch_size``.

    ``properties`` are the JDBC source's options; ``numPartitions`` bounds the connections.
    """
    writer = rows.write.format("jdbc").option("url", url).option("dbtable", table)
    for name, value in (properties or {}).items():
        writer = writer.option(name, value)
    return writer.option("batchsize", batch_size)


def append_rows(
    rows: DataFrame, url: str, config: TableSinkConfig, properties: dict | None = None
) -> None:
    jdbc_writer(rows, url, config.table, config.batch_size, properties).mode("append").save()


def initialize_table(
    rows: DataFrame, url: str, config: TableSinkConfig, properties: dict | None = None
) -> None:
    """Drops the table if it exists and creates it empty with text columns."""
    empty = as_initial_table(rows).limit(0)
    (
        jdbc_writer(empty, url, config.table, config.batch_size, properties)
        .option("createTableColumnTypes", initial_column_types(config.columns))
        .mode("overwrite")
        .save()
    )


def set_up_table(
    rows: DataFrame, url: str, config: TableSinkConfig, properties: dict | None = None
) -> None:
    """Prepares the target as ``config.initialize`` says.

    ``'false'`` leaves it alone, ``'true'`` makes a new table of text columns, and anything else
    is the location of a script for catalog tables.
    """
    if config.initialize == "true":
        initialize_table(rows, url, config, properties)
    elif config.initialize != "false":
        spark = rows.sparkSession
        run_script(spark, spark.read.text(config.initialize, wholetext=True).first().value)


def run_script(spark: SparkSession, script: str) -> None:
    """Runs a user's initialisation script on catalog tables; a failing DROP is ignored."""
    for statement in (part.strip() for part in script.split(";")):
        if not statement:
            continue
        try:
            spark.sql(statement)
        except Exception:
            if not statement.upper().startswith("DROP"):
                raise


def create_readable_view(events: DataFrame, name: str) -> None:
    """A view of the events with their time as a timestamp and as UTC wall-clock time."""
    readable(events).createOrReplaceTempView(name)


def recreate_column(table: DataFrame, name: str, kind: str) -> DataFrame:
    """Drops a column and adds it with a new type; its values become NULL."""
    return table.drop(name).withColumn(name, F.lit(None).cast(kind))


def retype_to_epoch(table: DataFrame, name: str) -> DataFrame:
    """Changes a timestamp column to epoch seconds and keeps its values."""
    return table.withColumn(name, F.unix_seconds(F.col(name).cast("timestamp")))
