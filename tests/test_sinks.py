from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F

from roadpulse.config import ArchiveConfig, RollConfig, TableSinkConfig
from roadpulse.operators import parse
from roadpulse.schema import TABLE_SCHEMA, TABLE_TYPES, table_column_types
from roadpulse.session import scratch_path, shared_folder
from roadpulse.sinks import archive, tables
from roadpulse.sinks.dead_letter import dead_letters, deliver


@pytest.fixture
def folder(spark):
    return scratch_path(spark, "sink-test")


@pytest.fixture
def dated(spark):
    return spark.range(1000).select(
        F.col("id"), F.when(F.col("id") % 10 == 0, "2024-01-02").otherwise("2024-01-01").alias("date")
    )


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_archive_is_created_once_then_appended(spark, dated, folder):
    config = ArchiveConfig(folder)
    archive.write_archive(dated, config, mode="errorifexists")
    with pytest.raises(Exception, match="already exists"):
        archive.write_archive(dated, config, mode="errorifexists")
    archive.write_archive(dated, config)
    stored = archive.read_archive(spark, folder)
    assert stored.count() == 2000
    assert all(path.endswith(".snappy.parquet") for path in glob.glob(f"{folder}/*/*.parquet"))


def test_row_limit_rolls_files(spark, dated, folder):
    config = ArchiveConfig(folder, roll=RollConfig(max_rows=300))
    archive.write_archive(dated, config)
    stats = archive.file_stats(archive.read_archive(spark, folder), by=("date",), min_rows=200)
    rows = stats.collect()
    assert sum(row.file_rows for row in rows) == 1000 and max(row.file_rows for row in rows) <= 300
    assert all(row.too_small == (row.file_rows < 200) and row.file_bytes > 0 for row in rows)
    total = archive.file_counters(stats).first()
    assert total.files_created == len(rows) and total.rows_written == 1000


def test_force_flush_writes_a_file_per_row(spark, dated, folder):
    archive.write_archive(dated.limit(7), ArchiveConfig(folder, force_flush=True))
    assert len(glob.glob(f"{folder}/*/*.parquet")) == 7


def test_compaction_joins_files_and_keeps_rows(spark, dated, folder):
    dated.repartition(20).write.partitionBy("date").parquet(folder + "/small")
    archive.compact(spark, folder + "/small", ArchiveConfig(folder + "/large"))
    assert len(glob.glob(f"{folder}/small/*/*.parquet")) == 40
    assert len(glob.glob(f"{folder}/large/*/*.parquet")) == 2
    large = archive.read_archive(spark, folder + "/large")
    assert large.count() == 1000 and large.select("id").distinct().count() == 1000


def test_compaction_is_not_bound_by_the_row_limit(spark, dated, folder):
    dated.repartition(20).write.partitionBy("date").parquet(folder + "/small")
    archive.compact(spark, folder + "/small", ArchiveConfig(folder + "/large", roll=RollConfig(max_rows=10)))
    assert len(glob.glob(f"{folder}/large/*/*.parquet")) == 2


def test_partition_filter_skips_folders(spark, dated, folder):
    archive.write_archive(dated, ArchiveConfig(folder))
    wanted = archive.read_archive(spark, folder).where("date = DATE'2024-01-02'")
    assert wanted.count() == 100
    assert {row.file_path.split("date=")[1][:10] for row in archive.with_file_columns(wanted).collect()} == {
        "2024-01-02"
    }


MESSAGE = '{"vehicle_id":%s,"vin":"%s","event_time":"%s","g_force":6.25}'


def test_events_table_types_and_misfits(spark, texts):
    frame = texts(
        MESSAGE % (620, "V", "2025-03-02T08:00:01.500Z"),
        MESSAGE % (621, "V", "1740902401"),
        MESSAGE % (2**40, "V", "1740902401"),
        MESSAGE % (1, "V" * 256, "1740902401"),
        MESSAGE % (2, "V", "yesterday"),
    )
    fitting, rejected = tables.split_fitting(parse.typed_record(frame))
    typed = tables.as_events_table(fitting)
    assert typed.schema == TABLE_SCHEMA
    assert [(r.vehicle_id, r.event_time, r.g_force) for r in typed.collect()] == [
        (620, 1740902401, 6.25),
        (621, 1740902401, 6.25),
    ]
    assert sorted(row.vehicle_id for row in rejected.collect()) == [1, 2, 2**40]


def test_events_table_is_bucketed_by_vehicle(spark, texts, folder):
    frame = texts(*[MESSAGE % (i % 5, "V", "1740902401") for i in range(50)])
    typed = tables.as_events_table(parse.typed_record(frame))
    archive.save_events_table(typed, "bucketed_events", folder, buckets=4)
    assert spark.table("bucketed_events").count() == 50
    described = {row.col_name: row.data_type for row in spark.sql("DESC EXTENDED bucketed_events").collect()}
    assert described["Num Buckets"] == "4" and "vehicle_id" in described["Bucket Columns"]
    joined = spark.table("bucketed_events").groupBy("vehicle_id").count()
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString().split("Scan")[0]
    spark.sql("DROP TABLE bucketed_events")


class Writer:
    """Stands for a DataFrameWriter and notes what it is told."""

    def __init__(self, columns):
        self.columns, self.options, self.saved = columns, {}, None

    def format(self, name):
        self.kind = name
        return self

    def option(self, name, value):
        self.options[name] = value
        return self

    def mode(self, name):
        self.saved = name
        return self

    def save(self):
        assert self.saved


def test_jdbc_append_and_initialisation(spark, texts, monkeypatch):
    made = []

    def write(self):
        made.append(Writer(self.columns))
        return made[-1]

    monkeypatch.setattr(type(texts("x")), "write", property(write))
    config = TableSinkConfig("events", r"id:payload.id,message", batch_size=50)
    rows = spark.createDataFrame([(1, 2.5)], "id int, message double")
    tables.append_rows(rows, "jdbc:x", config, {"user": "u"})
    assert made[0].kind == "jdbc" and made[0].saved == "append"
    assert made[0].options == {"url": "jdbc:x", "dbtable": "events", "user": "u", "batchsize": 50}
    tables.initialize_table(rows, "jdbc:x", config)
    assert made[1].saved == "overwrite"
    assert made[1].options["createTableColumnTypes"] == "id VARCHAR(2000), message VARCHAR(2000)"


def test_initial_table_holds_text(spark):
    rows = spark.createDataFrame([(1, 2.5, True, None)], "a int, b double, c boolean, d string")
    assert tables.as_initial_table(rows).first() == ("1", "2.5", "true", None)


def test_column_ddl_of_the_typed_table():
    ddl = table_column_types()
    assert len(ddl.split(", ")) == len(TABLE_TYPES) == 33
    assert "vehicle_id INTEGER" in ddl and "event_time BIGINT" in ddl
    assert "vin VARCHAR(255)" in ddl and "gps_latitude DOUBLE PRECISION" in ddl
    assert ddl.count(" REAL") == 17


def test_script_ignores_failed_drops_only(spark, folder):
    tables.run_script(
        spark,
        "DROP TABLE no_such_table;\n"
        f"CREATE TABLE scripted (id INT) USING parquet LOCATION '{folder}';",
    )
    assert spark.table("scripted").count() == 0
    with pytest.raises(Exception):
        tables.run_script(spark, "INSERT INTO no_such_table VALUES (1)")
    spark.sql("DROP TABLE scripted")


def test_set_up_follows_the_setting(spark, monkeypatch, folder):
    rows, calls = spark.range(1), []
    monkeypatch.setattr(tables, "initialize_table", lambda *a: calls.append("made"))
    tables.set_up_table(rows, "jdbc:x", TableSinkConfig(initialize="false"))
    assert calls == []
    tables.set_up_table(rows, "jdbc:x", TableSinkConfig(initialize="true"))
    assert calls == ["made"]
    spark.createDataFrame([("CREATE TEMPORARY VIEW from_script AS SELECT 7 AS n;",)]).coalesce(
        1
    ).write.text(folder)
    tables.set_up_table(rows, "jdbc:x", TableSinkConfig(initialize=folder))
    assert spark.table("from_script").first().n == 7


def test_readable_view(spark):
    tables.create_readable_view(spark.sql("SELECT 1740902401L AS event_time"), "readable_test")
    row = spark.table("readable_test").first()
    assert str(row.event_time_utc) == "2025-03-02 08:00:01"


def test_migrations(spark):
    frame = spark.sql("SELECT timestamp'1970-01-01 00:01:00' AS t, 1 AS x")
    assert tables.retype_to_epoch(frame, "t").first().t == 60
    again = tables.recreate_column(frame, "t", "bigint")
    assert again.first().t is None and dict(again.dtypes)["t"] == "bigint"


@pytest.mark.parametrize("failures, attempts, quarantined", [(0, 1, 0), (2, 3, 0), (3, 3, 1), (9, 3, 1)])
def test_delivery_gives_up_after_three_attempts(texts, failures, attempts, quarantined):
    tries, letters = [], []

    def write(rows):
        tries.append(1)
        if len(tries) <= failures:
            raise ConnectionError("down")

    made = deliver(texts("a"), write, lambda rows, reason, n: letters.append((reason, n)))
    assert (made, len(tries), len(letters)) == (attempts, attempts, quarantined)
    assert not letters or letters == [("ConnectionError", 3)]


def test_dead_letter_rows(texts):
    row = dead_letters(texts("bad"), F.lit("Why"), at=F.lit("now")).first()
    assert row.asDict() == {"payload": "bad", "error_class": "Why", "attempts": 3, "ts": "now"}
