"""Archive files within limits, compaction in place, lookups by five columns and delivery by message."""

from __future__ import annotations

import json
import os
import random
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from roadpulse.config import ArchiveConfig, RollConfig, TableSinkConfig
from roadpulse.session import shared_folder
from roadpulse.sinks import archive, commits, lookup, sizing
from roadpulse.sinks.dead_letter import Ledger, Part, deliver_each
from roadpulse.streaming import pipeline


@pytest.fixture
def folder(spark):
    return f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"


def records(spark, rows: int, days: int = 3):
    """Messages of very different size, a third of them on one day."""
    day = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % days)
    ts = F.timestamp_seconds(day * 86_400 + F.col("id") * 7 % 86_400)
    text = F.concat_ws("", F.transform(F.sequence(F.lit(1), F.when(F.col("id") % 10 == 0, 60).otherwise(2)), lambda i: F.sha2(F.concat(F.col("id").cast("string"), i.cast("string")), 256)))
    return spark.range(rows).select("id", ts.alias("ts"), F.to_date(ts).alias("date"), text.alias("text"))


def test_files_obey_bytes_rows_and_age(spark, folder):
    roll = RollConfig(max_age_minutes=360, max_rows=900, max_size_mb=0.06)
    config = ArchiveConfig(folder, roll=roll)
    rows = records(spark, 6000)
    sizing.write_sized(rows, config, "ts", "id", slices=6)
    files = sizing.file_table(spark, folder, "ts", by=("date",)).collect()
    assert sum(f.file_rows for f in files) == 6000 and len(files) > 12
    for f in files:
        assert f.file_bytes <= roll.max_bytes and f.file_rows <= roll.max_rows
        assert (f.last_ts - f.first_ts).total_seconds() <= 360 * 60
        assert f.file_bytes == os.path.getsize(f.file_path.removeprefix("file:"))
    full = [f for f in files if f.file_bytes > roll.max_bytes / 2 or f.file_rows > roll.max_rows / 2]
    assert len(full) > len(files) / 3
    back = archive.read_archive(spark, folder)
    assert back.columns == [*[c for c in rows.columns if c != "date"], "date"]
    assert {tuple(r) for r in back.select(*rows.columns).collect()} == {tuple(r) for r in rows.collect()}


def test_rows_limit_fills_files(spark, folder):
    config = ArchiveConfig(folder, roll=RollConfig(max_rows=50))
    sizing.write_sized(records(spark, 430, 1), config, "ts", "id", by_age=False, slices=4)
    found = sorted(f.file_rows for f in sizing.file_table(spark, folder, "ts").collect())
    assert found == [30] + [50] * 8


def test_a_row_above_the_limit_has_a_file_of_its_own(spark, folder):
    rows = spark.createDataFrame([(i, size, "2024-01-01") for i, size in enumerate([10, 500, 10, 10, 10, 300])], "id long, size long, date string")
    rows = rows.withColumn("ts", F.timestamp_seconds("id"))
    config = ArchiveConfig(folder, roll=RollConfig(max_rows=10**6, max_size_mb=100 / 1024**2))
    sizing.write_sized(rows, config, "ts", "id", size="size", by_age=False)
    found = commits.read(spark, folder, files=True).groupBy("file_path").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    assert sorted(r.ids for r in found.collect()) == [[0, 1], [2, 3, 4, 5]]


def test_a_task_writes_many_files(spark, folder, monkeypatch):
    ran = []
    write = sizing.write_files
    monkeypatch.setattr(sizing, "write_files", lambda *args: ran.append(write(*args)) or ran[-1])
    place = F.element_at(F.array(F.lit("a b"), F.lit(""), F.lit(None), F.lit("x/y")), (F.col("id") % 4 + 1).cast("int"))
    rows = spark.range(2400).select("id", place.alias("place"), (F.col("id") % 3).alias("part"), F.timestamp_seconds("id").alias("ts"))
    config = ArchiveConfig(folder, ("part", "place"), roll=RollConfig(max_rows=20))
    sizing.write_sized(rows, config, "ts", "id", size="id", by_age=False, slices=4)
    files = commits.read(spark, folder, files=True).groupBy("part", "place", "file_path").agg(F.count("id").alias("n")).collect()
    # NULL and the empty text are one folder with twice the files
    assert len(files) == 120 and all(f.n == 20 for f in files) and ran == [20]
    back = commits.read(spark, folder).select("id", "part").collect()
    assert sorted(map(tuple, back)) == [(i, i % 3) for i in range(2400)]


def test_nothing_to_write(spark, folder):
    config = ArchiveConfig(folder)
    assert sizing.write_sized(records(spark, 0), config, "ts", "id") is None
    assert sizing.write_sized(records(spark, 20), config, "ts", "id") in commits.committed(spark, folder)
    assert archive.read_archive(spark, folder).count() == 20


def mixed_archive(spark, folder) -> ArchiveConfig:
    """One large file and several small ones a day, written by plain appends."""
    config = ArchiveConfig(folder, roll=RollConfig(max_rows=0))
    rows = records(spark, 6600)
    archive.write_archive(rows.where("id < 6000").coalesce(1), config, limit_rows=False)
    for i in range(3):
        archive.write_archive(rows.where((F.col("id") >= 6000 + 200 * i) & (F.col("id") < 6200 + 200 * i)), config, limit_rows=False)
    return config


def paths(spark, folder) -> dict[str, int]:
    return {r.file_path: r.file_bytes for r in sizing.file_table(spark, folder, "ts").collect()}


def test_compaction_rewrites_small_files_only(spark, folder):
    config = mixed_archive(spark, folder)
    before = paths(spark, folder)
    small = max(before.values()) // 2
    target = 2 * small
    change = sizing.compact_small(spark, config, target, order=("ts", "id"))
    after = paths(spark, folder)
    large = {p for p, size in before.items() if size >= small}
    assert large and large <= set(after) and not (set(before) - large) & set(after)
    assert len(after) == len(large) + 3 and all(change in p for p in set(after) - large)
    whole = {tuple(r) for r in records(spark, 6600).select("id", "ts", "text", "date").collect()}
    assert {tuple(r) for r in archive.read_archive(spark, folder).select("id", "ts", "text", "date").collect()} == whole
    held = {p: os.path.getmtime(p.removeprefix("file:")) for p in large}
    assert commits.vacuum(spark, folder) == len(before) - len(large)
    assert paths(spark, folder) == after and held == {p: os.path.getmtime(p.removeprefix("file:")) for p in large}
    assert archive.read_archive(spark, folder).count() == 6600
    archive.write_archive(records(spark, 5).withColumn("id", F.col("id") + 10_000), config, limit_rows=False)
    assert archive.read_archive(spark, folder).count() == 6605


def test_compaction_again_takes_what_it_wrote_before(spark, folder):
    config = mixed_archive(spark, folder)
    sizing.compact_small(spark, config, 1 << 17)
    archive.write_archive(records(spark, 60).withColumn("id", F.col("id") + 10_000), config, limit_rows=False)
    sizing.compact_small(spark, config, 1 << 24, small=0.9)
    assert len(paths(spark, folder)) == 3
    assert archive.read_archive(spark, folder).select("id").distinct().count() == archive.read_archive(spark, folder).count() == 6660
    assert sizing.compact_small(spark, config, 1 << 24, small=0.9) is None


def test_a_compaction_lost_before_its_commit_changes_nothing(spark, folder, monkeypatch):
    config = mixed_archive(spark, folder)
    before, rows = paths(spark, folder), archive.read_archive(spark, folder).count()
    with monkeypatch.context() as patched:
        patched.setattr(commits, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            sizing.compact_small(spark, config, 1 << 24)
    assert list(Path(folder, "_commits/data").iterdir())
    assert paths(spark, folder) == before and archive.read_archive(spark, folder).count() == rows
    sizing.compact_small(spark, config, 1 << 24)
    commits.vacuum(spark, folder)
    assert len(list(Path(folder, "_commits/data").iterdir())) == 1
    assert archive.read_archive(spark, folder).count() == rows


def test_partition_values_with_special_characters(spark, folder):
    config = ArchiveConfig(folder, ("place",), roll=RollConfig(max_rows=3))
    rows = spark.createDataFrame([(i, ("a b", "x/y%z", "ü=1", None)[i % 4]) for i in range(40)], "id long, place string").withColumn("ts", F.timestamp_seconds("id"))
    sizing.write_sized(rows, config, "ts", "id", by_age=False)
    assert len(paths(spark, folder)) == 16
    sizing.compact_small(spark, config, 1 << 24)
    assert len(paths(spark, folder)) == 4
    back = archive.read_archive(spark, folder).select("id", "place").collect()
    assert {tuple(r) for r in back} == {(r.id, r.place) for r in rows.collect()}
    assert commits.vacuum(spark, folder) == 16 and archive.read_archive(spark, folder).count() == 40


def telemetry(spark, rows: int):
    rng = random.Random(3)
    data = [(rng.randrange(10**6), rng.choice((1, rng.randrange(900))), rng.randrange(900), rng.randrange(900), rng.choice((None, rng.random() * 9)), f"v{i}") for i in range(rows)]
    return spark.createDataFrame(data, "event_time long, policy_id int, vehicle_id int, driver_id int, g_force float, vin string")


@pytest.mark.parametrize(
    ("conditions", "most"),
    [
        ({"vehicle_id": (5, 5), "driver_id": (0, 200)}, 30),
        ({"event_time": (100, 2000)}, 30),
        ({"event_time": (100, 200_000), "policy_id": (400, 600), "g_force": (8.0, None)}, 20),
        ({"event_time": (0, 250_000), "vehicle_id": (0, 200), "driver_id": (700, None), "policy_id": (None, 300), "g_force": (None, 2.5)}, 12),
        ({"g_force": (100.0, None)}, 0),
    ],
)
def test_lookups_read_few_files(spark, folder, conditions, most):
    rows = telemetry(spark, 6000)
    lookup.write_lookup(rows, folder, rows_per_file=100)
    lookup.write_lookup(rows.limit(0), folder)
    lookup.write_lookup(rows.limit(50), folder)
    files = lookup.matching_files(spark, folder, conditions)
    assert len(files) <= most and lookup.file_ranges(spark, folder).count() > 50
    found = lookup.look_up(spark, folder, conditions)
    assert found.columns == rows.columns
    wanted = rows.unionByName(rows.limit(50))
    for column, (low, high) in conditions.items():
        wanted = wanted if low is None else wanted.where(F.col(column) >= low)
        wanted = wanted if high is None else wanted.where(F.col(column) <= high)
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))
    read = {r.p for r in found.select(F.col("_metadata.file_path").alias("p")).distinct().collect()} if files else set()
    assert len(read) <= len(files)


def test_lookup_files_are_no_larger_than_their_rows_need(spark, folder):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = telemetry(spark, 600)
    lookup.write_lookup(rows.mapInArrow(counted, rows.schema), folder, rows_per_file=100)
    sizes = [r.size for r in commits.read(spark, folder, files=True).select("file_path", F.col("file_size").alias("size")).distinct().collect()]
    assert len(sizes) >= 5 and max(sizes) < 100_000
    assert seen.value == 600


class Target:
    """Keeps rows by part; refuses parts with a bad row, and single writes while it is down."""

    def __init__(self, bad: set[str], failing: int = 0) -> None:
        self.bad, self.failing = bad, failing
        self.parts: dict[str, list[str]] = {}
        self.writes = 0

    def write(self, rows, part: Part) -> None:
        self.writes += 1
        held = [r.value for r in rows.collect()]
        if self.bad & set(held):
            raise ValueError("refused")
        if self.failing:
            self.failing -= 1
            raise OSError("down")
        self.parts[part.name] = held

    @property
    def rows(self) -> list[str]:
        return sorted(v for part in self.parts.values() for v in part)


def test_only_refused_messages_are_parked(spark, texts, folder):
    values, bad = [f"m{i}" for i in range(60)] + ["m1", "m1"], {"m7", "m31"}
    target, letters = Target(bad), []
    ledger = Ledger(spark, folder)

    def park(rows, failure, attempts, part):
        letters.extend((r.value, failure, attempts) for r in rows.collect())

    assert deliver_each(texts(*values), target.write, park, ledger, 4) == 2
    assert target.rows == sorted(v for v in values if v not in bad)
    assert sorted(letters) == [("m31", "ValueError", 3), ("m7", "ValueError", 3)]
    assert target.writes < 40
    again = Target(bad)
    assert deliver_each(texts(*reversed(values)), again.write, park, ledger, 4) == 2
    assert again.writes == 0 and len(letters) == 2
    assert deliver_each(texts(), again.write, park, ledger, 5) == 0


def test_a_replay_goes_on_where_the_batch_stopped(spark, texts, folder):
    values = [f"m{i}" for i in range(40)]
    ledger, target = Ledger(spark, folder), Target({"m5"})

    class Lost(BaseException):
        pass

    def dies(rows, part):
        if target.writes == 6:
            raise Lost
        target.write(rows, part)

    with pytest.raises(Lost):
        deliver_each(texts(*values), dies, lambda *_: None, ledger, 1)
    done = set(target.parts)
    parked = []
    deliver_each(texts(*values), target.write, lambda rows, *_: parked.extend(r.value for r in rows.collect()), ledger, 1)
    assert parked == ["m5"] and target.rows == sorted(set(values) - {"m5"}) and done <= set(target.parts)


def test_a_broken_target_parks_no_more_than_it_may(spark, texts, folder):
    parked = []
    target = Target(set(f"m{i}" for i in range(30)))
    with pytest.raises(ValueError):
        deliver_each(texts(*target.bad), target.write, lambda rows, *_: parked.append(1), Ledger(spark, folder), 1, most_parked=3)
    assert len(parked) == 3


def test_single_messages_are_tried_again(spark, texts, folder):
    target = Target(set(), failing=2)
    assert deliver_each(texts("a"), target.write, lambda *_: pytest.fail("parked"), Ledger(spark, folder), 1) == 0
    assert target.rows == ["a"] and target.writes == 3


def refuses_sevens(batch) -> None:
    if any(json.loads(value)["a"] % 7 == 0 for value in batch["value"].to_pylist()):
        raise ValueError("refused")


def test_many_refused_messages_cost_one_write(spark, folder, texts):
    writes, letters = [], {}
    rows = f"{folder}/rows"
    store = pipeline.row_parquet(rows, refuses_sevens, max_attempts=2)

    def write(part, name):
        writes.append(name)
        return store(part, name)

    def quarantine(part, name):
        letters[name] = [(r.payload, r.error_class, r.attempts) for r in part.collect()]

    def load(ledger, batch_id, most=None):
        loader = pipeline.message_loader(
            write=write,
            quarantine=quarantine,
            transform=lambda part: part.select("value", F.get_json_object("value", "$.a").cast("int").alias("a")),
            ledger=Ledger(spark, ledger),
            config=TableSinkConfig(max_attempts=2),
            most_parked=most,
        )
        loader(texts(*[f'{{"a":{i}}}' for i in range(500)], "no json"), batch_id)

    load(f"{folder}/ledger", 1)
    assert len(writes) == 1
    stored = spark.read.parquet(rows)
    assert sorted(r.a for r in stored.select("a").collect()) == [i for i in range(500) if i % 7] and "value" not in stored.columns
    refused = [(f'{{"a":{i}}}', "ValueError", 2) for i in range(0, 500, 7)]
    assert sorted(x for part in letters.values() for x in part) == sorted([*refused, ("no json", "JsonParseException", 2)])
    load(f"{folder}/ledger", 1)
    assert len(writes) == 1 and Ledger(spark, f"{folder}/ledger").refused(Part(1, 0, 500), "written") == 72
    with pytest.raises(RuntimeError, match="refused 72"):
        load(f"{folder}/other", 2, most=71)


def test_message_loader_parks_unreadable_and_refused(spark, texts, folder):
    letters = {}
    target = Target({"7"})

    def quarantine(rows, name):
        letters[name] = [(r.payload, r.error_class, r.attempts) for r in rows.collect()]

    load = pipeline.message_loader(
        write=lambda rows, name: target.write(rows, Part(0, *map(int, name.split("-")[1:]))),
        quarantine=quarantine,
        transform=lambda rows: rows.select(F.get_json_object("value", "$.a").alias("value")),
        ledger=Ledger(spark, folder),
        config=TableSinkConfig(max_attempts=2),
    )
    batch = texts(*[f'{{"a":{i}}}' for i in range(12)], "no json")
    load(batch, 3)
    assert target.rows == sorted(str(i) for i in range(12) if i != 7)
    found = sorted(x for part in letters.values() for x in part)
    assert found == [("no json", "JsonParseException", 2), ('{"a":7}', "ValueError", 2)]
    before = target.writes
    load(batch, 3)
    assert target.writes == before and target.rows == sorted(str(i) for i in range(12) if i != 7)
