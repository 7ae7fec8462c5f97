"""What the plans look like: pushed filters, pruned columns, one parse, no Python, no cross join."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from roadpulse.config import ArchiveConfig
from roadpulse.functions import times
from roadpulse.operators import detect, metrics, parse
from roadpulse.operators.ordered import ordered, with_running
from roadpulse.session import scratch_path
from roadpulse.sinks import archive, tables
from roadpulse.sources.tables import events, spread_small
from roadpulse.streaming.pipeline import archive_records


def plan(frame) -> str:
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture(scope="module")
def stored_messages(spark):
    path = scratch_path(spark, "plan-messages")
    spark.range(10).select(
        F.format_string('{"g_force": %d}', "id").alias("value"), F.current_timestamp().alias("ts")
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_recent_events_filter_reaches_the_scan(spark, sf_dir):
    moment = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    text = plan(times.recent(events(spark, sf_dir), "ts", "5 minutes", moment).select("event_id"))
    assert "GreaterThan(ts," in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_rates_read_two_columns(spark, sf_dir):
    text = plan(metrics.rate(events(spark, sf_dir), "ts", ("event_type",)))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in text
    assert "partial_count" in text


def test_accident_filter_does_not_shuffle(stored_messages):
    text = plan(detect.accident_filter(stored_messages))
    assert "Exchange" not in text and "Python" not in text


def test_archive_parses_a_message_once(stored_messages):
    records = archive_records(stored_messages, ArchiveConfig("unused"))
    text = plan(records)
    assert "Filter" in text
    filters = [part for part in text.split("\n\n") if re.search(r"\) Filter", part)]
    assert not any("from_json" in part or "parseJson" in part for part in filters)


def test_detector_counters_parse_once(stored_messages):
    text = plan(metrics.detector_counters(stored_messages))
    aggregates = [part for part in text.split("\n\n") if "HashAggregate" in part]
    assert aggregates and not any("from_json" in part for part in aggregates)


def test_partition_filter_prunes_the_archive(spark, stored_messages):
    config = ArchiveConfig(scratch_path(spark, "plan-archive"))
    archive.write_archive(archive_records(stored_messages, config), config)
    wanted = archive.read_archive(spark, config.path).where("date = current_date()")
    text = plan(wanted.select("g_force"))
    assert re.search(r"PartitionFilters: \[.*date", text)
    assert "ReadSchema: struct<g_force:double>" in text


def test_lookup_filters_reach_the_files(spark, stored_messages):
    path = scratch_path(spark, "plan-lookup")
    typed = tables.as_events_table(parse.typed_record(stored_messages))
    archive.write_lookup_files(typed, path)
    text = plan(spark.read.parquet(path).where("policy_id = 5 AND event_time > 10").select("vin"))
    assert "EqualTo(policy_id,5)" in text and "GreaterThan(event_time,10)" in text


def test_only_a_source_with_few_splits_is_spread(spark):
    cores = spark.sparkContext.defaultParallelism
    assert "Exchange" in plan(spread_small(spark.range(0, 100, 1, 1)))
    assert "Exchange" not in plan(spread_small(spark.range(0, 100, 1, cores)))


def test_ordered_rows_shuffle_once_more_whatever_the_sizes(spark):
    """One exchange of the rows; all joins are against the bounded edge table."""
    rows = spark.range(1000).select(F.col("id"), (F.col("id") % 5).alias("key"))
    data = ordered(rows, ("id",), ("key",))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(with_running(data, sums={"total": "id"}, previous="before").result())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in text and "ShuffledHashJoin" not in text
    main = text.split("BroadcastHashJoin")[0]
    assert main.count("Exchange") <= 1


@pytest.mark.parametrize("name", sorted(set(queries()) - {"stream_counters"}))
def test_queries_stay_in_the_jvm_without_cross_joins(name, spark, sf_dir):
    text = plan(queries()[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython"):
        assert operator not in text
