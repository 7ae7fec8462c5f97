from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadpulse.operators import metrics


@pytest.fixture(scope="module")
def durations(spark):
    generator = np.random.default_rng(7)
    values = generator.exponential(20.0, 3000).round(1).tolist()
    rows = [(i, "hot" if i % 3 else f"g{i % 5}", value) for i, value in enumerate(values)]
    rows += [(3000, "single", 4.5), (3001, "hot", None), (3002, "empty", None)]
    return rows, spark.createDataFrame(rows, "id bigint, g string, value double").repartition(4)


@pytest.mark.parametrize("slices", [1, 16])
def test_exact_quantiles_equal_numpy(durations, slices):
    rows, frame = durations
    found = metrics.exact_quantiles(frame, "value", (0.5, 0.95, 0.99), ("g",), slices)
    for row in found.collect():
        values = [value for _, g, value in rows if g == row.g and value is not None]
        expected = np.quantile(values, [0.5, 0.95, 0.99])
        assert [row.p50, row.p95, row.p99] == pytest.approx(list(expected), rel=1e-12)
    assert "empty" not in {row.g for row in found.collect()}


def test_approximate_quantiles_are_near(durations):
    rows, frame = durations
    found = metrics.approximate_quantiles(frame, "value", (0.5,), ("g",), 1000).collect()
    middle = {row.g: row.p50 for row in found}
    values = [value for _, g, value in rows if g == "hot" and value is not None]
    assert middle["hot"] == pytest.approx(np.quantile(values, 0.5), rel=0.05)


def test_histogram_quantile_rules(spark):
    frame = spark.createDataFrame([(v,) for v in (0.5, 1.5, 1.6, 3.0, 99.0)], "v double")
    bounds = (1.0, 2.0, 4.0)
    rows = metrics.cumulative_buckets(frame, "v", bounds, ()).collect()
    assert [(row.le, row.cumulative) for row in rows] == [
        ("1.0", 1), ("2.0", 3), ("4.0", 4), ("+Inf", 5),
    ]
    row = metrics.histogram_quantiles(frame, "v", bounds, (0.1, 0.4, 0.6, 0.99), ()).first()
    assert (row.p10, row.p40, row.p60, row.p99) == pytest.approx((0.5, 1.5, 2.0, 4.0))


def test_sliding_rate_equals_counting_each_window(spark):
    seconds = [0, 30, 61, 150, 299, 300, 610]
    frame = spark.createDataFrame([(s,) for s in seconds], "s bigint").select(
        F.timestamp_seconds("s").alias("ts")
    )
    found = {
        int(row.at): row.events
        for row in metrics.sliding_rate(frame, "ts")
        .select(F.unix_seconds("window_start").alias("at"), "events")
        .collect()
    }
    expected = {}
    for start in range(-300, 660, 60):
        n = sum(start <= s < start + 300 for s in seconds)
        if n:
            expected[start] = n
    assert found == expected
    with pytest.raises(ValueError):
        metrics.sliding_rate(frame, "ts", seconds=300, step_seconds=70)


def test_metric_rows_carry_their_tags(spark):
    counters = spark.createDataFrame([("t", 3, 1)], "table string, total bigint, failed bigint")
    rows = metrics.metric_rows(counters, ("table",), "loader", F.current_timestamp()).collect()
    assert {row.name: row.value for row in rows} == {"loader_total": 3.0, "loader_failed": 1.0}
    assert all(row.tags == {"table": "t"} for row in rows)
