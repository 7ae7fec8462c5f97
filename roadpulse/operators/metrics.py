"""Pipeline counters, rates, ratios and latency figures as DataFrame aggregates.

Everything here aggregates map-side before its only shuffle, so a hot key or time bucket
reaches the shuffle as one partial row per task. The exact percentile is the exception: it needs
order, and goes through the sliced order of ``ordered``.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.config import DEFAULT_THRESHOLD, RATE_WINDOW_SECONDS
from roadpulse.operators.detect import detected
from roadpulse.operators.ordered import ordered, with_running
from roadpulse.operators.parse import with_validity


def _count() -> Column:
    return F.count(F.lit(1))


def detector_counters(
    messages: DataFrame, threshold: float = DEFAULT_THRESHOLD, value: str = "value", by: tuple = ()
) -> DataFrame:
    """Messages seen, accidents among them, and messages that do not parse."""
    return detected(messages, threshold, value).groupBy(*by).agg(*detector_aggregates())


def detector_aggregates() -> list[Column]:
    return [
        _count().alias("messages_total"),
        F.count_if("is_accident").alias("accidents_total"),
        F.count_if(~F.col("is_valid")).alias("invalid_total"),
    ]


def archive_counters(messages: DataFrame, value: str = "value", by: tuple = ()) -> DataFrame:
    """Messages the archive received, wrote and set aside as unparsable."""
    marked = with_validity(messages, "archive", value)
    return marked.groupBy(*by).agg(
        _count().alias("received"),
        F.count_if("is_valid").alias("written"),
        F.count_if(~F.col("is_valid")).alias("quarantined"),
    )


def outcome_counters(
    rows: DataFrame, failed: Column, by: tuple[str, ...] = ("table_name",)
) -> DataFrame:
    """Loader counters per table: total, successes and failures."""
    return rows.groupBy(*by).agg(
        _count().alias("messages_total"),
        F.count_if(~failed).alias("messages_success"),
        F.count_if(failed).alias("messages_error"),
    )


def error_counts(
    rows: DataFrame, error_class: str, by: tuple[str, ...] = ("table_name",)
) -> DataFrame:
    """Failures per table and error class; rows without an error class did not fail."""
    return (
        rows.where(F.col(error_class).isNotNull())
        .groupBy(*by, error_class)
        .agg(_count().alias("errors"))
    )


def duration_summary(rows: DataFrame, duration: str, by: tuple[str, ...]) -> DataFrame:
    return rows.groupBy(*by).agg(
        F.count(duration).alias("timed"),
        F.sum(duration).alias("total_duration"),
        F.max(duration).alias("max_duration"),
    )


def _windowed(rows: DataFrame, ts: str, seconds: int, by: tuple[str, ...], *totals: Column):
    """Aggregates per time window, under ``window_start``.

    Grouping by the window itself, not by its start, lets a stream's watermark close it.
    """
    grouped = rows.groupBy(F.window(F.col(ts), f"{seconds} seconds").alias("_window"), *by)
    start = F.col("_window").getField("start").alias("window_start")
    return grouped.agg(*totals).select("*", start).drop("_window")


def rate(
    rows: DataFrame,
    ts: str,
    by: tuple[str, ...] = (),
    seconds: int = RATE_WINDOW_SECONDS,
    when: Column | None = None,
) -> DataFrame:
    """Rows (or rows for which ``when`` holds) per second in each time window."""
    n = _count() if when is None else F.count_if(when)
    return (
        _windowed(rows, ts, seconds, by, n.alias("events"))
        .withColumn("rate", F.col("events") / F.lit(float(seconds)))
    )


def total_rate(
    rows: DataFrame,
    ts: str,
    amount: str,
    by: tuple[str, ...] = (),
    seconds: int = RATE_WINDOW_SECONDS,
) -> DataFrame:
    """The per-second increase of a counter to which every row adds its amount."""
    return (
        _windowed(rows, ts, seconds, by, F.sum(amount).alias("increase"))
        .withColumn("rate", F.col("increase") / F.lit(float(seconds)))
    )


def sliding_rate(
    rows: DataFrame,
    ts: str,
    by: tuple[str, ...] = (),
    seconds: int = RATE_WINDOW_SECONDS,
    step_seconds: int = 60,
) -> DataFrame:
    """The rate over windows that start every step.

    Rows are counted per step first; only those counts are copied into the windows that
    cover them, so the rows themselves are never multiplied.
    """
    if seconds % step_seconds:
        raise ValueError("the window must be a whole number of steps")
    per_step = _windowed(rows, ts, step_seconds, by, _count().alias("_events"))
    covering = F.explode(
        F.array(
            *[
                F.col("window_start") - F.expr(f"INTERVAL {back * step_seconds} SECONDS")
                for back in range(seconds // step_seconds)
            ]
        )
    )
    return (
        per_step.select(covering.alias("window_start"), *by, "_events")
        .groupBy("window_start", *by)
        .agg(F.sum("_events").alias("events"))
        .withColumn("rate", F.col("events") / F.lit(float(seconds)))
    )


def share_pct(
    rows: DataFrame,
    ts: str,
    condition: Column,
    name: str,
    by: tuple[str, ...] = (),
    seconds: int = RATE_WINDOW_SECONDS,
) -> DataFrame:
    """Percentage of a window's rows for which the condition holds."""
    return (
        _windowed(
            rows,
            ts,
            seconds,
            by,
            _count().alias("total"),
            F.count_if(condition).alias("matching"),
        )
        .withColumn(name, F.lit(100.0) * F.col("matching") / F.col("total"))
    )


def cumulative_buckets(
    rows: DataFrame, duration: str, bounds: tuple[float, ...], by: tuple[str, ...]
) -> DataFrame:
    """Rows at or below each bound, one row per group and bound; the last bound is +Inf."""
    totals = rows.groupBy(*by).agg(*_bucket_counts(duration, bounds))
    pairs = F.array(
        *[
            F.struct(F.lit(_label(bound)).alias("le"), F.col(f"_le_{i}").alias("cumulative"))
            for i, bound in enumerate((*bounds, math.inf))
        ]
    )
    return totals.select(*by, F.inline(pairs))


def _label(bound: float) -> str:
    return "+Inf" if math.isinf(bound) else str(float(bound))


def _bucket_counts(duration: str, bounds: tuple[float, ...]) -> list[Column]:
    limited = [
        F.count_if(F.col(duration) <= F.lit(float(bound))).alias(f"_le_{i}")
        for i, bound in enumerate(bounds)
    ]
    return [*limited, F.count(duration).alias(f"_le_{len(bounds)}")]


def histogram_quantiles(
    rows: DataFrame,
    duration: str,
    bounds: tuple[float, ...],
    quantiles: tuple[float, ...],
    by: tuple[str, ...],
) -> DataFrame:
    """Quantiles read off cumulative buckets, linear inside the bucket that holds the rank.

    A rank in the +Inf bucket gives the highest finite bound.
    """
    totals = rows.groupBy(*by).agg(*_bucket_counts(duration, bounds))
    return totals.select(
        *by, *[_bucket_quantile(q, bounds).alias(quantile_name(q)) for q in quantiles]
    )


def _bucket_quantile(q: float, bounds: tuple[float, ...]) -> Column:
    rank = F.lit(q) * F.col(f"_le_{len(bounds)}")
    result = F
    for i, bound in enumerate(bounds):
        below = F.lit(0) if i == 0 else F.col(f"_le_{i - 1}")
        low = min(bound, 0.0) if i == 0 else bounds[i - 1]
        inside = F.try_divide(rank - below, F.col(f"_le_{i}") - below)
        value = F.lit(float(low)) + F.lit(float(bound - low)) * F.coalesce(inside, F.lit(0.0))
        result = result.when(F.col(f"_le_{i}") >= rank, value)
    return result.otherwise(F.lit(float(bounds[-1])))


def quantile_name(q: float) -> str:
    return "p" + f"{q * 100:g}".replace(".", "_")


def exact_quantiles(
    rows: DataFrame,
    duration: str,
    quantiles: tuple[float, ...],
    by: tuple[str, ...],
    slices: int | None = None,
) -> DataFrame:
    """Exact quantiles, linear between the two neighbouring ranks.

    Equal durations are counted together first. The distinct ones are put in order across
    slices, and only those at the wanted ranks go on to the final aggregate, at most two per
    quantile and group.
    """
    counted = (
        rows.where(F.col(duration).isNotNull()).groupBy(*by, duration).agg(_count().alias("_n"))
    )
    data = ordered(counted, (duration,), by, slices)
    ranked = with_running(data, sums={"_upto": "_n"}, totals={"_all": "_n"}).result()

    def holds(rank: Column) -> Column:
        return (F.col("_upto") >= rank) & (F.col("_upto") - F.col("_n") < rank)

    places = [(F.col("_all") - F.lit(1)) * F.lit(q) for q in quantiles]
    lows = [F.floor(place) + F.lit(1) for place in places]
    highs = [F.ceil(place) + F.lit(1) for place in places]
    wanted = reduce(or_, [holds(rank) for rank in (*lows, *highs)])
    picks = []
    for i, (place, low, high) in enumerate(zip(places, lows, highs)):
        picks += [
            F.max(F.when(holds(low), F.col(duration))).alias(f"_low_{i}"),
            F.max(F.when(holds(high), F.col(duration))).alias(f"_high_{i}"),
            F.max(place - F.floor(place)).alias(f"_part_{i}"),
        ]
    found = ranked.where(wanted).groupBy(*by).agg(*picks)
    values = []
    for i, q in enumerate(quantiles):
        low, high, part = F.col(f"_low_{i}"), F.col(f"_high_{i}"), F.col(f"_part_{i}")
        values.append((low * (F.lit(1.0) - part) + high * part).alias(quantile_name(q)))
    return found.select(*by, *values)


def approximate_quantiles(
    rows: DataFrame,
    duration: str,
    quantiles: tuple[float, ...],
    by: tuple[str, ...],
    accuracy: int = 10000,
) -> DataFrame:
    """Quantiles from a mergeable summary: no ordering, rank error at most 1/accuracy."""
    summary = F.percentile_approx(duration, list(quantiles), accuracy)
    return (
        rows.groupBy(*by)
        .agg(summary.alias("_q"))
        .select(*by, *[F.col("_q")[i].alias(quantile_name(q)) for i, q in enumerate(quantiles)])
    )


#: Leading bits that a duration's bucket keeps: its values differ by less than one part in 128.
SKETCH_BITS = 7


def _shift(value: Column, bits: int) -> Column:
    return F.greatest(F.length(F.bin(value)) - F.lit(bits + 1), F.lit(0))


def sketch_bucket(duration: Column, bits: int = SKETCH_BITS) -> Column:
    """The least whole number that shares the leading ``bits`` + 1 binary digits of a duration.

    Whole-number arithmetic only, so every engine and every order of merging gives the same bucket. A
    duration below zero counts as zero.
    """
    value = F.greatest(duration.cast("bigint"), F.lit(0).cast("bigint"))
    shift = _shift(value, bits)
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def duration_sketch(
    rows: DataFrame, ts: str, duration: str, by: tuple[str, ...], seconds: int, bits: int = SKETCH_BITS
) -> DataFrame:
    """Durations (whole numbers) per window and group as counts of their buckets.

    A group has at most (65 - bits) * 2^bits buckets whatever the rows, and sketches merge by adding the
    counts of equal buckets (``merged_sketch``). Rows without a time or duration are left out.
    """
    timed = rows.where(F.col(duration).isNotNull()).withColumn("bucket", sketch_bucket(F.col(duration), bits))
    return _windowed(timed, ts, seconds, (*by, "bucket"), _count().alias("n"))


def merged_sketch(sketch: DataFrame, by: tuple[str, ...], seconds: int) -> DataFrame:
    """Sketches of the same or shorter windows as one per window of ``seconds`` and group."""
    return _windowed(sketch, "window_start", seconds, (*by, "bucket"), F.sum("n").alias("n"))


def sketch_quantiles(
    sketch: DataFrame, quantiles: tuple[float, ...], by: tuple[str, ...], bits: int = SKETCH_BITS
) -> DataFrame:
    """Quantiles of each window and group of a merged sketch, and how many durations it holds.

    A quantile is the middle of the bucket that holds the duration of rank ceil(q * n), so it is off
    by less than one part in 2^(bits + 1) of that duration. The running sum goes over the buckets of one
    group, whose number is bounded.
    """
    group = Window.partitionBy("window_start", *by)
    upto = F.sum("n").over(group.orderBy("bucket"))
    ranked = sketch.select("*", upto.alias("_upto"), F.sum("n").over(group).alias("_all"))
    width = F.call_function("shiftleft", F.lit(1).cast("bigint"), _shift(F.col("bucket"), bits))
    middle = F.col("bucket") + (width - F.lit(1)) / F.lit(2.0)
    found = ranked.groupBy("window_start", *by).agg(
        F.max("_all").alias("n"),
        *[
            F.min(F.when(F.col("_upto") >= F.ceil(F.lit(q) * F.col("_all")), middle)).alias(quantile_name(q))
            for q in quantiles
        ],
    )
    return found


def metric_rows(counters: DataFrame, tags: tuple[str, ...], prefix: str, at: Column) -> DataFrame:
    """Counter columns as one time-series row each: ts, name, tags, value."""
    names = [name for name in counters.columns if name not in tags]
    pairs = F.array(
        *[
            F.struct(
                F.lit(f"{prefix}_{name}").alias("name"), F.col(name).cast("double").alias("value")
            )
            for name in names
        ]
    )
    tag_map = (
        F.create_map(*[part for tag in tags for part in (F.lit(tag), F.col(tag).cast("string"))])
        if tags
        else F.create_map().cast("map<string,string>")
    )
    return counters.select(at.alias("ts"), tag_map.alias("tags"), F.inline(pairs))
