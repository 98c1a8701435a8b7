"""Monitoring queries over request, gauge and counter tables.

Time columns may be ``timestamp`` or ``timestamp_ntz``. Windows are tumbling;
the same functions run on streams once a watermark is set, except those that
order a series (rates of counters, alerts), which have a streaming counterpart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.buckets import cumulative_counts, quantile_from_counts
from tidemark.functions.missing import col
from tidemark.functions.quantiles import grouped_quantile
from tidemark.operators.ordered import ROWS_PER_CHUNK, Chunks, find_chunks, last_before
from tidemark.operators.scoring import cumulative_histogram

# Default upper bounds of a request duration histogram, seconds.
DURATION_BOUNDS = (
    0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0,
)


def _windowed(df: DataFrame, ts: str, minutes: int, by: Sequence[str], *aggregates: Column) -> DataFrame:
    w = F.window(col(ts), f"{minutes} minutes")
    grouped = df.groupBy(w.alias("w"), *[col(b) for b in by]).agg(*aggregates)
    return grouped.select(
        F.col("w.start").alias("window_start"), *by,
        *[c for c in grouped.columns if c != "w" and c not in by],
    )


def request_rate(df: DataFrame, ts: str, by: Sequence[str], minutes: int = 30) -> DataFrame:
    """Requests per second in each window and group."""
    return _windowed(
        df, ts, minutes, by, (F.count(F.lit(1)) / F.lit(minutes * 60.0)).alias("rate")
    )


def histogram_quantiles(
    df: DataFrame,
    ts: str,
    value: str,
    by: Sequence[str],
    quantiles: Sequence[float],
    bounds: Sequence[float] = DURATION_BOUNDS,
    minutes: int = 5,
) -> DataFrame:
    """Bucket-interpolated quantiles per window and group, columns ``p50``, ``p95``, ..."""
    counters = [c.alias(f"__b{i}") for i, c in enumerate(cumulative_counts(col(value), bounds))]
    wide = _windowed(df, ts, minutes, by, *counters, F.count(col(value)).alias("n"))
    counts = F.array(*[F.col(f"__b{i}") for i in range(len(bounds))])
    return wide.select(
        "window_start", *by, "n",
        *[
            quantile_from_counts(q, bounds, counts, F.col("n")).alias(f"p{q * 100:g}")
            for q in quantiles
        ],
    )


def exact_latency_quantile(df: DataFrame, value: str, by: Sequence[str], q: float, out: str) -> DataFrame:
    """Exact quantile per group."""
    return grouped_quantile(df, by, value, q, out)


def error_counts(df: DataFrame, by: Sequence[str], status: str, ok: str = "200") -> DataFrame:
    """Requests with a status other than ``ok``, per group and status."""
    keys = list(dict.fromkeys([*by, status]))
    return (
        df.where(col(status).cast("string") != ok)
        .groupBy(*[col(k) for k in keys])
        .agg(F.count(F.lit(1)).alias("n_errors"))
    )


def counter_increases(
    df: DataFrame, series: Sequence[str], ts: str, value: str, rows_per_chunk: int = ROWS_PER_CHUNK
) -> DataFrame:
    """One row per sample with ``increase`` since the previous one.

    A drop is a counter reset: the counter restarted from zero, so the new value
    is the increase. Samples of one series at one instant are merged first (the
    largest counts). The first sample of a series has no increase.
    """
    samples = df.groupBy(*[col(s) for s in series], col(ts)).agg(F.max(col(value)).alias(value))
    lagged = last_before(
        samples, {"__prev": col(value)}, by=series, order=[ts],
        chunks=find_chunks(df, series, ts, rows_per_chunk),
    )
    step = F.when(col(value) < F.col("__prev"), col(value)).otherwise(col(value) - F.col("__prev"))
    return lagged.withColumn("increase", step).drop("__prev")


def counter_rate(
    df: DataFrame, series: Sequence[str], ts: str, value: str, minutes: int = 5,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Increase per second of each series in each window."""
    steps = counter_increases(df, series, ts, value, rows_per_chunk)
    return _windowed(
        steps, ts, minutes, series,
        (F.coalesce(F.sum("increase"), F.lit(0.0)) / F.lit(minutes * 60.0)).alias("rate"),
    )


def busy_share(rates: DataFrame, instance: str) -> DataFrame:
    """1 - mean idle rate over the series of an instance, per window."""
    return rates.groupBy("window_start", instance).agg((1 - F.avg("rate")).alias("busy"))


def gauge_ratio(
    df: DataFrame, by: Sequence[str], available: str, total: str, keep: Column | None = None
) -> DataFrame:
    """Used share per group: 1 - available / total, over the rows that ``keep`` admits."""
    rows = df if keep is None else df.where(keep)
    grouped = rows.groupBy(*[col(b) for b in by]).agg(
        F.sum(col(available)).alias("__a"), F.sum(col(total)).alias("__t")
    )
    return grouped.select(
        *by, (1 - F.try_divide(F.col("__a"), F.col("__t"))).alias("used_ratio")
    )


def sustained_alerts(
    evaluations: DataFrame,
    series: Sequence[str],
    ts: str,
    condition: Column,
    hold_seconds: int | Column,
    chunks: Chunks | None = None,
    step_seconds: int | None = None,
) -> DataFrame:
    """Stretches during which the condition held without a break for the hold time.

    ``evaluations`` has one row per series and evaluation time. Each output row
    is one alert: ``active_since``, ``firing_at`` (first evaluation at least the
    hold time later), ``last_true_at`` and the number of true evaluations. With
    ``step_seconds``, the evaluation interval, a longer step between two rows is
    a gap and ends the stretch, as an evaluation without a sample does. The hold
    time may be a column of the series.
    Evaluations come from windows, so a series is as long as its time range; for
    longer ones pass ``find_chunks``.
    """
    flags = evaluations.select(
        *[col(s) for s in series], col(ts), F.coalesce(condition, F.lit(False)).alias("__on")
    )
    previous = last_before(
        flags, {"__was": F.col("__on"), "__before": col(ts)}, by=series, order=[ts], chunks=chunks
    )
    goes_on = F.coalesce("__was", F.lit(False))
    if step_seconds is not None:
        goes_on = goes_on & (seconds_between(F.col("__before"), col(ts)) <= step_seconds)
    starts = F.when(F.col("__on") & ~goes_on, col(ts))
    islands = last_before(
        previous, {"active_since": starts}, by=series, order=[ts], inclusive=True, chunks=chunks
    ).where(F.col("__on"))
    held = seconds_between(F.col("active_since"), col(ts)) >= hold_seconds
    return (
        islands.groupBy(*[col(s) for s in series], "active_since")
        .agg(
            F.min(F.when(held, col(ts))).alias("firing_at"),
            F.max(col(ts)).alias("last_true_at"),
            F.count(F.lit(1)).alias("n_evaluations"),
        )
        .where(F.col("firing_at").isNotNull())
    )


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from ``start`` to ``end`` for either timestamp type."""
    return F.timestamp_diff("SECOND", start, end)


def resample_last(
    df: DataFrame, series: Sequence[str], ts: str, value: str, step: str = "6 hours",
    tie: Sequence[str] = (),
) -> DataFrame:
    """Last present value of each series in every step that has one."""
    rows = df.where(col(value).isNotNull())
    # A bare timestamp keeps the aggregate a hash aggregate.
    position = F.struct(col(ts), *[col(t) for t in tie]) if tie else col(ts)
    grouped = rows.groupBy(F.window(col(ts), step).alias("w"), *[col(s) for s in series]).agg(
        F.max_by(col(value), position).alias(value)
    )
    return grouped.select(F.col("w.start").alias("window_start"), *series, value)


def daily_delta(
    df: DataFrame, series: Sequence[str], ts: str, value: str, tie: Sequence[str] = ()
) -> DataFrame:
    """Last value per day, days without values dropped, and the change to the day before.

    The window sees one row per series and day. The first day has no delta.
    """
    daily = resample_last(df, series, ts, value, "1 day", tie)
    w = Window.partitionBy(*[col(s) for s in series]).orderBy("window_start")
    return daily.select(
        F.col("window_start").alias("day"), *series, value,
        (col(value) - F.lag(col(value)).over(w)).alias("delta"),
    )


def duration_histogram(
    df: DataFrame, value: str, by: Sequence[str], bounds: Sequence[float] = DURATION_BOUNDS
) -> DataFrame:
    """Cumulative duration histogram per label combination."""
    return cumulative_histogram(df, value, bounds, by)
