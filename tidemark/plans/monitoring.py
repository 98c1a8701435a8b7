"""Monitoring queries on the event table (an event type is an endpoint, a user a series)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.buckets import cumulative_counts, quantile_from_counts
from tidemark.operators import monitor
from tidemark.operators.alert_rules import AlertRule, alerts_by_rule as alerts_of_rules
from tidemark.plans import query, table
from tidemark.streaming.events import signal_windows

BOUNDS = (1.0, 2.5, 5.0, 10.0, 25.0, 50.0, 75.0, 100.0)
CONFIDENCE = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def _start(minutes: int) -> str:
    return f"time_bucket(INTERVAL {minutes} MINUTE, ts, TIMESTAMP '1970-01-01')"


@query(
    f"SELECT {_start(30)} AS window_start, event_type, round(count(*) / 1800.0::DOUBLE, 9) AS rate "
    "FROM events GROUP BY ALL"
)
def rate_per_endpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = monitor.request_rate(_events(spark, sf_dir), "ts", ["event_type"], 30)
    return rates.withColumn("rate", F.round("rate", 9))


def _quantile_sql(q: float, bounds: tuple[float, ...], name: str) -> str:
    """Bucket interpolation spelled out, from counts b0, b1, ... and n."""
    rank = f"({q}::DOUBLE * n)"
    cases = []
    for i, upper in enumerate(bounds):
        lower = bounds[i - 1] if i else 0.0
        below = f"b{i - 1}" if i else "0"
        cases.append(
            f"WHEN b{i} >= {rank} THEN {lower}::DOUBLE + ({upper}::DOUBLE - {lower}::DOUBLE) * "
            f"({rank} - {below}) / NULLIF(b{i} - {below}, 0)"
        )
    return f"round(CASE {' '.join(cases)} ELSE {bounds[-1]}::DOUBLE END, 6) AS {name}"


def _bucket_sql(value: str, bounds: tuple[float, ...]) -> str:
    return ", ".join(f"count(*) FILTER ({value} <= {b}::DOUBLE) AS b{i}" for i, b in enumerate(bounds))


@query(
    f"WITH h AS (SELECT {_start(60)} AS window_start, event_type, {_bucket_sql('value', BOUNDS)}, "
    f"count(*) AS n FROM events GROUP BY ALL) "
    f"SELECT window_start, event_type, n, {_quantile_sql(0.95, BOUNDS, 'p95')} FROM h"
)
def histogram_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = monitor.histogram_quantiles(
        _events(spark, sf_dir), "ts", "value", ["event_type"], [0.95], BOUNDS, minutes=60
    )
    return found.withColumn("p95", F.round("p95", 6))


@query("SELECT event_type, round(quantile_cont(value, 0.95), 6) AS p95 FROM events GROUP BY 1")
def latency_p95(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = monitor.exact_latency_quantile(_events(spark, sf_dir), "value", ["event_type"], 0.95, "p95")
    return found.select("event_type", F.round("p95", 6).alias("p95"))


_STATUS = "CASE WHEN value > 100 THEN '500' WHEN value > 50 THEN '404' ELSE '200' END"


@query(
    f"SELECT event_type, {_STATUS} AS status_code, count(*) AS n_errors FROM events "
    f"WHERE {_STATUS} <> '200' GROUP BY ALL"
)
def error_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = _events(spark, sf_dir).withColumn("status_code", F.expr(_STATUS))
    return monitor.error_counts(requests, ["event_type"], "status_code")


@query(
    f"WITH h AS (SELECT {_start(1440)} AS window_start, {_bucket_sql('c', CONFIDENCE)}, count(*) AS n "
    "FROM (SELECT ts, 1.0::DOUBLE / (1.0::DOUBLE + value / 20.0::DOUBLE) AS c FROM events) GROUP BY ALL) "
    f"SELECT window_start, n, {_quantile_sql(0.5, CONFIDENCE, 'p50')}, "
    f"{_quantile_sql(0.9, CONFIDENCE, 'p90')}, {_quantile_sql(0.99, CONFIDENCE, 'p99')} FROM h"
)
def confidence_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _events(spark, sf_dir).select("ts", (1.0 / (1.0 + F.col("value") / 20.0)).alias("c"))
    found = monitor.histogram_quantiles(scored, "ts", "c", [], [0.5, 0.9, 0.99], CONFIDENCE, minutes=1440)
    return found.withColumns({c: F.round(c, 6) for c in ("p50", "p90", "p99")})


@query(
    f"""WITH samples AS (SELECT user_id, ts, max(value) AS value FROM events GROUP BY ALL),
    steps AS (SELECT user_id, ts, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM samples)
    SELECT {_start(360)} AS window_start, user_id,
           round(coalesce(sum(CASE WHEN value < prev THEN value ELSE value - prev END), 0) / 21600.0::DOUBLE, 8)
             AS rate
    FROM steps GROUP BY ALL"""
)
def counter_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event values of a user read as a counter that resets on every drop."""
    rates = monitor.counter_rate(_events(spark, sf_dir), ["user_id"], "ts", "value", minutes=360)
    return rates.withColumn("rate", F.round("rate", 8))


@query(
    """SELECT l_returnflag, l_linestatus,
       round(1 - sum(l_quantity * (1 - l_discount)) / sum(l_quantity), 6) AS used_ratio
    FROM lineitem WHERE NOT regexp_full_match(l_linestatus, 'X|F') GROUP BY ALL"""
)
def gauge_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    gauges = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_quantity",
        (F.col("l_quantity") * (1 - F.col("l_discount"))).alias("available"),
    )
    ratios = monitor.gauge_ratio(
        gauges, ["l_returnflag", "l_linestatus"], "available", "l_quantity",
        keep=~F.col("l_linestatus").rlike(r"\A(?:X|F)\z"),
    )
    return ratios.withColumn("used_ratio", F.round("used_ratio", 6))


# Hours with a mean above 20 and the start of their stretch; an hour that is not hot or has no events ends it.
STRETCHES = f"""evals AS (SELECT event_type, {_start(60)} AS seen, avg(value) > 20 AS hot FROM events GROUP BY ALL),
    hot_hours AS (SELECT event_type, seen, seen - INTERVAL 1 HOUR * row_number() OVER (
                    PARTITION BY event_type ORDER BY seen) AS island FROM evals WHERE hot),
    stretches AS (SELECT *, min(seen) OVER (PARTITION BY event_type, island) AS since FROM hot_hours)"""


@query(
    f"""WITH {STRETCHES}
    SELECT event_type, since AS active_since,
           min(CASE WHEN seen >= since + INTERVAL 2 HOUR THEN seen END) AS firing_at,
           max(seen) AS last_true_at, count(*) AS n_evaluations
    FROM stretches GROUP BY event_type, since HAVING max(seen) >= since + INTERVAL 2 HOUR"""
)
def alert_sustained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly mean of an endpoint stays above 20 for at least two hours; an hour without events ends it."""
    hourly = (
        _events(spark, sf_dir).groupBy(F.window("ts", "1 hour").alias("w"), "event_type")
        .agg(F.avg("value").alias("mean")).select("event_type", F.col("w.start").alias("seen"), "mean")
    )
    return monitor.sustained_alerts(hourly, ["event_type"], "seen", F.col("mean") > 20, 7200, step_seconds=3600)


@query(
    f"""SELECT window_start, event_type, value FROM (
      SELECT {_start(360)} AS window_start, event_type, value,
             row_number() OVER (PARTITION BY {_start(360)}, event_type ORDER BY ts DESC, event_id DESC) AS rn
      FROM events) WHERE rn = 1"""
)
def resample_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.resample_last(_events(spark, sf_dir), ["event_type"], "ts", "value", "6 hours", ["event_id"])


@query(
    """WITH daily AS (SELECT day, event_type, value FROM (
      SELECT date_trunc('day', ts)::TIMESTAMP AS day, event_type, value,
             row_number() OVER (PARTITION BY date_trunc('day', ts), event_type ORDER BY ts DESC, event_id DESC) AS rn
      FROM events) WHERE rn = 1)
    SELECT day, event_type, value,
           round(value - lag(value) OVER (PARTITION BY event_type ORDER BY day), 6) AS delta FROM daily"""
)
def daily_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = monitor.daily_delta(_events(spark, sf_dir), ["event_type"], "ts", "value", ["event_id"])
    return found.withColumn("delta", F.round("delta", 6))


@query(
    " UNION ALL ".join(
        f"SELECT event_type, '{b}' AS le, count(*) FILTER (value <= {b}::DOUBLE) AS n_cumulative "
        "FROM events GROUP BY event_type"
        for b in BOUNDS
    )
    + " UNION ALL SELECT event_type, '+Inf', count(*) FROM events GROUP BY event_type"
)
def duration_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.duration_histogram(_events(spark, sf_dir), "value", ["event_type"], BOUNDS)


# The eight shipped rules with the limits of these tables: an event type is a job, an hour an evaluation.
EVENT_RULES = (
    AlertRule("GatewayApiDown", "click", "up", None, 7200, "critical"),
    AlertRule("InferenceApiDown", "view", "up", None, 5400, "critical"),
    AlertRule("NginxExporterDown", "signup", "up", None, 14400, "high"),
    AlertRule("HighPredictionLatency", "view", "latency_p95", 80.0, 7200, "warning"),
    AlertRule("AbnormalRequestRate", "view", "request_rate", 2.0 / 3600, 3600, "warning"),
    AlertRule("PrometheusScrapeFailed", "error", "up", None, 3600, "critical"),
    AlertRule("HighCpuUsage", "purchase", "cpu_busy", 0.6, 5400, "warning"),
    AlertRule("HighMemoryUsage", "purchase", "memory_used", 0.5, 3600, "warning"),
)


def event_signals(events: DataFrame) -> DataFrame:
    """The rules' signals per event type and hour; works on streams (a filter here would reach the rows before the watermark does)."""
    counts = [c.alias(f"b{i}") for i, c in enumerate(cumulative_counts(F.col("value"), BOUNDS))]
    seen = signal_windows(events, ["event_type"], "ts", "1 hour", [
        *counts, F.count("*").alias("n"), F.count_if(F.col("value") > 100).alias("up"),
        F.count_if(F.col("value") <= 20).alias("idle"), F.avg("value").alias("mean")])
    share = quantile_from_counts(0.95, BOUNDS, F.array(*[F.col(f"b{i}") for i in range(len(BOUNDS))]), F.col("n"))
    return seen.select(
        "event_type", "evaluated_at", "closed_at", "up", share.alias("latency_p95"), (F.col("n") / 3600.0).alias("request_rate"),
        (1 - F.col("idle") / F.col("n")).alias("cpu_busy"), (F.col("mean") / 100.0).alias("memory_used"))


def _rules_sql() -> str:
    rows = ", ".join(
        f"('{r.name}', '{r.severity}', '{r.target}', '{r.signal}', {'NULL' if r.above is None else repr(r.above)}::DOUBLE, {r.hold_seconds})"
        for r in EVENT_RULES)
    return f"rules(rule, severity, event_type, signal, above, hold) AS (VALUES {rows})"


ALERTS_BY_RULE = f"""WITH {_rules_sql()},
h AS (SELECT event_type, {_start(60)} AS seen, {_bucket_sql('value', BOUNDS)}, count(*) AS n, count(*) FILTER (value > 100) AS up,
        count(*) FILTER (value <= 20) AS idle, avg(value) AS mean FROM events WHERE event_type IS NOT NULL GROUP BY ALL),
signals AS (SELECT event_type, seen, up, {_quantile_sql(0.95, BOUNDS, 'latency_p95')}, n / 3600.0::DOUBLE AS request_rate,
        1 - idle / n::DOUBLE AS cpu_busy, mean / 100.0::DOUBLE AS memory_used FROM h),
grid AS (SELECT event_type, unnest(generate_series(min(seen), (SELECT max(seen) FROM h), INTERVAL 1 HOUR)) AS seen FROM h GROUP BY 1),
flags AS (
  SELECT rule, severity, hold, g.event_type, g.seen, CASE
      WHEN above IS NULL THEN coalesce(s.up, 0) = 0
      WHEN signal = 'latency_p95' THEN s.latency_p95 > above WHEN signal = 'request_rate' THEN s.request_rate > above
      WHEN signal = 'cpu_busy' THEN s.cpu_busy > above ELSE s.memory_used > above END AS is_on
  FROM grid g JOIN rules USING (event_type) LEFT JOIN signals s ON s.event_type = g.event_type AND s.seen = g.seen),
islands AS (SELECT *, seen - INTERVAL 1 HOUR * row_number() OVER (PARTITION BY rule ORDER BY seen) AS island FROM flags WHERE is_on),
stretches AS (SELECT *, min(seen) OVER (PARTITION BY rule, island) AS since FROM islands)
SELECT rule, severity, event_type, since AS active_since,
       min(seen) FILTER (epoch(seen) >= epoch(since) + hold) AS firing_at FROM stretches
GROUP BY rule, severity, event_type, since HAVING max(epoch(seen)) >= epoch(min(since)) + max(hold)"""


@query(ALERTS_BY_RULE)
def alerts_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All eight rules over the event table: four targets that fall silent, four limits."""
    found = alerts_of_rules(event_signals(_events(spark, sf_dir)), EVENT_RULES, "event_type", "evaluated_at", 3600)
    return found.select("rule", "severity", "event_type", "active_since", "firing_at")


@query(
    f"""WITH r AS (SELECT {_start(360)} AS window_start, event_type, user_id % 4 AS cpu, count(*) FILTER (value <= 20) / 21600.0::DOUBLE AS rate
    FROM events GROUP BY ALL)
    SELECT window_start, event_type, round(1 - avg(rate), 8) AS busy FROM r GROUP BY ALL"""
)
def busy_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of busy time per instance and window: one less the mean idle rate of its processors."""
    idle = _events(spark, sf_dir).groupBy(
        F.window("ts", "6 hours").alias("w"), "event_type", (F.col("user_id") % 4).alias("cpu")).agg(
        (F.count_if(F.col("value") <= 20) / 21600.0).alias("rate"))
    found = monitor.busy_share(idle.select(F.col("w.start").alias("window_start"), "event_type", "rate"), "event_type")
    return found.withColumn("busy", F.round("busy", 8))
