"""Alert rules as data, over windowed signals of many targets: thresholds that are crossed, and targets that fall silent."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.missing import col
from tidemark.operators.monitor import seconds_between, sustained_alerts
from tidemark.operators.ordered import Chunks

# What a rule adds to the series of its alerts.
RULE_COLUMNS = ("rule", "severity", "hold_seconds")


@dataclass(frozen=True)
class AlertRule:
    """A signal of a target that stays above a limit; without a limit: that stays away or at zero."""

    name: str
    target: str
    signal: str
    above: float | None
    hold_seconds: int
    severity: str

    @property
    def on_silence(self) -> bool:
        return self.above is None


# The rules as shipped.
RULES = (
    AlertRule("GatewayApiDown", "gateway-api", "up", None, 60, "critical"),
    AlertRule("InferenceApiDown", "inference-api", "up", None, 60, "critical"),
    AlertRule("NginxExporterDown", "nginx-exporter", "up", None, 120, "high"),
    AlertRule("HighPredictionLatency", "inference-api", "latency_p95", 5.0, 120, "warning"),
    AlertRule("AbnormalRequestRate", "inference-api", "request_rate", 1000.0, 120, "warning"),
    AlertRule("PrometheusScrapeFailed", "prometheus", "up", None, 60, "critical"),
    AlertRule("HighCpuUsage", "node-exporter", "cpu_busy", 0.9, 300, "warning"),
    AlertRule("HighMemoryUsage", "node-exporter", "memory_used", 0.8, 300, "warning"),
)


def rule_flags(evaluations: DataFrame, rules: Sequence[AlertRule], target: str, keep: Sequence[str]) -> DataFrame:
    """One row per evaluation and rule of its target, with ``on_silence`` and ``is_on``; works on streams.

    ``evaluations`` has a row per series and closed window with the signals as
    columns; a missing signal crosses no limit and counts as silence. All rules
    are answered from one pass over the rows.
    """
    cases = []
    for rule in rules:
        signal = F.nanvl(col(rule.signal).cast("double"), F.lit(None).cast("double"))
        crossed = F.coalesce(signal, F.lit(0.0)) == 0 if rule.on_silence else signal > F.lit(float(rule.above))
        cases.append(F.when(col(target) == rule.target, F.struct(
            F.lit(rule.name).alias("rule"), F.lit(rule.severity).alias("severity"), F.lit(rule.hold_seconds).alias("hold_seconds"),
            F.lit(rule.on_silence).alias("on_silence"), F.coalesce(crossed, F.lit(False)).alias("is_on"))))
    return evaluations.select(*[col(c) for c in (target, *keep)], F.explode(F.array_compact(F.array(*cases))).alias("__rule")).select(
        *[col(c) for c in (target, *keep)], "__rule.*")


def silent_stretches(flags: DataFrame, series: Sequence[str], ts: str, step_seconds: int, until: Any) -> DataFrame:
    """Alerts of series without a good evaluation: absent or bad ones alike, from the series' first row to ``until``, the last step of all.

    ``flags`` has ``is_on`` for bad evaluations. The grid of evaluation times is
    dense, but no row is made for a silent step: a stretch lies between two
    neighbouring good evaluations, so its length and its alert follow from them.
    """
    keys = [col(s) for s in series]
    step = F.make_interval(secs=F.lit(step_seconds))
    end = F.lit(until).cast(flags.schema[ts].dataType) + step
    # Where each series begins and all end: just outside the grid, as if good there.
    edges = flags.groupBy(*keys).agg(F.min(col(ts)).alias("__first")).select(
        *keys, F.explode(F.array(F.col("__first") - step, end)).alias(ts))
    good = flags.where(~F.col("is_on")).select(*keys, col(ts)).unionByName(edges).distinct()
    before = F.lag(col(ts)).over(Window.partitionBy(*keys).orderBy(col(ts)))
    gaps = good.withColumn("__before", before).where(seconds_between(F.col("__before"), col(ts)) > step_seconds)
    # The first evaluation of the grid that is at least the hold time later.
    wait = F.ceil(F.col("hold_seconds") / step_seconds).cast("int") * step_seconds
    found = gaps.select(
        *keys, (F.col("__before") + step).alias("active_since"),
        (F.col("__before") + step + F.make_interval(secs=wait)).alias("firing_at"),
        (col(ts) - step).alias("last_true_at"),
        (F.floor(seconds_between(F.col("__before"), col(ts)) / step_seconds) - 1).alias("n_evaluations"))
    return found.where(F.col("firing_at") <= F.col("last_true_at"))


def alerts_by_rule(
    evaluations: DataFrame,
    rules: Sequence[AlertRule],
    target: str,
    ts: str,
    step_seconds: int,
    series: Sequence[str] = (),
    chunks: Chunks | None = None,
) -> DataFrame:
    """``(target, series..., rule, severity, active_since, firing_at, last_true_at, n_evaluations)`` of all alerts.

    A threshold rule's stretch ends at a step without a row; a silence rule's
    stretch goes on there. Each rule has its own hold time.
    """
    flags = rule_flags(evaluations, rules, target, [*series, ts])
    by = [target, *series, *RULE_COLUMNS]
    crossed = sustained_alerts(
        flags.where(~F.col("on_silence")), by, ts, F.col("is_on"), F.col("hold_seconds"), chunks, step_seconds)
    until = evaluations.agg(F.max(col(ts))).first()[0]
    silent = silent_stretches(flags.where("on_silence"), by, ts, step_seconds, until)
    return crossed.unionByName(silent).drop("hold_seconds")
