"""Windowed monitoring on streams, and alerts with per-series state.

``monitor.request_rate``, ``histogram_quantiles``, ``resample_last`` and
``scoring.predictions_by_category`` take streaming frames as they are once the
event time carries a watermark.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import TimerValues

from tidemark.functions.missing import col
from tidemark.operators.alert_rules import RULE_COLUMNS, AlertRule, rule_flags


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def with_event_time(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Event time as ``timestamp`` with a watermark (``timestamp_ntz`` cannot carry one)."""
    return df.withColumn(ts, col(ts).cast("timestamp")).withWatermark(ts, delay)


def evaluate_windows(
    events: DataFrame, series: Sequence[str], ts: str, step: str, condition: Column
) -> DataFrame:
    """One row ``(series..., evaluated_at, is_on)`` per series and closed window.

    ``condition`` is an aggregate expression. A hot series is reduced map-side,
    so state and shuffle hold one row per series and window.
    """
    grouped = events.groupBy(F.window(col(ts), step).alias("w"), *[col(s) for s in series]).agg(
        F.coalesce(condition, F.lit(False)).alias("is_on")
    )
    return grouped.select(*[col(s) for s in series], F.col("w.start").alias("evaluated_at"), "is_on")


class AlertProcessor(StatefulProcessor):
    """Joins the closed windows of one series into stretches.

    Between triggers a stretch that goes on is kept: its start, its last window
    and whether its alert was sent.
    """

    def __init__(self, names: Sequence[str], hold_seconds: int, step_seconds: int | None = None) -> None:
        self._names = list(names)
        self._hold = pd.Timedelta(seconds=hold_seconds)
        self._step = None if step_seconds is None else pd.Timedelta(seconds=step_seconds)

    def init(self, handle: StatefulProcessorHandle) -> None:
        # Instants travel as numbers, so no time zone touches them.
        self._stretch = handle.getValueState("stretch", "since_ns bigint, last_ns bigint, fired boolean")

    def handleInputRows(
        self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues
    ) -> Iterator[pd.DataFrame]:
        closed = pd.concat(list(rows)).sort_values("evaluated_at", ignore_index=True)
        at, on = closed["evaluated_at"], closed["is_on"].astype(bool)
        was, before = on.shift(1, fill_value=False), at.shift(1)
        since = fired = None
        if self._stretch.exists():
            since, last, fired = self._stretch.get()
            since = pd.Timestamp(since)  # nanoseconds
            was.iloc[0], before.iloc[0] = True, pd.Timestamp(last)
        goes_on = was if self._step is None else was & (at - before <= self._step)
        start = at.where(on & ~goes_on)
        if since is not None and on.iloc[0] and goes_on.iloc[0]:
            start.iloc[0] = since
        start = start.ffill().where(on)
        held = pd.DataFrame({"active_since": start, "firing_at": at})[on & (at - start >= self._hold)]
        firing = held.drop_duplicates("active_since")
        if fired:
            firing = firing[firing["active_since"] != since]
        if on.iloc[-1]:
            now = start.iloc[-1]
            sent = bool((held["active_since"] == now).any()) or (bool(fired) and now == since)
            self._stretch.update((now.value, at.iloc[-1].value, sent))
        else:
            self._stretch.clear()
        for name, value in zip(reversed(self._names), reversed(key)):
            firing.insert(0, name, value)
        yield firing

    def close(self) -> None:
        pass


def sustained_alert_stream(
    evaluations: DataFrame, series: Sequence[str], hold_seconds: int, step_seconds: int | None = None
) -> DataFrame:
    """Emit ``(series..., active_since, firing_at)`` once per alert, when it starts firing.

    ``evaluations`` comes from ``evaluate_windows`` in append mode: a window
    arrives once, after every earlier window of its series, so late rows are
    settled before they get here. With ``step_seconds``, the length of a window,
    a missing window ends a stretch. Needs the RocksDB state store.
    """
    key_types = {f.name: f.dataType for f in evaluations.schema.fields if f.name in series}
    out = T.StructType(
        [T.StructField(n, key_types[n]) for n in series]
        + [T.StructField("active_since", T.TimestampType()), T.StructField("firing_at", T.TimestampType())]
    )
    return evaluations.groupBy(*[col(n) for n in series]).transformWithStateInPandas(
        AlertProcessor(series, hold_seconds, step_seconds), out, outputMode="Append", timeMode="None"
    )


def signal_windows(events: DataFrame, series: Sequence[str], ts: str, step: str, signals: Sequence[Column]) -> DataFrame:
    """One row ``(series..., evaluated_at, signals...)`` per series and window; on a stream, once it is closed.

    Signals are named aggregate expressions. On a stream the rows keep their
    event time (``closed_at``), so that what follows can set timers by it.
    """
    grouped = events.groupBy(F.window(col(ts), step).alias("w"), *[col(s) for s in series]).agg(*signals)
    names = [c for c in grouped.columns if c != "w" and c not in series]
    return grouped.select(
        *[col(s) for s in series], F.col("w.start").alias("evaluated_at"), F.window_time("w").alias("closed_at"), *names)


class RuleAlertProcessor(StatefulProcessor):
    """Alerts of one series and rule, whose key ends with ``hold_seconds`` and ``on_silence``.

    A series with a silence rule keeps the time of its last good window and a
    timer for the moment at which the window that would make the alert fire is
    closed: silence sends no rows that could do it. Whatever comes first, the
    timer or the next good window, sends the alert.
    """

    def __init__(self, names: Sequence[str], step_seconds: int) -> None:
        self._names, self._step_seconds = list(names), step_seconds
        self._step = pd.Timedelta(seconds=step_seconds)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._stretch = handle.getValueState("stretch", "since_ns bigint, last_ns bigint, fired boolean")

    def _out(self, key: tuple, alerts: list[tuple[pd.Timestamp, pd.Timestamp]]) -> pd.DataFrame:
        found = pd.DataFrame(alerts, columns=["active_since", "firing_at"])
        for place, (name, value) in enumerate(zip(self._names, key)):
            found.insert(place, name, value)
        return found

    def _fires(self, since: pd.Timestamp, hold: int) -> pd.Timestamp:
        return since + -(-hold // self._step_seconds) * self._step

    def _timer(self, good: pd.Timestamp, hold: int) -> int:
        """When the firing window of a silence after ``good`` is closed, in milliseconds."""
        return (self._fires(good + self._step, hold) + self._step).value // 1_000_000

    def handleInputRows(
        self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues
    ) -> Iterator[pd.DataFrame]:
        closed = pd.concat(list(rows)).sort_values("evaluated_at", ignore_index=True)
        times, flags = list(closed["evaluated_at"]), closed["is_on"].astype(bool).tolist()
        hold, on_silence = int(key[-2]), bool(key[-1])
        answer = self._silent if on_silence else self._crossed
        yield self._out(key, answer(times, flags, hold))

    def _silent(self, times: list, bad: list[bool], hold: int) -> list[tuple]:
        if self._stretch.exists():
            _, last, fired = self._stretch.get()
            good = pd.Timestamp(last)
            self._handle.deleteTimer(self._timer(good, hold))
        else:
            good, fired = times[0] - self._step, False
        alerts = []
        for at in (t for t, b in zip(times, bad) if not b):
            firing = self._fires(good + self._step, hold)
            if not fired and firing <= at - self._step:
                alerts.append((good + self._step, firing))
            good, fired = at, False
        self._stretch.update((good.value, good.value, fired))
        if not fired:
            self._handle.registerTimer(self._timer(good, hold))
        return alerts

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        since, last, fired = self._stretch.get()
        good, hold = pd.Timestamp(last), int(key[-2])
        if not fired and expiredTimerInfo.getExpiryTimeInMs() == self._timer(good, hold):
            self._stretch.update((since, last, True))
            yield self._out(key, [(good + self._step, self._fires(good + self._step, hold))])

    def _crossed(self, times: list, on: list[bool], hold: int) -> list[tuple]:
        since = last = None
        fired, alerts = False, []
        if self._stretch.exists():
            since, last, fired = self._stretch.get()
            since, last = pd.Timestamp(since), pd.Timestamp(last)
        for at, flag in zip(times, on):
            if not flag:
                since = None
                continue
            if since is None or at - last > self._step:
                since, fired = at, False
            last = at
            if not fired and at - since >= pd.Timedelta(seconds=hold):
                alerts.append((since, at))
                fired = True
        if since is None:
            self._stretch.clear()
        else:
            self._stretch.update((since.value, last.value, fired))
        return alerts

    def close(self) -> None:
        pass


def alerts_by_rule_stream(
    evaluations: DataFrame, rules: Sequence[AlertRule], target: str, step_seconds: int, series: Sequence[str] = ()
) -> DataFrame:
    """Emit ``(target, series..., rule, severity, active_since, firing_at)`` once per alert, when it starts firing.

    ``evaluations`` comes from ``signal_windows`` on a stream in append mode.
    State is a time and a flag per series and rule. Needs the RocksDB state store.
    """
    flags = rule_flags(evaluations, rules, target, [*series, "evaluated_at", "closed_at"])
    names = [target, *series, *RULE_COLUMNS, "on_silence"]
    types = {f.name: f.dataType for f in flags.schema.fields}
    out = T.StructType(
        [T.StructField(n, types[n]) for n in names]
        + [T.StructField("active_since", T.TimestampType()), T.StructField("firing_at", T.TimestampType())])
    alerts = flags.groupBy(*[col(n) for n in names]).transformWithStateInPandas(
        RuleAlertProcessor(names, step_seconds), out, outputMode="Append", timeMode="EventTime")
    return alerts.drop("hold_seconds", "on_silence")


def end_marker(events: DataFrame, ts: str, after: str, path: str) -> DataFrame:
    """A stream of one row, null but for an event time ``after`` the last of a finished table.

    United with the stream of that table before the watermark is set, it moves
    the watermark past the table's last window, which append mode else keeps.
    Written below ``path``; ``after`` is the delay and a window at least.
    """
    last = events.agg((F.max(col(ts)) + F.expr(f"INTERVAL {after}")).alias("__last"))
    row = last.select(*[
        (F.col("__last") if f.name == ts else F.lit(None)).cast(f.dataType).alias(f.name) for f in events.schema.fields
    ])
    row.write.parquet(path)
    return events.sparkSession.readStream.schema(row.schema).parquet(path)
