"""Rules as data: batch, stream and a walk over a dense grid agree; silence fires without a row."""

import datetime as dt
import random
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.operators.alert_rules import RULES, AlertRule, alerts_by_rule
from tidemark.streaming import events as stream

START = dt.datetime(2024, 5, 1)
RULE_SET = (
    AlertRule("Down", "a", "up", None, 120, "critical"),
    AlertRule("DownLong", "b", "up", None, 150, "high"),
    AlertRule("Busy", "a", "load", 0.5, 60, "warning"),
    AlertRule("Other", "nobody", "load", 0.5, 60, "warning"),
)


def minute(k):
    return START + dt.timedelta(minutes=k)


def walk(rows, rules, step=60):
    """Every rule at every minute of the grid."""
    last = max(r[2] for r in rows)
    found = set()
    for rule in rules:
        for host in {r[1] for r in rows if r[0] == rule.target}:
            seen = {r[2]: r for r in rows if r[0] == rule.target and r[1] == host}
            since, fired, at = None, False, min(seen)
            while at <= last:
                row = seen.get(at)
                if rule.on_silence:
                    on = row is None or not row[3]
                else:
                    on = row is not None and row[4] is not None and row[4] > rule.above
                if not on:
                    since, fired = None, False
                else:
                    since = since or at
                    if not fired and (at - since).total_seconds() >= rule.hold_seconds:
                        found.add((rule.target, host, rule.name, rule.severity, since, at))
                        fired = True
                at += dt.timedelta(seconds=step)
    return found


def made(seed):
    draw = random.Random(seed)
    rows = []
    for target, host in (("a", "h1"), ("a", "h2"), ("b", "h1"), ("c", "h1")):
        for k in range(draw.randint(0, 20), 120):
            if draw.random() < 0.6:
                rows.append((target, host, minute(k), draw.choice([1, 1, 0, None]), draw.choice([0.2, 0.9, 0.9, None, float("nan")])))
    # One host ends long before the grid does.
    return [r for r in rows if not (r[1] == "h2" and r[2] > minute(70))]


SCHEMA = "job string, host string, evaluated_at timestamp_ntz, up int, load double"


@pytest.mark.parametrize("seed", [1, 2])
def test_batch_equals_a_walk_over_the_grid(spark, seed):
    rows = made(seed)
    got = alerts_by_rule(spark.createDataFrame(rows, SCHEMA), RULE_SET, "job", "evaluated_at", 60, ["host"]).collect()
    assert {(r.job, r.host, r.rule, r.severity, r.active_since, r.firing_at) for r in got} == walk(rows, RULE_SET)
    assert {r.rule for r in got} == {"Down", "DownLong", "Busy"}
    assert all(r.n_evaluations == (r.last_true_at - r.active_since).total_seconds() / 60 + 1 for r in got)


def test_tables_without_evaluations(spark):
    assert alerts_by_rule(spark.createDataFrame([], SCHEMA), RULE_SET, "job", "evaluated_at", 60, ["host"]).isEmpty()


def test_shipped_rules():
    assert len(RULES) == 8 and sum(r.on_silence for r in RULES) == 4 and len({r.name for r in RULES}) == 8


def test_stream_notices_silence_by_timers(spark, folder):
    """Fed minute by minute, with a long silence that nothing of its own series ends."""
    rows = [(t, h, at, up, load) for t, h, at, up, load in made(3)]
    events = spark.createDataFrame([(t, h, at.replace(tzinfo=dt.timezone.utc), up, load) for t, h, at, up, load in rows],
                                   "job string, host string, ts timestamp, up int, load double")
    Path(folder, "in").mkdir()
    for part, (a, b) in enumerate(((0, 50), (50, 90), (90, 200))):
        piece = events.where((F.col("ts") >= F.lit(minute(a).replace(tzinfo=dt.timezone.utc))) & (F.col("ts") < F.lit(minute(b).replace(tzinfo=dt.timezone.utc))))
        piece.coalesce(1).write.parquet(f"{folder}/parts/{part}")
        shutil.copy(next(Path(f"{folder}/parts/{part}").glob("*.parquet")), f"{folder}/in/{part}.parquet")
    source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    # The marker comes in a file of its own, after all others: no row is late.
    stream.end_marker(events, "ts", "2 MINUTES", f"{folder}/end")
    shutil.copy(next(Path(f"{folder}/end").glob("*.parquet")), f"{folder}/in/9.parquet")
    timed = stream.with_event_time(source, "ts", "1 minute")
    signals = [F.max("up").alias("up"), F.max("load").alias("load")]
    windows = stream.signal_windows(timed, ["job", "host"], "ts", "1 minute", signals)
    found = stream.alerts_by_rule_stream(windows, RULE_SET, "job", 60, ["host"])
    found.writeStream.outputMode("append").format("parquet").option("path", f"{folder}/out").option(
        "checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start().awaitTermination()
    got = spark.read.schema(found.schema).parquet(f"{folder}/out")
    got = got.select("job", "host", "rule", "severity", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("active_since", "firing_at")])
    rows = [(t, h, at, up, None if load != load else load) for t, h, at, up, load in rows]
    want = walk(rows, RULE_SET)
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)
    assert any(a[1] == "h2" and a[2] == "Down" and a[4] > minute(60) for a in want)
