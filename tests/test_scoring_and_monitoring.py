from __future__ import annotations

import math

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from conftest import rows
from tidemark.config import ColumnRule, Contract, Feature, FeatureSchema, ModelSpec
from tidemark.functions.buckets import bucket_index, quantile_from_counts
from tidemark.operators import models, monitor, scoring
from tidemark.operators.ordered import Chunks
from tidemark.streaming import scoring as streamed


def test_thresholds():
    assert scoring.parse_thresholds(" 3, 1,,2 ") == [1.0, 2.0, 3.0]
    assert scoring.parse_thresholds("1,x,2") == [] and scoring.parse_thresholds(None) == []
    assert scoring.threshold_labels(None, 3) == ["low", "medium", "high"]
    assert scoring.threshold_labels("a,b", 3) == ["low", "medium", "high"]
    assert scoring.threshold_labels("a, b ,c", 3) == ["a", "b", "c"]
    assert scoring.threshold_labels(None, 5) == [f"bucket_{i}" for i in range(5)]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 9, 100])
def test_bucket_index_is_bisect_right(spark, n):
    import bisect

    bounds = [float(i * 2) for i in range(n)]
    values = [-1.0, *[b + d for b in bounds for d in (0.0, 0.5)], 1e9]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    got = {r["v"]: r["b"] for r in df.select("v", bucket_index(F.col("v"), [F.lit(b) for b in bounds]).alias("b")).collect()}
    assert got.pop(None) is None
    assert got == {v: bisect.bisect_right(bounds, v) for v in values}


def test_category_order(spark):
    df = spark.createDataFrame(
        [("f", "e", 1.0), ("", "e", 1.0), (None, "", 10.0), (None, None, 9.9), (None, None, None)],
        "field string, explicit string, p double",
    )
    category = scoring.prediction_category(F.col("p"), F.col("field"), F.col("explicit"), [10.0], ["lo", "hi"])
    assert [r[0] for r in df.select(category).collect()] == ["f", "e", "hi", "lo", "unknown"]
    assert [r[0] for r in df.select(scoring.prediction_category(F.col("p"))).distinct().collect()] == ["unknown"]


def test_score_batch(spark):
    contract = Contract(columns={"x": ColumnRule("float", min=0), "k": ColumnRule("string", allowed_values=("a", "b"))})
    schema = FeatureSchema((Feature("x", "numeric", impute="median"),
                            Feature("k", "categorical", impute="most_frequent", encoding="binary")))
    train = spark.createDataFrame([(float(i), "ab"[i % 2], 2.0 * i) for i in range(20)], "x double, k string, y double")
    model, _ = models.train(train, schema, ModelSpec("ridge", {"alpha": 0.0}), "y")
    requests = spark.createDataFrame([(1, 3.0, "a"), (2, -1.0, "a"), (3, None, "z"), (4, None, None)], "id int, x double, k string")
    scored, rejected = scoring.score_batch(requests, model, contract, ["id"], category_field="k", thresholds=[5.0])
    got = {r["id"]: (round(r["prediction"], 6), r["category"]) for r in scored.collect()}
    assert got[1] == (6.0, "a") and set(got) == {1, 4} and got[4][1] == "bucket_1"
    assert rows(rejected.select("id")) == [(2,), (3,)]
    only_ids, _ = scoring.score_batch(requests.select("id"), model, contract, ["id"])
    assert only_ids.count() == 4


def test_score_stream_repeats_a_step_without_repeating_rows(spark, folder, monkeypatch):
    contract = Contract(columns={"x": ColumnRule("float", min=0)})
    train = spark.createDataFrame([(float(i), 2.0 * i) for i in range(20)], "x double, y double")
    model, _ = models.train(train, FeatureSchema((Feature("x", "numeric"),)), ModelSpec("ridge", {"alpha": 0.0}), "y")

    def run():
        source = spark.readStream.schema("id int, x double").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        streamed.score_stream(source, model, contract, ["id"], f"{folder}/out", f"{folder}/checkpoint", thresholds=[7.0],
                              available_now=True).awaitTermination()

    def arrive(*requests):
        spark.createDataFrame(list(requests), "id int, x double").coalesce(1).write.mode("append").parquet(f"{folder}/in")

    arrive((1, 3.0), (2, -1.0))
    run()
    arrive((3, 4.0), (4, None), (5, -2.0))
    plain = streamed.score_batch

    def broken(*args):
        scored, rejected = plain(*args)
        return scored.withColumn("prediction", F.raise_error(F.lit("lost"))), rejected

    monkeypatch.setattr(streamed, "score_batch", broken)
    with pytest.raises(StreamingQueryException):
        run()
    # The rejected rows of the broken step are written already; the repeated step replaces them.
    assert rows(streamed.rejected_rows(spark, f"{folder}/out").select("id")) == [(2,), (4,), (5,)]
    monkeypatch.setattr(streamed, "score_batch", plain)
    run()
    scored = streamed.scored_rows(spark, f"{folder}/out").select("id", F.round("prediction", 6), "category", "step")
    assert rows(scored) == [(1, 6.0, "bucket_0", 0), (3, 8.0, "bucket_1", 1)]
    assert rows(streamed.rejected_rows(spark, f"{folder}/out").select("id", "step")) == [(2, 0), (4, 1), (5, 1)]


def test_confidence_histogram(spark):
    df = spark.createDataFrame([(0.1,), (0.15,), (1.0,), (None,)], "confidence double")
    got = {r["le"]: r["n_cumulative"] for r in scoring.confidence_histogram(df).collect()}
    assert got["0.1"] == 1 and got["0.2"] == 2 and got["0.9"] == 2 and got["1.0"] == 3 and got["+Inf"] == 3


@pytest.mark.parametrize(
    "q, counts, total, want",
    [
        (0.5, [0, 10, 10], 10, 1.5), (0.95, [5, 10, 10], 10, 1.9), (0.5, [5, 10, 10], 10, 1.0),
        (0.99, [1, 2, 3], 10, 4.0), (0.5, [0, 0, 0], 0, None), (0.1, [10, 10, 10], 10, 0.1),
    ],
)
def test_histogram_quantile(spark, q, counts, total, want):
    df = spark.createDataFrame([(counts, total)], "c array<bigint>, n bigint")
    got = df.select(quantile_from_counts(q, [1.0, 2.0, 4.0], F.col("c"), F.col("n")).alias("v")).first()["v"]
    assert got == want or math.isclose(got, want)


def at(seconds):
    return F.timestamp_seconds(seconds)


def series(spark, data, columns="s string, t bigint, v double"):
    return spark.createDataFrame(data, columns).withColumn("t", F.timestamp_seconds("t"))


@pytest.mark.parametrize("per_chunk", [100, 3, 1])
def test_counter_reset(spark, per_chunk):
    df = series(spark, [("a", 0, 10.0), ("a", 60, 15.0), ("a", 120, 3.0), ("a", 180, 4.0), ("a", 180, 3.5),
                        ("a", 300, 10.0), ("b", 0, 7.0)])
    steps = monitor.counter_increases(df, ["s"], "t", "v", per_chunk)
    got = [r["increase"] for r in steps.where("s = 'a'").orderBy("t").collect()]
    assert got == [None, 5.0, 3.0, 1.0, 6.0]
    rates = {(r["s"], r["window_start"].minute): r["rate"] for r in monitor.counter_rate(df, ["s"], "t", "v", 5, per_chunk).collect()}
    assert math.isclose(rates[("a", 0)], 9 / 300) and math.isclose(rates[("a", 5)], 6 / 300) and rates[("b", 0)] == 0


def test_busy_share(spark):
    rates = spark.createDataFrame([(1, "h", "cpu0", 0.25), (1, "h", "cpu1", 0.75)], "window_start int, host string, cpu string, rate double")
    assert rows(monitor.busy_share(rates, "host")) == [(1, "h", 0.5)]


def test_gauge_ratio(spark):
    df = spark.createDataFrame([("h", "ext4", 25.0, 100.0), ("h", "xfs", 25.0, 100.0), ("h", "tmpfs", 0.0, 100.0), ("z", "xfs", 0.0, 0.0)],
                               "host string, fs string, a double, t double")
    got = monitor.gauge_ratio(df, ["host"], "a", "t", keep=~F.col("fs").rlike("^(tmpfs|overlay)$"))
    assert rows(got) == [("h", 0.75), ("z", None)]


@pytest.mark.parametrize("bounds", [[], [60], [30, 60, 90, 120, 150, 400]])
def test_sustained_alerts(spark, bounds):
    on = {0: 1, 30: 1, 60: 0, 90: 1, 120: 1, 150: 1, 180: 0, 210: 1, 240: None, 300: 1, 330: 1, 360: 1, 390: 1}
    df = series(spark, [("a", t, None if v is None else float(v)) for t, v in on.items()] + [("b", 0, 1.0), ("b", 60, 1.0)])
    cuts = [f"1970-01-01 00:{b // 60:02d}:{b % 60:02d}" for b in bounds]
    long_series = spark.createDataFrame([("a",)], "__long_0 string")
    chunks = Chunks(long_series, cuts, "timestamp") if cuts else None
    got = monitor.sustained_alerts(df, ["s"], "t", F.col("v") == 1, 60, chunks)
    found = sorted((r["s"], *(int(r[c].timestamp()) for c in ("active_since", "firing_at", "last_true_at")), r["n_evaluations"])
                   for r in got.collect())
    # Shorter than the hold time: none. Equal: fires at the last evaluation. Longer: fires on the way.
    assert found == [("a", 90, 150, 150, 3), ("a", 300, 360, 390, 4), ("b", 0, 60, 60, 2)]


def test_alerts_end_at_gaps(spark):
    df = series(spark, [("a", t, 1.0) for t in (0, 30, 120, 150, 180, 240)])
    got = monitor.sustained_alerts(df, ["s"], "t", F.col("v") == 1, 60, step_seconds=30)
    assert [(int(r["active_since"].timestamp()), int(r["firing_at"].timestamp()), r["n_evaluations"]) for r in got.collect()] == [(120, 180, 3)]


def test_resample_and_daily_delta(spark):
    day = 86400
    df = series(spark, [("a", 10, 1.0), ("a", 20, 2.0), ("a", 7 * 3600, 3.0), ("a", 8 * 3600, None), ("a", 2 * day, 10.0)])
    assert [r["v"] for r in monitor.resample_last(df, ["s"], "t", "v").orderBy("window_start").collect()] == [2.0, 3.0, 10.0]
    got = monitor.daily_delta(df, ["s"], "t", "v").orderBy("day").collect()
    assert [(r["v"], r["delta"]) for r in got] == [(3.0, None), (10.0, 7.0)]


def test_error_counts(spark):
    df = spark.createDataFrame([("/p", 200), ("/p", 500), ("/p", 500), ("/q", 403)], "endpoint string, status int")
    assert rows(monitor.error_counts(df, ["endpoint"], "status")) == [("/p", 500, 2), ("/q", 403, 1)]
