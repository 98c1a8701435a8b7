from __future__ import annotations

import math
import random
import struct
import statistics

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.config import Feature, FeatureSchema
from tidemark.functions.quantiles import double_of, exact_quantiles, grouped_quantile, ordered_bits
from tidemark.operators import features as feat
from tidemark.operators.ordered import find_chunks, forward_fill, last_before


def one(spark, values, feature, kind="double"):
    """Fit and transform a single column, in input order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    model = feat.fit(df, FeatureSchema((feature,)))
    out = model.transform(df, keep=["i"]).orderBy("i").collect()
    return model, [tuple(r)[1:] if len(r) > 2 else r[1] for r in out]


GAPS = [10.0, 20.0, None, 40.0, 50.0]


@pytest.mark.parametrize("how, want", [("median", 30.0), ("mean", 30.0), ("constant", 0.0)])
def test_numeric_imputers(spark, how, want):
    _, got = one(spark, GAPS, Feature("x", "numeric", impute=how))
    assert got == [10.0, 20.0, want, 40.0, 50.0]


def test_nan_is_imputed_and_even_median_interpolates(spark):
    _, got = one(spark, [1.0, 3.0, float("nan"), 4.0, 8.0], Feature("x", "numeric", impute="median"))
    assert got[2] == 3.5


def test_most_frequent_tie_goes_to_the_smallest(spark):
    model, _ = one(spark, ["b", "a", None, "b", "a", "c"],
                   Feature("x", "categorical", impute="most_frequent", encoding="onehot"), "string")
    assert model.fills["x"] == "a"
    model, got = one(spark, [10.0, 9.0, None, 10.0, 9.0], Feature("x", "numeric", impute="most_frequent"))
    assert got[2] == 9.0  # as numbers, not as text


def test_constant_fill_value(spark):
    model, got = one(spark, ["a", None], Feature("x", "categorical", impute="constant", encoding="onehot"), "string")
    assert model.output_columns == ["x_a", "x_missing_value"] and got == [(1.0, 0.0), (0.0, 1.0)]
    _, got = one(spark, [1.0, None], Feature("x", "numeric", impute="constant", fill_value=7))
    assert got == [1.0, 7.0]


def test_clip_comes_after_imputation_and_keeps_missing(spark):
    _, got = one(spark, [-100.0, 10.0, None, 5000.0], Feature("x", "numeric", clip=(0, 100)))
    assert got == [0.0, 10.0, None, 100.0]
    _, got = one(spark, [-100.0, 10.0, None, 5000.0], Feature("x", "numeric", impute="mean", clip=(0, 100)))
    assert got == [0.0, 10.0, 100.0, 100.0]


def test_scalers(spark):
    values = [10.0, 20.0, 30.0, 40.0, 50.0]
    _, got = one(spark, values, Feature("x", "numeric", scaler="standard"))
    assert np.allclose(got, (np.array(values) - 30) / np.std(values))
    _, got = one(spark, values, Feature("x", "numeric", scaler="minmax"))
    assert got == [0.0, 0.25, 0.5, 0.75, 1.0]
    for scaler in ("standard", "minmax"):  # no spread
        _, got = one(spark, [3.0, 3.0], Feature("x", "numeric", scaler=scaler))
        assert got == [0.0, 0.0]


def test_encoders(spark):
    _, got = one(spark, ["Yes", "No", "Yes"], Feature("x", "categorical", encoding="binary"), "string")
    assert got == [1.0, 0.0, 1.0]
    order = ("low", "mid", "high")
    _, got = one(spark, ["high", "low", None], Feature("x", "categorical", encoding="ordinal", order=order), "string")
    assert got == [2.0, 0.0, None]
    model, got = one(spark, ["b", "a", "c"], Feature("x", "categorical", encoding="onehot"), "string")
    assert got == [(0.0, 1.0, 0.0), (1.0, 0.0, 0.0), (0.0, 0.0, 1.0)]
    unseen = spark.createDataFrame([("z",), (None,)], "x string")
    assert rows(model.transform(unseen)) == [(0.0, 0.0, 0.0)] * 2


def test_unseen_binary_value_fails_or_is_null(spark):
    model, _ = one(spark, ["Yes", "No"], Feature("x", "categorical", encoding="binary"), "string")
    unseen = spark.createDataFrame([("Maybe",)], "x string")
    with pytest.raises(Exception, match="unknown value Maybe"):
        model.transform(unseen).collect()
    assert rows(model.transform(unseen, on_unseen="null")) == [(None,)]


def test_stored_dictionaries_code_like_small_ones(spark, folder):
    values = ["pear", "apple", None, "fig", "pear", "kiwi", "apple", "apple", "é", "Zebra"]
    df = spark.createDataFrame([(i, v, v) for i, v in enumerate(values)], "i int, x string, y string")
    schema = FeatureSchema((
        Feature("x", "categorical", impute="constant", fill_value="banana", encoding="binary"),
        Feature("y", "categorical", impute="most_frequent", encoding="onehot")))
    small, large = feat.fit(df, schema), feat.fit(df, schema, max_categories=3, dictionary_path=folder + "/dictionary")
    assert not small.dictionaries and {k: v.size for k, v in large.dictionaries.items()} == {"x": 7, "y": 6} and not large.categories
    large = feat.FeatureModel.from_json(large.to_json())
    got = {r["i"]: (r["x"], r["y"].toArray().tolist()) for r in large.transform(df, keep=["i"]).collect()}
    want = {r["i"]: (r["x"], [r[c] for c in small.output_columns[1:]]) for r in small.transform(df, keep=["i"]).collect()}
    assert got == want and large.output_columns == ["x", "y"]
    other = spark.createDataFrame([(1, "new", "new"), (2, None, None)], "i int, x string, y string")
    unseen = {r["i"]: (r["x"], r["y"].toArray().sum()) for r in large.transform(other, keep=["i"], on_unseen="null").collect()}
    assert unseen == {1: (None, 0.0), 2: (2.0, 1.0)}
    with pytest.raises(Exception, match="unknown value new"):
        large.transform(other, keep=["i"]).collect()


def test_twenty_thousand_categories(spark, folder):
    df = spark.range(60_000).select(
        F.col("id").alias("i"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id") % 20_000)).alias("x"),
        (F.col("id") % 7).cast("double").alias("n"))
    schema = FeatureSchema((Feature("x", "categorical", encoding="onehot"), Feature("n", "numeric", scaler="minmax")))
    model = feat.fit(df, schema, dictionary_path=folder + "/dictionary")
    names = sorted({"hot", *(f"v{k % 20_000}" for k in range(60_000) if k % 3)})
    assert model.dictionaries["x"].size == len(names) > 10_000
    matrix = model.transform(df, keep=["i"])
    rows_ = matrix.where("i in (0, 1, 2, 59999)").collect()
    code = {n: k for k, n in enumerate(names)}
    assert {r["i"]: (r["x"].size, r["x"].indices.tolist()) for r in rows_} == {
        i: (len(names), [code["hot" if i % 3 == 0 else f"v{i % 20_000}"]]) for i in (0, 1, 2, 59_999)}
    assert matrix.count() == 60_000


def test_model_round_trips_as_json(spark):
    schema = FeatureSchema(
        (Feature("x", "numeric", impute="mean", clip=(0, 45), scaler="standard"),
         Feature("c", "categorical", impute="most_frequent", encoding="onehot"))
    )
    df = spark.createDataFrame([(1.0, "a"), (None, "b"), (50.0, None)], "x double, c string")
    model = feat.fit(df, schema)
    again = feat.FeatureModel.from_json(model.to_json())
    assert rows(again.transform(df)) == rows(model.transform(df)) and again.output_columns == ["x", "c_a", "c_b"]


def test_transform_plan_is_one_projection(spark):
    df = spark.createDataFrame([(1.0, "a")], "x double, c string")
    schema = FeatureSchema((Feature("x", "numeric", impute="median"),
                            Feature("c", "categorical", encoding="binary")))
    plan = feat.fit(df, schema).transform(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_bad_schemas():
    for bad in (
        dict(type="image"), dict(type="numeric", impute="guess"), dict(type="numeric", scaler="robust"),
        dict(type="categorical"), dict(type="categorical", encoding="ordinal"),
        dict(type="categorical", encoding="onehot", impute="mean"),
    ):
        with pytest.raises(ValueError):
            Feature.from_dict("x", bad)


def test_extract_xy(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "a double, x double, y double")
    schema = FeatureSchema((Feature("x", "numeric"),))
    assert feat.extract_xy(df, schema, "y").columns == ["x", "y"]
    with pytest.raises(ValueError, match="target"):
        feat.extract_xy(df, schema, "z")


def test_target_encode_and_log_scale(spark):
    df = spark.createDataFrame([("A", 10.0), ("A", 12.0), ("B", 50.0), (None, 1.0)], "c string, y double")
    got = {(r["c"], r["y"]): r["m"] for r in feat.target_encode(df, "c", "y", "m").collect()}
    assert got == {("A", 10.0): 11.0, ("A", 12.0): 11.0, ("B", 50.0): 50.0, (None, 1.0): 1.0}
    scaled = [r["z"] for r in feat.standard_scaled(df, {"z": F.log1p("y")}).collect()]
    assert abs(statistics.fmean(scaled)) < 1e-12 and abs(statistics.pstdev(scaled) - 1) < 1e-12


# --- exact quantiles ---


def skewed(n, kind):
    rng = random.Random(kind)
    if kind == "hot":  # two values own most rows, around the median
        return [5.0 if rng.random() < 0.45 else 7.0 if rng.random() < 0.8 else rng.random() * 12 for _ in range(n)]
    if kind == "ties":
        return [float(rng.randrange(3)) for _ in range(n)]
    if kind == "one":
        return [2.5] * n
    return [math.exp(rng.gauss(0, 9)) for _ in range(n)]


@pytest.mark.parametrize("kind", ["hot", "ties", "one", "wide"])
def test_exact_quantiles_by_narrowing(spark, kind):
    values = skewed(60_001, kind)
    df = spark.createDataFrame(pd.DataFrame({"x": values})).repartition(5)
    wanted = {f"q{q}": (F.col("x"), q) for q in (0.0, 0.01, 0.5, 0.95, 1.0)}
    got = exact_quantiles(df, wanted, exact_limit=10_000)
    for q in (0.0, 0.01, 0.5, 0.95, 1.0):
        assert math.isclose(got[f"q{q}"], float(np.quantile(values, q)), rel_tol=1e-12), q


def test_exact_quantiles_of_little(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None), (4.0, None), (8.0, None)], "x double, e double")
    assert exact_quantiles(df, {"m": (F.col("x"), 0.5), "e": (F.col("e"), 0.5)}) == {"m": 3.5, "e": None}


EDGES = [0.0, -0.0, 1.0, -1.0, 0.1, 5e-324, -5e-324, 2.0**-1022, 2.0**-1022 - 5e-324, 1.7976931348623157e308, -1.7976931348623157e308,
         math.inf, -math.inf, 8.0, math.nextafter(8.0, 0), math.nextafter(8.0, 9), math.pi, 2.0**52 + 1, 1e-310, -1e300]


def test_bits_order_like_doubles(spark):
    rng = random.Random(4)
    values = EDGES + [rng.choice((-1, 1)) * math.ldexp(rng.random(), rng.randrange(-1070, 1020)) for _ in range(3000)]
    values += [math.ldexp(1, k) for k in range(-1074, 1024, 7)]
    df = spark.createDataFrame([(v,) for v in [*values, None, math.nan]], "x double")
    found = df.select("x", ordered_bits(F.col("x")).alias("b")).select("x", "b", double_of(F.col("b")).alias("y")).collect()
    assert [r.b for r in found[-2:]] == [None, None] and all(r.x == r.y for r in found[:-2])
    want = [struct.unpack("<q", struct.pack("<d", v + 0.0))[0] for v in values]
    assert [r.b if r.b >= 0 else (-1 - r.b) | -(1 << 63) for r in found[:-2]] == want
    by_bits = [r.x for r in sorted(found[:-2], key=lambda r: r.b)]
    assert by_bits == sorted(values)


def test_quantiles_of_null_and_extreme_groups(spark):
    data = [(None, v) for v in (3.0, 1.0, None, math.nan)] + [("a", math.inf), ("a", -math.inf), ("a", 2.0), ("none", None)]
    df = spark.createDataFrame(data, "g string, x double")
    got = {r["g"]: r["v"] for r in grouped_quantile(df, ["g"], "x", 0.5, "v").collect()}
    assert got == {None: 2.0, "a": 2.0}
    assert grouped_quantile(df.limit(0), ["g"], "x", 0.5, "v").isEmpty() and exact_quantiles(df.limit(0), {"m": (F.col("x"), 0.5)}) == {"m": None}


@pytest.mark.parametrize("q", [0.0, 0.3, 0.5, 0.95, 1.0])
def test_grouped_quantile(spark, q):
    rng = random.Random(1)
    data = [("hot", v) for v in skewed(20_000, "wide")]
    data += [(f"g{rng.randrange(200)}", float(rng.randrange(50))) for _ in range(3000)] + [("solo", 4.0)]
    pdf = pd.DataFrame(data, columns=["g", "x"])
    df = spark.createDataFrame(pdf)
    got = {r["g"]: r["v"] for r in grouped_quantile(df, ["g"], "x", q, "v", exact_limit=1000).collect()}
    want = pdf.groupby("g")["x"].quantile(q).to_dict()
    assert got.keys() == want.keys()
    assert all(math.isclose(got[g], want[g], rel_tol=1e-9, abs_tol=1e-12) for g in want)


# --- order-dependent operators ---


def series_frame(spark):
    rng = random.Random(5)
    data = []
    for i in range(600):
        s = "hot" if i % 3 else rng.choice(["a", "b", None])
        data.append((s, rng.randrange(400), i, None if rng.random() < 0.4 else rng.random()))
    return data, spark.createDataFrame(data, "s string, t int, i int, v double").repartition(4)


@pytest.mark.parametrize("per_chunk", [1000, 300, 100, 10, 1])
@pytest.mark.parametrize("inclusive", [True, False])
def test_chunked_carry_equals_plain_window(spark, per_chunk, inclusive):
    data, df = series_frame(spark)
    chunks = find_chunks(df, ["s"], "t", per_chunk)
    assert (chunks is None) == (per_chunk >= 600)
    got = last_before(df, {"p": F.col("v")}, by=["s"], order=["t", "i"], inclusive=inclusive, chunks=chunks)
    want, latest = {}, {}
    for s, t, i, v in sorted(data, key=lambda r: (r[1], r[2])):
        if inclusive and v is not None:
            latest[s] = v
        want[i] = latest.get(s)
        if v is not None:
            latest[s] = v
    assert {r["i"]: r["p"] for r in got.collect()} == want


def test_only_long_series_are_cut(spark):
    _, df = series_frame(spark)
    assert [r[0] for r in find_chunks(df, ["s"], "t", 300).series.collect()] == ["hot"]


@pytest.mark.parametrize("per_chunk", [10, 2, 1])
def test_forward_fill_of_one_series(spark, per_chunk):
    df = spark.createDataFrame([(1, 10.0), (2, None), (3, None), (4, 40.0), (5, 50.0)], "t int, v double")
    filled = forward_fill(df, ["v"], order=["t"], rows_per_chunk=per_chunk).orderBy("t").collect()
    assert [r["v"] for r in filled] == [10.0, 10.0, 10.0, 40.0, 50.0]


def test_chunks_of_timestamps_are_even(spark):
    df = spark.range(1000).select(F.timestamp_millis(F.col("id") * F.col("id")).cast("timestamp_ntz").alias("t"))
    chunks = find_chunks(df, [], "t", 100)
    assert len(chunks.cuts) == 9 and find_chunks(df, [], "t", 1000) is None
    sizes = df.groupBy(chunks.index(F.col("t")).alias("c")).count().collect()
    assert len(sizes) == 10 and max(r["count"] for r in sizes) < 130
