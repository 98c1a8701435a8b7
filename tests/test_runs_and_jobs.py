from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.config import Feature, FeatureSchema, ModelSpec, RunConfig, SplitSpec
from tidemark.jobs.retraining import retrain_decision
from tidemark.jobs.store import RunStore
from tidemark.jobs.training import TrainingJob
from tidemark.operators import lineage, runs as ops


def run(run_id, rmsle, start, master_rows=None, status="FINISHED", config=("1", "1", "1"), r2=None):
    metrics = {k: v for k, v in {"reference_rmsle": rmsle, "reference_r2": r2, "master_rows": master_rows}.items()
               if v is not None}
    params = dict(zip(ops.CONFIG_KEYS, config))
    return (run_id, "0", status, start, start + 1500, metrics, params, {"owner": "x"})


@pytest.fixture(scope="module")
def runs(spark):
    return spark.createDataFrame(
        [
            run("a", 0.5, 1000, 1000.0, r2=0.7),
            run("b", 0.4, 2000, 1010.0, r2=0.9),
            run("c", 0.4, 3000, None, r2=0.9),
            run("d", float("nan"), 4000, 5.0, config=("1", "2", "1")),
            run("e", None, 5000, 7.0, config=("2", "2", "1")),
            run("f", 0.1, 6000, 9.0, status="FAILED", config=("2", "2", "1")),
        ],
        ops.RUNS_SCHEMA,
    )


def registry(spark, run_id="b", alias="prod"):
    versions = spark.createDataFrame([("m", 1, "a"), ("m", 2, "b"), ("other", 1, "c")], ops.MODEL_VERSIONS_SCHEMA)
    log = [("m", alias, 1, 10)] + ([("m", alias, 2, 20)] if run_id == "b" else [])
    return versions, spark.createDataFrame(log, ops.ALIASES_SCHEMA)


def test_production_lookup(spark, runs):
    versions, aliases = registry(spark)
    row = ops.production_lookup(aliases, versions, runs).first()
    assert (row["version"], row["run_id"], row["metrics"]["reference_rmsle"]) == (2, "b", 0.4)
    assert ops.production_lookup(aliases, versions, runs, alias="staging").isEmpty()


def test_promotion_is_strict(spark, runs):
    versions, aliases = registry(spark)
    prod = ops.production_lookup(aliases, versions, runs)
    got = {r["run_id"]: r["promoted"] for r in ops.promotion_decision(runs, prod).collect()}
    assert got == {"a": False, "b": False, "c": False, "d": False, "e": False, "f": True}
    nobody = prod.where(F.lit(False))
    got = {r["run_id"]: r["promoted"] for r in ops.promotion_decision(runs, nobody).collect()}
    assert got == {"a": True, "b": True, "c": True, "d": False, "e": False, "f": True}


def test_last_rows(spark, runs):
    assert rows(ops.last_rows_per_config(runs)) == [
        (1, 1, 1, "c", 0), (1, 2, 1, "d", 5), (2, 2, 1, "f", 9),
    ]
    frame = spark.range(1)
    for config, want in ((RunConfig(1, 2, 1), 5), (RunConfig(1, 1, 1), 0), (RunConfig(9, 9, 9), 0)):
        assert frame.select(ops.last_rows_for(runs, config).alias("n")).first()["n"] == want
    # Runs of another experiment do not count, however new.
    mixed = runs.withColumn("experiment_id", F.when(F.col("run_id") == "d", "other").otherwise("mine"))
    assert rows(ops.last_rows_per_config(mixed, experiment_id="mine")) == [(1, 1, 1, "c", 0), (2, 2, 1, "f", 9)]
    assert frame.select(ops.last_rows_for(mixed, RunConfig(1, 2, 1), experiment_id="mine").alias("n")).first()["n"] == 0


@pytest.mark.parametrize(
    "current, last, threshold, want",
    [(1020, 1000, 10, True), (1005, 1000, 10, False), (1010, 1000, 10, False), (1011, 1000, 10, True),
     (1, 0, 0, True), (0, 0, 0, False)],
)
def test_retrain_rule(spark, current, last, threshold, want):
    one = spark.createDataFrame([(1, 1, 1, last)], "split_version int, feature_version int, model_version int, last_rows bigint")
    row = ops.retrain_decisions(one, F.lit(current), threshold).first()
    assert row["should_retrain"] is want and row["new_rows"] == current - last


def test_overview_without_production(spark, runs):
    versions, aliases = registry(spark)
    nobody = ops.production_lookup(aliases, versions, runs, "none")
    row = ops.dataset_overview(nobody, ops.last_rows_per_config(runs), spark.range(50)).first()
    assert tuple(row) == (0, 0, 0, 10, False)
    prod = ops.production_lookup(aliases, versions, runs)
    row = ops.dataset_overview(prod, ops.last_rows_per_config(runs), spark.range(50)).first()
    assert tuple(row) == (50, 0, 50, 10, True)


def test_config_needs_every_key(spark, runs):
    assert rows(ops.run_config(runs.where("run_id = 'd'"))) == [("d", 1, 2, 1)]
    broken = runs.withColumn("params", F.map_filter("params", lambda k, v: k != "model_version"))
    with pytest.raises(Exception, match="model_version"):
        ops.run_config(broken).collect()


def test_leaderboard_puts_missing_last(runs):
    board = ops.leaderboard(runs).collect()
    assert [r["run_id"] for r in board] == ["f", "b", "c", "a", "d", "e"]
    assert board[0]["run_duration_seconds"] == 1.5


def test_best_flags(runs):
    got = {r["run_id"]: (r["production"], r["best"], r["delta"]) for r in ops.flag_best(runs, "reference_rmsle", F.lit("a")).collect()}
    assert got["b"] == (False, True, None) and got["a"] == (True, False, -0.1) and "f" not in got
    got = {r["run_id"]: (r["best"], r["delta"]) for r in ops.flag_best(runs, "reference_r2", F.lit("a")).collect()}
    assert got["b"] == (True, None) and got["a"] == (False, -0.2)
    assert not any(r["production"] for r in ops.flag_best(runs).collect())


def test_flatten_and_summary(runs):
    assert ops.map_keys_of(runs, "metrics") == ["master_rows", "reference_r2", "reference_rmsle"]
    flat = ops.flatten_runs(runs, ["reference_r2"], ["split_version"], ["owner"])
    assert flat.columns == ["run_id", "status", "start_time", "end_time", "reference_r2", "split_version", "owner"]
    row = ops.run_summary(runs).where("run_id = 'a'").first()
    assert row["metrics"] == {"reference_rmsle": 0.5, "reference_r2": 0.7}
    assert row["last_updated_at"] == "1970-01-01T00:00:02.500000+00:00"
    assert row["data_version"] == {"split_version": "1"}


def test_progress(spark):
    tasks = spark.createDataFrame([("r", s) for s in ("success", "failed", "running", "queued")], "run_id string, state string")
    assert tuple(ops.run_progress(tasks).first()) == ("r", 4, 1, 1, 1, 2, 0.5)


def test_store_folds_later_entries_over_earlier(spark, folder):
    store = RunStore(spark, folder)
    assert store.runs().isEmpty() and store.production("m").isEmpty()
    run_id = store.open_run()
    store.log(run_id, metric={"x": 1.0, "gone": None})
    store.log(run_id, metric={"x": 2.0, "y": 3.0})
    store.log(run_id, param={"split_version": 1, "feature_version": 2, "model_version": 3})
    store.close_run(run_id)
    row = store.runs().first()
    assert row["status"] == "FINISHED" and row["metrics"] == {"x": 2.0, "y": 3.0}
    assert row["end_time"] >= row["start_time"] and store.run_config(run_id) == RunConfig(1, 2, 3)
    assert store.promote("m", run_id) == 1 and store.promote("m", run_id) == 2
    assert store.production("m").first()["version"] == 2


def test_fingerprint_ignores_order(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).cast("string").alias("s"))
    same = df.repartition(7).select("s", "id").orderBy(F.desc("id"))
    changed = df.withColumn("s", F.when(F.col("id") == 3, "x").otherwise(F.col("s")))
    prints = [lineage.fingerprint(d).first() for d in (df, same, changed, df.union(df.limit(1)))]
    assert prints[0] == prints[1] and len({p["fingerprint"] for p in prints}) == 3
    assert lineage.fingerprint(df.limit(0)).first()["n_rows"] == 0


def test_fingerprint_tells_where_values_end_and_nulls_are(spark):
    def root(rows):
        return lineage.fingerprint(spark.createDataFrame(rows, "a string, b string")).first()["fingerprint"]

    tables = [[("ab", "c")], [("a", "bc")], [(None, "abc")], [("", "abc")], [("abc", None)], [("N", "c")], [("1:a", "bc")]]
    assert len({root(t) for t in tables}) == len(tables)
    # Rows that repeat count, and a value moved between rows shows.
    assert len({root(t) for t in ([("a", "b"), ("c", "d")], [("a", "d"), ("c", "b")], [("a", "b")] * 2, [("a", "b")] * 3)}) == 4


def test_changed_parts_name_where_a_table_differs(spark):
    df = spark.range(300).select("id", (F.col("id") % 5).alias("k"))
    later = df.where("k != 4").withColumn("id", F.when(F.col("id") == 11, -1).otherwise(F.col("id"))).unionByName(
        spark.createDataFrame([(1, None)], "id long, k long"))
    parts = [lineage.fingerprint_parts(d, ["k"]) for d in (df, later)]
    assert rows(lineage.changed_parts(*parts)) == sorted([("1:1", 60, 60), ("1:4", 60, None), ("N", None, 1)], key=repr)
    assert lineage.changed_parts(parts[0], parts[0]).isEmpty()
    moved = lineage.changed_parts(*[lineage.fingerprint_parts(d) for d in (df, df.withColumn("k", F.expr("if(id = 7, 0, k)")))])
    assert 1 <= moved.count() <= 2


def test_train_evaluate_promote_retrain(spark, folder):
    data = [(i, ("n", "s", "e", None)[i % 4], 2015 + i % 8, float(i % 13), float(3 * (i % 13) + i % 5)) for i in range(400)]
    master = spark.createDataFrame(data, "id int, place string, year int, x double, y double")
    spec = SplitSpec("place", "year", ("n",), 2015, 2018, (1, 4))
    features = FeatureSchema((Feature("x", "numeric", impute="median"),))
    job = TrainingJob(spark, folder, "m")
    weak = job.run(master, spec, features, ModelSpec("ridge", {"alpha": 1e6}), "y", RunConfig(1, 1, 1))
    assert weak["promoted"] and weak["new_model_version"] == 1 and weak["production_metric"] is None
    good = job.run(master, spec, features, ModelSpec("ridge"), "y", RunConfig(1, 1, 2))
    assert good["promoted"] and good["candidate_metric"] < good["production_metric"]
    worse = job.run(master, spec, features, ModelSpec("ridge", {"alpha": 1e6}), "y", RunConfig(1, 1, 1))
    assert not worse["promoted"] and worse["new_model_version"] is None
    live = job.store.production("m").first()
    assert (live["version"], live["run_id"]) == (2, good["run_id"])
    found = live["metrics"]
    assert found["master_rows"] == 400 and found["train_rows"] == 300 and "reference_rmsle" in found
    # The test locality has rows of 2015 and 2019 only, so the one-year test is empty.
    assert found["optional_test_count"] == 1 and "recent_4_year_rmsle" in found
    assert not any(k.startswith("recent_1") for k in found)
    assert {"train_fingerprint", "reference_fingerprint", "recent_4_year_fingerprint"} <= set(live["tags"]) and live["params"]["model_type"] == "ridge"
    scored = job.store.load_by_alias("m").predict(master, keep=["id"])
    assert scored.count() == 400
    assert job.store.load_version("m", 1) and rows(job.decisions().select("production")).count((True,)) == 1
    with pytest.raises(ValueError, match="no alias"):
        job.store.load_by_alias("nobody")
    grown = master.unionByName(master.limit(11))
    assert not retrain_decision(job.store, "m", master)["should_retrain"]
    assert retrain_decision(job.store, "m", grown)["should_retrain"]
    assert job.store.gauges().where("metric = 'dataset_new_rows'").count() == 2
    with pytest.raises(ValueError, match="train split is empty"):
        job.run(master.where("place = 'n'"), spec, features, ModelSpec("ridge"), "y", RunConfig(1, 1, 1))
    assert job.store.runs().where("status = 'FAILED'").count() == 1


def test_candidates_train_on_a_stored_master(spark, monkeypatch):
    from tidemark.plans import modelling

    seen = []

    class Job:
        def __init__(self, *_):
            pass

        def run(self, master, *_):
            seen.append(master)

        def decisions(self):
            return seen[-1]

    orders = spark.createDataFrame([(1, 10), (2, 20), (2, 20)], "o_orderkey long, c long")
    customer = spark.createDataFrame([(10, "a"), (20, None)], "c long, locality string")
    monkeypatch.setattr(modelling, "TrainingJob", Job)
    monkeypatch.setattr(modelling, "sales", lambda *_: orders.join(customer, "c"))
    out = modelling.train_eval_promote(spark, "")
    assert len(seen) == 2 and all(m.inputFiles() for m in seen)
    assert sorted(map(tuple, out.collect()), key=repr) == [(10, 1, "a"), (20, 2, None), (20, 2, None)]
    assert set(seen[0].inputFiles()) == set(seen[1].inputFiles())


def test_fingerprint_sums_are_exact_beyond_doubles(spark):
    import hashlib

    texts = [str(k) for k in range(500)]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    digests = [hashlib.md5(f"{len(t)}:{t}".encode()).hexdigest() for t in texts]
    folds = [sum(int(d[at:at + 15], 16) for d in digests) for at in (0, 15)]
    row = df.select(lineage.row_digest([F.col("v")]).alias("d")).agg(*lineage._folds(F.col("d"))).first()
    assert [int(row["fold_a"]), int(row["fold_b"])] == folds
