"""Split, train, evaluate and promote."""

from __future__ import annotations

import time
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import FeatureSchema, ModelSpec, RunConfig, SplitSpec
from tidemark.jobs.store import RunStore
from tidemark.operators import lineage, split
from tidemark.operators.evaluate import as_metric_map, evaluate_by
from tidemark.operators.models import TrainedModel, log_params, train
from tidemark.sources.master import write_once


@dataclass(frozen=True)
class SplitTables:
    train: DataFrame
    reference: DataFrame
    recent: dict[str, DataFrame]  # only the non-empty ones
    counts: dict[str, int]
    reference_created: bool


def run_split(master: DataFrame, spec: SplitSpec, root: str, run_id: str) -> SplitTables:
    """Write every split in one pass; freeze the reference on its first creation."""
    spark = master.sparkSession
    path = f"{root}/splits/v{spec.version}/{run_id}"
    tagged = split.tag_splits(master, spec)
    split.explode_splits(tagged).write.mode("overwrite").partitionBy("split_name").parquet(path)
    written = spark.read.parquet(path)

    def part(name: str) -> DataFrame:
        return written.where(F.col("split_name") == name).drop("split_name")

    rows = {
        r["split_name"]: r["n"]
        for r in written.groupBy("split_name").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    if not rows.get("train"):
        raise ValueError("train split is empty")
    reference, created = write_once(part("reference"), f"{root}/reference/v{spec.version}")
    recent = {n: part(n) for n in spec.recent_names() if rows.get(n)}
    counts = {
        "master_rows": master.count(),
        "train_rows": rows["train"],
        "reference_rows": reference.count(),
        "optional_test_count": len(recent),
        **{f"{n}_rows": rows[n] for n in recent},
    }
    return SplitTables(part("train"), reference, recent, counts, created)


def evaluate_model(model: TrainedModel, tables: SplitTables, target: str) -> dict[str, float]:
    """Metrics on the reference and every recent test, from one grouped aggregate."""
    tests = {"reference": tables.reference, **tables.recent}
    needed = list(dict.fromkeys([*model.features.schema.names, target]))
    named = reduce(
        DataFrame.unionByName,
        [df.select(*needed, F.lit(name).alias("test_name")) for name, df in tests.items()],
    )
    scored = model.predict(named, keep=["test_name", target])
    return as_metric_map(evaluate_by(scored, "test_name", target, "prediction"), "test_name")


class TrainingJob:
    """The whole train → evaluate → promote chain over one store."""

    def __init__(self, spark: SparkSession, root: str, model_name: str) -> None:
        self._spark = spark
        self._root = root.rstrip("/")
        self._name = model_name
        self.store = RunStore(spark, f"{self._root}/tracking")

    def run(
        self,
        master: DataFrame,
        split_spec: SplitSpec,
        features: FeatureSchema,
        spec: ModelSpec,
        target: str,
        config: RunConfig,
    ) -> dict[str, Any]:
        run_id = self.store.open_run()
        try:
            return self._run(run_id, master, split_spec, features, spec, target, config)
        except Exception:
            self.store.close_run(run_id, "FAILED")
            raise

    def _run(
        self, run_id: str, master: DataFrame, split_spec: SplitSpec, features: FeatureSchema,
        spec: ModelSpec, target: str, config: RunConfig,
    ) -> dict[str, Any]:
        started = time.time()
        tables = run_split(master, split_spec, self._root, run_id)
        self.store.log(
            run_id,
            metric=tables.counts,
            param={**vars(config), **log_params(spec), "reference_created": tables.reference_created},
            tag=self._lineage(run_id, tables),
        )
        model, fitted = train(tables.train, features, spec, target)
        model.save(self.store.model_path(run_id))
        measured = evaluate_model(model, tables, target)
        self.store.log(
            run_id, metric={**fitted, **measured, "training_duration": time.time() - started}
        )
        decision = self.store.promote_if_better(self._name, run_id)
        self.store.log(run_id, tag={"promoted": str(decision["promoted"]).lower()})
        self.store.close_run(run_id)
        return decision

    def _lineage(self, run_id: str, tables: SplitTables) -> Mapping[str, str]:
        prints = lineage.lineage_rows(run_id, {"train": tables.train, "reference": tables.reference, **tables.recent})
        return {f"{r['table_name']}_fingerprint": r["fingerprint"] for r in prints.collect()}

    def decisions(self) -> DataFrame:
        """One row per run: configuration, reference metrics, promoted or not, live or not."""
        runs = self.store.runs()
        live = self.store.production(self._name).agg(F.max("run_id")).scalar()
        return runs.select(
            F.col("params")["model_version"].alias("model_version"),
            F.col("params")["model_type"].alias("model_type"),
            F.col("metrics")["train_rows"].cast("bigint").alias("train_rows"),
            F.col("metrics")["reference_rows"].cast("bigint").alias("reference_rows"),
            F.col("metrics")["reference_rmsle"].alias("reference_rmsle"),
            (F.col("tags")["promoted"] == "true").alias("promoted"),
            (F.col("run_id") == live).alias("production"),
        )
