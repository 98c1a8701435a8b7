"""Run log and model registry as append-only tables."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import RunConfig
from tidemark.operators import runs as ops
from tidemark.operators.models import TrainedModel


class RunStore:
    """``events``, ``versions``, ``aliases`` and ``gauges`` tables below one root.

    Every call appends one small file; the tables hold a few rows per run.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._spark = spark
        self._root = root.rstrip("/")

    def _append(self, name: str, rows: list[tuple], schema: str) -> None:
        frame = self._spark.createDataFrame(rows, schema).coalesce(1)
        frame.write.mode("append").parquet(f"{self._root}/{name}")

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self._spark.read.schema(schema).parquet(f"{self._root}/{name}")
        except AnalysisException as error:
            if not (error.getCondition() or "").startswith("PATH_NOT_FOUND"):
                raise
            return self._spark.createDataFrame([], schema)

    # --- runs ---

    def open_run(self, experiment_id: str = "0") -> str:
        run_id = uuid.uuid4().hex
        now = int(time.time() * 1000)
        self.log(run_id, attribute={
            "experiment_id": experiment_id, "status": "RUNNING", "start_time": now,
        })
        return run_id

    def log(
        self,
        run_id: str,
        metric: Mapping[str, Any] | None = None,
        param: Mapping[str, Any] | None = None,
        tag: Mapping[str, Any] | None = None,
        attribute: Mapping[str, Any] | None = None,
    ) -> None:
        """Append entries of a run; later entries win, a None value is no entry."""
        now, seq = int(time.time() * 1000), time.time_ns()
        kinds = {"metric": metric, "param": param, "tag": tag, "attribute": attribute}
        rows = [
            (run_id, kind, key, str(value), now, seq)
            for kind, entries in kinds.items()
            for key, value in (entries or {}).items()
            if value is not None
        ]
        if rows:
            self._append("events", rows, ops.EVENTS_SCHEMA)

    def close_run(self, run_id: str, status: str = "FINISHED") -> None:
        self.log(run_id, attribute={"status": status, "end_time": int(time.time() * 1000)})

    def runs(self) -> DataFrame:
        return ops.runs_from_events(self._read("events", ops.EVENTS_SCHEMA))

    def run_config(self, run_id: str) -> RunConfig:
        row = ops.run_config(self.runs().where(F.col("run_id") == run_id)).first()
        if row is None:
            raise ValueError(f"no run {run_id!r}")
        return RunConfig(row["split_version"], row["feature_version"], row["model_version"])

    # --- registry ---

    def versions(self) -> DataFrame:
        return self._read("versions", ops.MODEL_VERSIONS_SCHEMA)

    def aliases(self) -> DataFrame:
        return self._read("aliases", ops.ALIASES_SCHEMA)

    def production(self, name: str, alias: str = "prod") -> DataFrame:
        aliases = self.aliases().where(F.col("name") == name)
        return ops.production_lookup(aliases, self.versions(), self.runs(), alias)

    def promote(self, name: str, run_id: str, alias: str = "prod") -> int:
        """Register a run as the next version and point the alias at it, unconditionally."""
        version = ops.next_version(self.versions(), name)
        self._append("versions", [(name, version, run_id)], ops.MODEL_VERSIONS_SCHEMA)
        self._append("aliases", [(name, alias, version, time.time_ns())], ops.ALIASES_SCHEMA)
        return version

    def promote_if_better(
        self, name: str, run_id: str, metric: str = ops.REFERENCE_METRIC, higher_is_better: bool = False
    ) -> dict[str, Any]:
        """Promote a run whose reference metric strictly beats production."""
        candidate = self.runs().where(F.col("run_id") == run_id)
        row = ops.promotion_decision(
            candidate, self.production(name), metric, higher_is_better
        ).first()
        if row is None or row["candidate_metric"] is None:
            raise ValueError(f"metric {metric!r} not found in run {run_id!r}")
        decision = {**row.asDict(), "new_model_version": None}
        if row["promoted"]:
            decision["new_model_version"] = self.promote(name, run_id)
        return decision

    # --- models ---

    def model_path(self, run_id: str) -> str:
        return f"{self._root}/models/{run_id}"

    def load_model(self, run_id: str) -> TrainedModel:
        return TrainedModel.load(self._spark, self.model_path(run_id))

    def load_version(self, name: str, version: int) -> TrainedModel:
        row = self.versions().where((F.col("name") == name) & (F.col("version") == version)).first()
        if row is None:
            raise ValueError(f"no version {version} of model {name!r}")
        return self.load_model(row["run_id"])

    def load_by_alias(self, name: str, alias: str = "prod") -> TrainedModel:
        row = self.production(name, alias).first()
        if row is None:
            raise ValueError(f"model {name!r} has no alias {alias!r}")
        return self.load_model(row["run_id"])

    # --- gauges ---

    def gauge(self, values: Mapping[str, float]) -> None:
        """Append one sample per metric, for range queries over time."""
        self._append(
            "gauge_inbox", [(time.time_ns() // 1000, k, float(v)) for k, v in values.items()],
            "micros bigint, metric string, value double",
        )

    def gauges(self) -> DataFrame:
        inbox = self._read("gauge_inbox", "micros bigint, metric string, value double")
        return inbox.select(F.timestamp_micros("micros").alias("ts"), "metric", "value")
