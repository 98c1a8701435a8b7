"""Retrain policy: has the master grown enough since production was trained?"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame

from tidemark.jobs.store import RunStore
from tidemark.operators import runs as ops


def retrain_decision(
    store: RunStore, model_name: str, master: DataFrame, threshold: int = ops.DEFAULT_THRESHOLD
) -> dict[str, Any]:
    """Decide, and record the dataset gauges. Without production nothing retrains."""
    overview = ops.dataset_overview(
        store.production(model_name), ops.last_rows_per_config(store.runs()), master, threshold
    ).first().asDict()
    store.gauge({
        "dataset_master_rows": overview["master_rows"], "dataset_new_rows": overview["new_rows"],
    })
    return overview
