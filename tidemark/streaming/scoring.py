"""Scoring a stream of requests into two tables: scored rows and rejected rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.config import Contract
from tidemark.operators.models import TrainedModel
from tidemark.operators.scoring import score_batch

# One folder per step of the stream, below the table's folder.
STEP = "step"


def score_stream(
    requests: DataFrame,
    model: TrainedModel,
    contract: Contract,
    keep: Sequence[str],
    path: str,
    checkpoint: str,
    category_field: str | None = None,
    thresholds: Sequence[float] = (),
    labels: Sequence[str] | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Start the stream; ``scored_rows`` and ``rejected_rows`` read its tables.

    Each step writes its rejected rows, then its scored rows, each into the folder of the step, which it replaces. A step
    that is repeated after a crash thus gives its rows once, whatever it had written. A step's rows are kept for its two
    writes, so its source is read once.
    """
    def write(batch: DataFrame, step: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            scored, rejected = score_batch(batch, model, contract, keep, category_field, thresholds, labels)
            rejected.write.mode("overwrite").parquet(f"{path}/rejected/{STEP}={step}")
            scored.write.mode("overwrite").parquet(f"{path}/scored/{STEP}={step}")
        finally:
            batch.unpersist()

    writer = requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def scored_rows(spark: SparkSession, path: str) -> DataFrame:
    """All scored rows, with the step that wrote them."""
    return spark.read.parquet(f"{path}/scored")


def rejected_rows(spark: SparkSession, path: str) -> DataFrame:
    """All rejected rows with the rules they break, and the step that wrote them."""
    return spark.read.parquet(f"{path}/rejected")
