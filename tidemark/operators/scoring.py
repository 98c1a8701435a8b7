"""Prediction categories, confidence histogram, batch scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import Contract, FeatureSchema
from tidemark.functions.buckets import bucket_index, cumulative_counts
from tidemark.operators.contract import split_scoring_input
from tidemark.operators.models import TrainedModel

# Upper bounds of the confidence histogram and default labels.
CONFIDENCE_BOUNDS = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
DEFAULT_LABELS = {3: ("low", "medium", "high"), 4: ("low", "medium", "high", "very_high")}


def parse_thresholds(raw: str | None) -> list[float]:
    """Sorted numbers of a comma list; one unreadable item voids the whole list."""
    items = [part.strip() for part in (raw or "").split(",")]
    try:
        return sorted(float(item) for item in items if item)
    except ValueError:
        return []


def threshold_labels(raw: str | None, buckets: int) -> list[str]:
    """Given labels if their number fits, else the defaults."""
    given = [part.strip() for part in (raw or "").split(",") if part.strip()]
    if len(given) == buckets:
        return given
    return list(DEFAULT_LABELS.get(buckets, [f"bucket_{i}" for i in range(buckets)]))


def threshold_bucket(
    prediction: Column, thresholds: Sequence[float], labels: Sequence[str] | None = None
) -> Column:
    """Label of the bucket; a value on a threshold belongs to the upper bucket."""
    names = list(labels) if labels is not None else threshold_labels(None, len(thresholds) + 1)
    if len(names) != len(thresholds) + 1:
        raise ValueError("need one label more than thresholds")
    index = bucket_index(prediction, [F.lit(float(t)) for t in sorted(thresholds)])
    return F.get(F.array(*[F.lit(n) for n in names]), index)


def prediction_category(
    prediction: Column,
    field: Column | None = None,
    explicit: Column | None = None,
    thresholds: Sequence[float] = (),
    labels: Sequence[str] | None = None,
) -> Column:
    """Category field, else explicit category, else threshold bucket, else ``unknown``."""
    choices = [
        F.nullif(c.cast("string"), F.lit("")) for c in (field, explicit) if c is not None
    ]
    if thresholds:
        choices.append(threshold_bucket(prediction, thresholds, labels))
    return F.coalesce(*choices, F.lit("unknown"))


def predictions_by_category(scored: DataFrame, category: str = "category") -> DataFrame:
    return scored.groupBy(category).agg(F.count(F.lit(1)).alias("n_predictions"))


def cumulative_histogram(
    df: DataFrame, value: str, bounds: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """``(by..., le, n_cumulative)``: rows at or below each bound, ``+Inf`` last.

    One aggregate with a counter per bound, unfolded afterwards.
    """
    counters = [c.alias(f"__b{i}") for i, c in enumerate(cumulative_counts(F.col(value), bounds))]
    total = F.count(value).alias("__all")
    wide = df.groupBy(*by).agg(*counters, total) if by else df.agg(*counters, total)
    rows = [
        F.struct(F.lit(str(b)).alias("le"), F.col(f"__b{i}").alias("n_cumulative"))
        for i, b in enumerate(bounds)
    ]
    rows.append(F.struct(F.lit("+Inf").alias("le"), F.col("__all").alias("n_cumulative")))
    return wide.select(*by, F.inline(F.array(*rows)))


def confidence_histogram(df: DataFrame, confidence: str = "confidence") -> DataFrame:
    return cumulative_histogram(df, confidence, CONFIDENCE_BOUNDS)


def score_batch(
    requests: DataFrame,
    model: TrainedModel,
    contract: Contract,
    keep: Sequence[str],
    category_field: str | None = None,
    thresholds: Sequence[float] = (),
    labels: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Valid requests with prediction and category, and the rejected requests.

    Works on streaming frames too: every step is a projection or a filter.
    Feature columns missing from the requests count as null.
    """
    schema: FeatureSchema = model.features.schema
    valid, rejected = split_scoring_input(requests, schema, contract)
    absent = [n for n in schema.names if n not in requests.columns]
    if absent:
        valid = valid.withColumns({n: F.lit(None).cast("string") for n in absent})
    kept = list(keep)
    for extra in (category_field, "category"):
        if extra and extra in requests.columns and extra not in kept:
            kept.append(extra)
    scored = model.predict(valid, keep=kept)
    category = prediction_category(
        F.col("prediction"),
        F.col(category_field) if category_field in kept else None,
        F.col("category") if "category" in kept else None,
        thresholds, labels,
    )
    return scored.select(*keep, "prediction", category.alias("category")), rejected
