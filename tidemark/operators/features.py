"""Declarative features: learn on train, apply as column expressions.

``fit`` runs a handful of aggregates, whatever the number of features: one count
of category values, means, a few rounds for exact medians, and the scaler
statistics of the imputed and clipped values. What it learns is a small ``FeatureModel``; ``transform`` is a
single projection without any shuffle or Python.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import Feature, FeatureSchema
from tidemark.functions.joins import measured
from tidemark.functions.missing import col, present
from tidemark.functions.quantiles import exact_quantiles
from tidemark.operators.dictionaries import Dictionary, dense_codes, onehot_encoder, with_codes
from tidemark.session import scratch_path

# Up to so many categories of a feature are part of the model and, one-hot, a
# column each; more are a stored table and, one-hot, one sparse vector column.
MAX_CATEGORIES = 10_000

# Library defaults of a constant imputer without a fill value.
DEFAULT_FILL = {"numeric": 0.0, "categorical": "missing_value"}


def extract_xy(df: DataFrame, schema: FeatureSchema, target: str) -> DataFrame:
    """Feature columns in schema order, then the target."""
    missing = [c for c in schema.names if c not in df.columns]
    if missing:
        raise ValueError(f"missing features: {missing}")
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not found")
    return df.select(*[col(c) for c in schema.names], col(target))


def clip(value: Column, lower: float, upper: float) -> Column:
    """Bound a value; missing stays missing."""
    bounded = F.least(F.greatest(value, F.lit(float(lower))), F.lit(float(upper)))
    return F.when(value.isNotNull(), bounded)


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, value, n)`` of several columns in one scan and one shuffle.

    Values travel as text; counts are combined before the shuffle.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), present(df, c).cast("string").alias("value"))
            for c in columns
        ]
    )
    return df.select(F.inline(pairs)).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class FeatureModel:
    """What ``fit`` learned; plain values, JSON-serialisable."""

    schema: FeatureSchema
    fills: Mapping[str, Any] = field(default_factory=dict)
    scales: Mapping[str, tuple[float, float]] = field(default_factory=dict)  # shift, divisor
    categories: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    dictionaries: Mapping[str, Dictionary] = field(default_factory=dict)

    @property
    def output_columns(self) -> list[str]:
        out: list[str] = []
        for f in self.schema.features:
            if f.encoding == "onehot" and f.name not in self.dictionaries:
                out += [f"{f.name}_{c}" for c in self.categories[f.name]]
            else:
                out.append(f.name)
        return out

    def transform(
        self, df: DataFrame, keep: Sequence[str] = (), on_unseen: str = "error"
    ) -> DataFrame:
        """The feature matrix in schema order, after the ``keep`` columns.

        Unseen binary or ordinal values fail the job, or become null with
        ``on_unseen="null"``; an unseen one-hot value is all zeros. Features with
        a stored dictionary are joined with it, all others need no shuffle.
        """
        if on_unseen not in ("error", "null"):
            raise ValueError(f"unsupported on_unseen {on_unseen!r}")
        taken = set(keep) & set(self.output_columns)
        if taken:
            raise ValueError(f"kept columns clash with features: {sorted(taken)}")
        large = [f for f in self.schema.features if f.name in self.dictionaries]
        if large:
            df = df.withColumns({f"__text_{f.name}": _filled_text(df, f, self.fills) for f in large})
            df = with_codes(df, [(f.name, f"__text_{f.name}", self.dictionaries[f.name]) for f in large])
        columns = [col(c) for c in keep]
        for f in self.schema.features:
            columns += self._coded(f, on_unseen) if f in large else self._feature(df, f, on_unseen)
        matrix = df.select(*columns)
        vectors = {f.name: (f"__vector_{f.name}", self.dictionaries[f.name].size) for f in large if f.encoding == "onehot"}
        if not vectors:
            return matrix
        wide = onehot_encoder(df.sparkSession, vectors).transform(matrix)
        return wide.select(*[
            col(vectors[c][0]).alias(c) if c in vectors else col(c) for c in matrix.columns])

    def impute(self, df: DataFrame) -> DataFrame:
        """The frame with fills and clips applied in place, nothing encoded or scaled."""
        return df.withColumns(
            {
                f.name: (_filled_number if f.type == "numeric" else _filled_text)(df, f, self.fills)
                for f in self.schema.features
            }
        )

    def _coded(self, f: Feature, on_unseen: str) -> list[Column]:
        """The code of a feature with a stored dictionary; one-hot, the size stands for none of its values."""
        value, code = col(f"__text_{f.name}"), col(f"__code_{f.name}")
        if f.encoding == "onehot":
            return [F.coalesce(code, F.lit(self.dictionaries[f.name].size)).cast("double").alias(f.name)]
        return [_known(f, value, code, on_unseen)]

    def _feature(self, df: DataFrame, f: Feature, on_unseen: str) -> list[Column]:
        if f.type == "numeric":
            value = _filled_number(df, f, self.fills)
            if f.scaler is not None:
                shift, divisor = self.scales[f.name]
                value = (value - F.lit(shift)) / F.lit(divisor)
            return [value.alias(f.name)]
        value = _filled_text(df, f, self.fills)
        known = self.categories[f.name]
        if f.encoding == "onehot":
            return [
                F.coalesce((value == F.lit(c)).cast("double"), F.lit(0.0)).alias(f"{f.name}_{c}")
                for c in known
            ]
        codes = F.create_map(*[x for i, c in enumerate(known) for x in (F.lit(c), F.lit(float(i)))])
        code = F.try_element_at(codes, value)
        return [_known(f, value, code, on_unseen)]

    def to_json(self) -> str:
        features = [
            {k: v for k, v in vars(f).items() if v is not None} for f in self.schema.features
        ]
        return json.dumps(
            {
                "version": self.schema.version,
                "data_contract": self.schema.data_contract,
                "features": features,
                "fills": dict(self.fills),
                "scales": {k: list(v) for k, v in self.scales.items()},
                "categories": {k: list(v) for k, v in self.categories.items()},
                "dictionaries": {k: vars(v) for k, v in self.dictionaries.items()},
            }
        )

    @classmethod
    def from_json(cls, text: str) -> FeatureModel:
        doc = json.loads(text)
        features = tuple(
            Feature(
                **{k: tuple(v) if isinstance(v, list) else v for k, v in f.items()}
            )
            for f in doc["features"]
        )
        return cls(
            FeatureSchema(features, doc["version"], doc["data_contract"]),
            doc["fills"],
            {k: (v[0], v[1]) for k, v in doc["scales"].items()},
            {k: tuple(v) for k, v in doc["categories"].items()},
            {k: Dictionary(**v) for k, v in doc.get("dictionaries", {}).items()},
        )


def _known(f: Feature, value: Column, code: Column, on_unseen: str) -> Column:
    """The code as a number; a value without one is an error, or null."""
    if on_unseen == "error":
        complaint = F.concat(F.lit(f"feature {f.name}: unknown value "), value)
        code = F.when(value.isNotNull() & code.isNull(), F.raise_error(complaint)).otherwise(code)
    return code.cast("double").alias(f.name)


def _filled_number(df: DataFrame, f: Feature, fills: Mapping[str, Any]) -> Column:
    value = present(df, f.name).cast("double")
    if fills.get(f.name) is not None:
        value = F.coalesce(value, F.lit(float(fills[f.name])))
    if f.clip is not None:
        value = clip(value, *f.clip)
    return value


def _filled_text(df: DataFrame, f: Feature, fills: Mapping[str, Any]) -> Column:
    value = present(df, f.name).cast("string")
    if fills.get(f.name) is not None:
        value = F.coalesce(value, F.lit(str(fills[f.name])))
    return value


def fit(
    df: DataFrame, schema: FeatureSchema, max_categories: int = MAX_CATEGORIES, dictionary_path: str | None = None
) -> FeatureModel:
    """Learn fills, scales and categories from the training frame.

    Features with more than ``max_categories`` values get a dictionary, a table
    at ``dictionary_path`` (a new folder in the shared one if absent) that the
    model needs as long as it is used.

    The feature columns are kept (memory, then disk) while the passes run, so a
    frame behind a join is computed once.
    """
    missing = [c for c in schema.names if c not in df.columns]
    if missing:
        raise ValueError(f"missing features: {missing}")
    narrow = df.select(*[col(c) for c in schema.names])
    kept = df.storageLevel.useMemory or df.storageLevel.useDisk
    if not kept:
        narrow.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fills, categories, dictionaries = _learn_values(narrow, schema, max_categories, dictionary_path)
        fills.update(_learn_centres(narrow, schema))
        scales = _learn_scales(narrow, schema, fills)
    finally:
        if not kept:
            narrow.unpersist()
    return FeatureModel(schema, fills, scales, categories, dictionaries)


def _learn_centres(df: DataFrame, schema: FeatureSchema) -> dict[str, Any]:
    """Means and exact medians of the numeric features that want them."""
    fills: dict[str, Any] = {}
    means = [f.name for f in schema.features if f.impute == "mean"]
    if means:
        averages = [F.avg(present(df, n).cast("double")).alias(f"m_{i}") for i, n in enumerate(means)]
        row = df.agg(*averages).first()
        fills.update({n: row[f"m_{i}"] for i, n in enumerate(means)})
    medians = {f.name: (col(f.name), 0.5) for f in schema.features if f.impute == "median"}
    if medians:
        fills.update(exact_quantiles(df, medians))
    return fills


def _learn_values(
    df: DataFrame, schema: FeatureSchema, limit: int, dictionary_path: str | None
) -> tuple[dict[str, Any], dict[str, tuple[str, ...]], dict[str, Dictionary]]:
    """Constant and most frequent fills, and the categories of the encoders.

    One count of distinct values serves all features.
    """
    fills = {
        f.name: DEFAULT_FILL[f.type] if f.fill_value is None else f.fill_value
        for f in schema.features
        if f.impute == "constant"
    }
    categories = {
        f.name: tuple(str(v) for v in f.order)
        for f in schema.features
        if f.type == "categorical" and f.encoding != "onehot" and f.order is not None
    }
    listed = [f for f in schema.features if f.type == "categorical" and f.name not in categories]
    modes = [f for f in schema.features if f.impute == "most_frequent"]
    counted = list(dict.fromkeys(f.name for f in [*listed, *modes]))
    large: dict[str, Dictionary] = {}
    if not counted:
        return fills, categories, large
    counts = value_counts(df, counted).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if modes:
            fills.update(most_frequent(counts, modes))
        rows: list = []
        if listed:
            # Only the values of features with few of them come to the driver.
            wanted = counts.where(F.col("feature").isin(*[f.name for f in listed]))
            sizes = {r["feature"]: r["n"] for r in wanted.groupBy("feature").agg(F.count("value").alias("n")).collect()}
            many = [f for f in listed if sizes.get(f.name, 0) + 1 > limit and _n_values(f, sizes, fills, counts) > limit]
            few = [f for f in listed if f not in many]
            rows = wanted.where(F.col("feature").isin(*[f.name for f in few])).select("feature", "value").collect() if few else []
            if many:
                path = dictionary_path or scratch_path(df.sparkSession, "dictionaries")
                fillers = [(f.name, str(fills[f.name])) for f in many if _fill_needed(f, fills, counts)]
                values = wanted.where(F.col("feature").isin(*[f.name for f in many])).select("feature", "value")
                if fillers:
                    values = values.unionByName(df.sparkSession.createDataFrame(fillers, "feature string, value string"))
                stored = dense_codes(values, path)
                for r in stored.groupBy("feature").agg(F.count("*").alias("n")).collect():
                    large[r["feature"]] = Dictionary(path, r["n"])
    finally:
        counts.unpersist()
    for f in listed:
        if f.name in large:
            continue
        found = {r["value"] for r in rows if r["feature"] == f.name}
        if None in found:
            found.remove(None)
            if fills.get(f.name) is not None:
                found.add(str(fills[f.name]))
        categories[f.name] = tuple(sorted(found))
    return fills, categories, large


def _fill_needed(f: Feature, fills: Mapping[str, Any], counts: DataFrame) -> bool:
    """Whether the feature has missing cells that a fill turns into a value."""
    if fills.get(f.name) is None:
        return False
    return not counts.where((F.col("feature") == f.name) & F.col("value").isNull()).isEmpty()


def _n_values(f: Feature, sizes: Mapping[str, int], fills: Mapping[str, Any], counts: DataFrame) -> int:
    """Number of categories, a fill that is no value of its own included."""
    n = sizes.get(f.name, 0)
    if not _fill_needed(f, fills, counts):
        return n
    own = counts.where((F.col("feature") == f.name) & (F.col("value") == str(fills[f.name])))
    return n + own.isEmpty()


def most_frequent(counts: DataFrame, features: Sequence[Feature]) -> dict[str, Any]:
    """Most frequent value per feature from ``value_counts``, the smallest one on a tie."""
    numeric = {f.name for f in features if f.type == "numeric"}
    # Numbers must tie-break as numbers, text as text.
    as_number = F.when(F.col("feature").isin(*numeric), F.col("value").cast("double")) if numeric else F.lit(0.0)
    rank = F.struct((-F.col("n")).alias("n"), as_number.alias("d"), F.col("value"))
    wanted = counts.where(F.col("value").isNotNull() & F.col("feature").isin(*[f.name for f in features]))
    best = wanted.groupBy("feature").agg(F.min_by("value", rank).alias("value"))
    found = {r["feature"]: r["value"] for r in best.collect()}  # one row per feature
    return {n: float(v) if n in numeric else v for n, v in found.items()}


def _learn_scales(
    df: DataFrame, schema: FeatureSchema, fills: Mapping[str, Any]
) -> dict[str, tuple[float, float]]:
    scaled = [f for f in schema.features if f.type == "numeric" and f.scaler is not None]
    if not scaled:
        return {}
    aggregates = []
    for i, f in enumerate(scaled):
        value = _filled_number(df, f, fills)
        if f.scaler == "standard":
            pair = (F.avg(value), F.stddev_pop(value))
        else:
            pair = (F.min(value), F.max(value) - F.min(value))
        aggregates += [pair[0].alias(f"a_{i}"), pair[1].alias(f"b_{i}")]
    row = df.agg(*aggregates).first()
    return {
        f.name: (row[f"a_{i}"] or 0.0, row[f"b_{i}"] or 1.0)  # no spread: divide by one
        for i, f in enumerate(scaled)
    }


def target_encode(df: DataFrame, column: str, target: str, out: str) -> DataFrame:
    """Mean target per category, joined back; few categories spare the frame a shuffle."""
    means = df.groupBy(col(column).alias("__c")).agg(F.avg(col(target)).alias(out))
    return df.join(measured(means), col(column).eqNullSafe(F.col("__c")), "left").drop("__c")


def standard_scaled(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """Add population-standardised expressions, lazily, by scalar subqueries."""
    stats = {n: (F.avg(e), F.stddev_pop(e)) for n, e in exprs.items()}
    both = [
        F.struct(a.alias("mean"), s.alias("std")).alias(n) for n, (a, s) in stats.items()
    ]
    learned = df.agg(F.struct(*both).alias("s")).scalar()
    return df.withColumns(
        {
            n: (e - learned.getField(n).getField("mean"))
            / F.when(learned.getField(n).getField("std") == 0, 1.0).otherwise(
                learned.getField(n).getField("std")
            )
            for n, e in exprs.items()
        }
    )


