"""Locality and period splits, period batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import SplitSpec
from tidemark.functions.missing import col, present

# Above this many localities the membership test becomes a join.
MAX_INLINE_LOCALITIES = 1000


def _check(df: DataFrame, spec: SplitSpec) -> None:
    for c in (spec.geographic_column, spec.periodic_column):
        if c not in df.columns:
            raise ValueError(f"split column {c!r} not found")


def _in_test(df: DataFrame, spec: SplitSpec) -> tuple[DataFrame, Column]:
    """The frame and a never-null flag: locality is a test locality.

    A null locality is not a test locality, so it stays in train.
    """
    if len(spec.test_localities) <= MAX_INLINE_LOCALITIES:
        inside = col(spec.geographic_column).isin(*spec.test_localities)
        return df, F.coalesce(inside, F.lit(False))
    listed = df.sparkSession.createDataFrame(
        [(v,) for v in dict.fromkeys(spec.test_localities)],
        df.select(F.col(spec.geographic_column).alias("__locality")).schema,
    )
    joined = df.join(listed, col(spec.geographic_column) == F.col("__locality"), "left")
    return joined, F.col("__locality").isNotNull()


def train_split(df: DataFrame, spec: SplitSpec) -> DataFrame:
    """Rows outside the test localities."""
    _check(df, spec)
    flagged, inside = _in_test(df, spec)
    return flagged.where(~inside).select(*[col(c) for c in df.columns])


def reference_split(df: DataFrame, spec: SplitSpec) -> DataFrame:
    """Test localities inside the reference period, both ends included."""
    _check(df, spec)
    flagged, inside = _in_test(df, spec)
    period = present(df, spec.periodic_column)
    kept = flagged.where(inside & period.between(spec.reference_min, spec.reference_max))
    return kept.select(*[col(c) for c in df.columns])


def latest_period(df: DataFrame, spec: SplitSpec) -> Column:
    """Newest period of the whole table, as a scalar subquery."""
    return df.agg(F.max(present(df, spec.periodic_column))).scalar()


def recent_split(df: DataFrame, spec: SplitSpec, duration: int) -> DataFrame:
    """Test localities in the last ``duration`` periods of the whole table."""
    _check(df, spec)
    flagged, inside = _in_test(df, spec)
    period = present(df, spec.periodic_column)
    kept = flagged.where(inside & (period > latest_period(df, spec) - F.lit(duration)))
    return kept.select(*[col(c) for c in df.columns])


def tag_splits(df: DataFrame, spec: SplitSpec) -> DataFrame:
    """Add ``splits``: the names of every split a row belongs to.

    One scan serves all splits; the newest period comes from a subquery that
    reads a single column.
    """
    _check(df, spec)
    flagged, inside = _in_test(df, spec)
    period = present(df, spec.periodic_column)
    tags = [
        F.when(~inside, F.lit("train")),
        F.when(inside & period.between(spec.reference_min, spec.reference_max), F.lit("reference")),
    ]
    if spec.durations:
        newest = latest_period(df, spec)
        tags += [
            F.when(inside & (period > newest - F.lit(d)), F.lit(name))
            for d, name in zip(spec.durations, spec.recent_names())
        ]
    tagged = flagged.withColumn("splits", F.array_compact(F.array(*tags)))
    return tagged.select(*[col(c) for c in df.columns], "splits")


def explode_splits(tagged: DataFrame, out: str = "split_name") -> DataFrame:
    """One row per (row, split) membership."""
    return tagged.withColumn(out, F.explode("splits")).drop("splits")


def split_counts(tagged: DataFrame) -> DataFrame:
    """``(split_name, n_rows)`` plus a ``master`` row with the table size."""
    names = F.concat(F.array(F.lit("master")), F.col("splits"))
    return (
        tagged.select(F.explode(names).alias("split_name"))
        .groupBy("split_name")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def period_batches(df: DataFrame, period: str, first: int = 2) -> DataFrame:
    """Add ``batch_name``: the earliest ``first`` periods together, then one each.

    Only the ``first`` earliest periods are looked up, by a subquery. Rows
    without a period belong to no batch.
    """
    if first < 1:
        raise ValueError("the first batch needs at least one period")
    p = present(df, period).cast("bigint")
    earliest = df.select(p.alias("p")).where(F.col("p").isNotNull()).distinct().orderBy("p").limit(first)
    ends = earliest.agg(F.struct(F.min("p").alias("start"), F.max("p").alias("end"))).scalar()
    start, end = ends.getField("start"), ends.getField("end")
    name = F.when(
        p <= end, F.concat(F.lit("batch_"), start.cast("string"), F.lit("_"), end.cast("string"))
    ).otherwise(F.concat(F.lit("batch_"), p.cast("string")))
    return df.where(p.isNotNull()).withColumn("batch_name", name)


def write_period_batches(batches: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """CSV sink with one folder per batch."""
    chosen = batches if columns is None else batches.select(*[col(c) for c in columns], "batch_name")
    chosen.write.partitionBy("batch_name").option("header", True).csv(path)


def split_overlap(train: DataFrame, reference: DataFrame, key: Sequence[str]) -> DataFrame:
    """Train rows whose key is in a frozen reference (the split may have moved since)."""
    frozen = reference.select(*[col(k) for k in key]).distinct()
    return train.join(frozen, list(key), "left_semi")
