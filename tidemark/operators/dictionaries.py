"""Dictionaries of any size: distinct values numbered in order without gathering them.

Values are dealt to range partitions, each partition is numbered on its own, and
what stands before it is added from a table with one row per partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.missing import col
from tidemark.session import scratch_path

CODES = "feature string, value string, code bigint"
# A value with more than one row in so many is joined by broadcast; fewer values than this can be so frequent.
HOT_SHARE = 1000


def dense_codes(values: DataFrame, path: str) -> DataFrame:
    """Number the distinct, non-null ``(feature, value)`` of a frame from 0 per feature, by value; stored at ``path``.

    The partitions' sizes, one row per partition and feature it holds, are the
    only thing the driver sees.
    """
    spark = values.sparkSession
    distinct = values.where(F.col("value").isNotNull()).select("feature", "value").distinct()
    dealt = distinct.repartitionByRange("feature", "value").withColumn("part", F.spark_partition_id())
    # Written once: dealing again would draw other boundaries.
    parts = scratch_path(spark, "dictionary-parts")
    dealt.write.parquet(parts)
    stored = spark.read.schema(dealt.schema).parquet(parts)
    before, offsets = {}, []
    for r in sorted(stored.groupBy("feature", "part").agg(F.count("*").alias("n")).collect(), key=lambda r: (r["feature"], r["part"])):
        offsets.append((r["feature"], r["part"], before.get(r["feature"], 0)))
        before[r["feature"]] = offsets[-1][2] + r["n"]
    starts = F.broadcast(spark.createDataFrame(offsets, "feature string, part int, start bigint"))
    place = F.row_number().over(Window.partitionBy("feature", "part").orderBy("value")) - 1
    stored.withColumn("place", place).join(starts, ["feature", "part"]).select(
        "feature", "value", (F.col("start") + F.col("place")).alias("code")).write.mode("overwrite").parquet(path)
    return spark.read.schema(CODES).parquet(path)


@dataclass(frozen=True)
class Dictionary:
    """A feature's part of a stored table of codes."""

    path: str
    size: int

    def codes(self, spark: SparkSession, feature: str) -> DataFrame:
        return spark.read.schema(CODES).parquet(self.path).where(F.col("feature") == feature)


def hot_values(rows: DataFrame, value: Column) -> DataFrame:
    """Values that more than one in ``HOT_SHARE`` of the rows has."""
    counts = rows.groupBy(value.alias("__hot")).agg(F.count("*").alias("n"))
    total = F.broadcast(rows.agg(F.count("*").alias("total")))
    return counts.join(total, F.col("n") * HOT_SHARE > F.col("total")).where("__hot is not null").select("__hot")


def with_codes(df: DataFrame, found: Sequence[tuple[str, str, Dictionary]]) -> DataFrame:
    """Add, per ``(feature, value column, dictionary)``, the column ``__code_<feature>``; null for null and unknown values.

    Neither side is gathered: the join goes by value. Frequent values, fewer
    than ``HOT_SHARE`` of them, are coded by a broadcast before it and travel
    under keys of their own, so that none of them fills a task.
    """
    spark = df.sparkSession
    for feature, value, dictionary in found:
        codes = dictionary.codes(spark, feature).select(F.col("value").alias("__value"), "code")
        hot = codes.join(hot_values(df, col(value)), F.col("__value") == F.col("__hot"), "left_semi")
        name = f"__code_{feature}"
        df = df.join(F.broadcast(hot.withColumnRenamed("code", "__hot_code")), col(value) == F.col("__value"), "left").drop("__value")
        # Coded rows match nothing, wherever they go.
        key = F.when(F.col("__hot_code").isNull(), col(value)).otherwise(F.concat(
            F.lit("\x00"), F.pmod(F.monotonically_increasing_id(), F.lit(4096)).cast("string")))
        df = df.withColumn("__key", key).join(codes, F.col("__key") == F.col("__value"), "left")
        df = df.withColumn(name, F.coalesce("__hot_code", "code")).drop("__value", "__key", "__hot_code", "code")
    return df


def onehot_encoder(spark: SparkSession, codes: dict[str, tuple[str, int]]) -> OneHotEncoderModel:
    """Sparse vectors from code columns: ``{code column: (vector column, size)}``; a code of ``size`` is all zeros."""
    # The encoder learns nothing but the sizes.
    row = spark.createDataFrame([tuple(float(size - 1) for _, size in codes.values())], [*codes])
    return OneHotEncoder(
        inputCols=[*codes], outputCols=[out for out, _ in codes.values()], dropLast=True, handleInvalid="keep").fit(row)
