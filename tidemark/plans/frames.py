"""Derived frames several queries share, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import SplitSpec
from tidemark.plans import table

# Orders with the customer's locality and attributes. Negative balances and one
# segment count as missing; one nation has no locality name.
SALES = """
sales AS (
  SELECT o_orderkey, NULLIF(n_name, 'NATION_5') AS locality,
         CAST(year(o_orderdate) AS BIGINT) AS o_year,
         CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS acctbal,
         NULLIF(c_mktsegment, 'MACHINERY') AS segment,
         o_orderpriority AS priority, o_orderstatus AS status, o_totalprice AS totalprice
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.select(
        "o_orderkey",
        F.nullif(F.col("n_name"), F.lit("NATION_5")).alias("locality"),
        F.year("o_orderdate").cast("bigint").alias("o_year"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("acctbal"),
        F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("segment"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("totalprice"),
    )


SPLIT = SplitSpec(
    geographic_column="locality",
    periodic_column="o_year",
    test_localities=("NATION_3", "NATION_7", "NATION_12"),
    reference_min=1997,
    reference_max=1998,
    durations=(1, 2),
)
IN_TEST = "coalesce(locality IN ('NATION_3', 'NATION_7', 'NATION_12'), FALSE)"

# The split memberships, one row per (row, split).
TAGGED = f"""
tagged AS (
  SELECT 'train' AS split_name, * FROM sales WHERE NOT {IN_TEST}
  UNION ALL
  SELECT 'reference', * FROM sales WHERE {IN_TEST} AND o_year BETWEEN 1997 AND 1998
  UNION ALL
  SELECT 'recent_1_o_year', * FROM sales
  WHERE {IN_TEST} AND o_year > (SELECT max(o_year) FROM sales) - 1
  UNION ALL
  SELECT 'recent_2_o_year', * FROM sales
  WHERE {IN_TEST} AND o_year > (SELECT max(o_year) FROM sales) - 2
)"""

# One training run per part: several runs share a configuration, a brand logs no
# metrics at all, large parts did not finish.
RUNS = """
runs AS (
  SELECT 'run_' || p_partkey AS run_id, p_partkey, p_type AS experiment_id,
         CASE WHEN p_size > 45 THEN 'FAILED' WHEN p_size > 42 THEN 'RUNNING'
              ELSE 'FINISHED' END AS status,
         1700000000000 + p_partkey * 60000 AS start_time,
         CASE WHEN p_size > 45 OR p_size <= 42
              THEN 1700000000000 + p_partkey * 60000 + p_size * 1234 END AS end_time,
         CASE WHEN p_brand <> 'Brand#13' THEN p_retailprice / 1000 END AS reference_rmsle,
         CASE WHEN p_brand <> 'Brand#13' THEN 1 - p_size / 100.0::DOUBLE END AS reference_r2,
         CASE WHEN p_brand <> 'Brand#13' THEN p_size * 300.0::DOUBLE END AS master_rows,
         CAST(p_size AS INTEGER) AS split_version,
         CAST(substr(p_brand, 7) AS INTEGER) AS feature_version,
         1 AS model_version, p_type AS type, p_name AS name
  FROM part
)"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    size = F.col("p_size")
    start = F.lit(1700000000000) + F.col("p_partkey") * 60000
    logged = F.col("p_brand") != "Brand#13"
    metrics = F.create_map(
        F.lit("reference_rmsle"), F.col("p_retailprice") / 1000,
        F.lit("reference_r2"), 1 - size / 100.0,
        F.lit("master_rows"), size * 300.0,
    )
    nothing = F.map_filter(metrics, lambda k, v: F.lit(False))
    return part.select(
        F.concat(F.lit("run_"), F.col("p_partkey").cast("string")).alias("run_id"),
        F.col("p_type").alias("experiment_id"),
        F.when(size > 45, "FAILED").when(size > 42, "RUNNING").otherwise("FINISHED").alias("status"),
        start.alias("start_time"),
        F.when((size > 45) | (size <= 42), start + size * 1234).alias("end_time"),
        F.when(logged, metrics).otherwise(nothing).alias("metrics"),
        F.create_map(
            F.lit("split_version"), size.cast("string"),
            F.lit("feature_version"), F.substring("p_brand", 7, 10),
            F.lit("model_version"), F.lit("1"),
        ).alias("params"),
        F.create_map(F.lit("type"), F.col("p_type"), F.lit("name"), F.col("p_name")).alias("tags"),
    )


# Every finished run is a registered version; small parts were promoted in turn.
REGISTRY = """
versions AS (
  SELECT experiment_id AS name, p_partkey AS version, run_id FROM runs WHERE status = 'FINISHED'
),
aliases AS (
  SELECT experiment_id AS name, max(p_partkey) AS version FROM runs
  WHERE status = 'FINISHED' AND split_version <= 10 GROUP BY 1
)"""


def registry(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``(model_versions, aliases)``."""
    part = table(spark, sf_dir, "part").where(F.col("p_size") <= 42)
    versions = part.select(
        F.col("p_type").alias("name"), F.col("p_partkey").alias("version"),
        F.concat(F.lit("run_"), F.col("p_partkey").cast("string")).alias("run_id"),
    )
    aliases = part.where(F.col("p_size") <= 10).select(
        F.col("p_type").alias("name"), F.lit("prod").alias("alias"),
        F.col("p_partkey").alias("version"), F.col("p_partkey").alias("ts"),
    )
    return versions, aliases
