"""Prediction categories and confidence histogram."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import scoring
from tidemark.plans import query, table

THRESHOLDS = (100000.0, 250000.0, 400000.0)

_BUCKET = (
    "CASE WHEN o_totalprice >= 400000 THEN 'very_high' WHEN o_totalprice >= 250000 THEN 'high' "
    "WHEN o_totalprice >= 100000 THEN 'medium' ELSE 'low' END"
)
_CATEGORY = f"""
categorised AS (
  SELECT o_orderkey, coalesce(NULLIF(CASE o_orderstatus WHEN 'P' THEN '' WHEN 'F' THEN NULL ELSE o_orderstatus END, ''),
                  CASE WHEN o_orderpriority = '1-URGENT' THEN 'urgent'
                       WHEN o_orderpriority <> '2-HIGH' THEN NULL END,
                  {_BUCKET}) AS category
  FROM orders)"""


def _categorised(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    field = F.when(status == "P", "").when(status != "F", status)
    explicit = F.when(priority == "1-URGENT", "urgent").when(priority == "2-HIGH", "")
    category = scoring.prediction_category(F.col("o_totalprice"), field, explicit, THRESHOLDS)
    return table(spark, sf_dir, "orders").select("o_orderkey", category.alias("category"))


@query(f"WITH {_CATEGORY} SELECT * FROM categorised")
def prediction_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _categorised(spark, sf_dir)


@query(f"WITH {_CATEGORY} SELECT category, count(*) AS n_predictions FROM categorised GROUP BY 1")
def predictions_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.predictions_by_category(_categorised(spark, sf_dir))


@query(
    """SELECT l_orderkey, l_linenumber,
       CASE WHEN l_quantity >= 30 THEN 'high' WHEN l_quantity >= 10 THEN 'medium' ELSE 'low' END AS bucket
    FROM lineitem"""
)
def threshold_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities hit both thresholds exactly; those rows belong to the upper bucket."""
    bucket = scoring.threshold_bucket(F.col("l_quantity"), scoring.parse_thresholds("30, 10"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", bucket.alias("bucket"))


@query(
    " UNION ALL ".join(
        f"SELECT '{b}' AS le, count(*) FILTER (c <= {b}::DOUBLE) AS n_cumulative "
        "FROM (SELECT 1.0::DOUBLE - l_quantity / 60.0::DOUBLE AS c FROM lineitem)"
        for b in scoring.CONFIDENCE_BOUNDS
    )
    + " UNION ALL SELECT '+Inf', count(*) FROM lineitem"
)
def confidence_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = table(spark, sf_dir, "lineitem").select((1.0 - F.col("l_quantity") / 60.0).alias("confidence"))
    return scoring.confidence_histogram(scored)
