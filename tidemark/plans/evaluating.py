"""Metrics of simple predictions on lineitem and the sales splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.joins import measured
from tidemark.operators import evaluate, split
from tidemark.plans import query, table
from tidemark.plans.frames import SALES, SPLIT, TAGGED, sales


def metrics_sql(y: str, p: str) -> str:
    gap = f"(ln(1 + greatest({p}, 0)) - ln(1 + greatest({y}, 0)))"
    return (
        f"round(sqrt(avg({gap} * {gap})), 6) AS rmsle, round(avg(abs({y} - {p})), 4) AS mae, "
        f"round(1 - sum(({y} - {p}) * ({y} - {p})) / (count(*) * var_pop({y})), 6) AS r2"
    )


def rounded_metrics(df: DataFrame) -> DataFrame:
    digits = {"rmsle": 6, "mae": 4, "r2": 6}
    return df.withColumns({c: F.round(c, d) for c, d in digits.items() if c in df.columns})


# A price guess that is negative for the smallest quantities.
_GUESS = "(2100 * l_quantity - 5000)"


def _guessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").alias("y"), (2100 * F.col("l_quantity") - 5000).alias("p"),
        "l_returnflag",
    )


_ALL = f"SELECT {metrics_sql('l_extendedprice', _GUESS)} FROM lineitem"


@query(f"SELECT rmsle FROM ({_ALL})")
def metric_rmsle(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _guessed(spark, sf_dir)
    return rounded_metrics(df.agg(evaluate.rmsle(F.col("y"), F.col("p")).alias("rmsle")))


@query(f"SELECT mae FROM ({_ALL})")
def metric_mae(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _guessed(spark, sf_dir)
    return rounded_metrics(df.agg(evaluate.mae(F.col("y"), F.col("p")).alias("mae")))


@query(f"SELECT r2 FROM ({_ALL})")
def metric_r2(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _guessed(spark, sf_dir)
    return rounded_metrics(df.agg(evaluate.r2(F.col("y"), F.col("p")).alias("r2")))


@query(_ALL)
def metrics_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_metrics(evaluate.compute_metrics(_guessed(spark, sf_dir), "y", "p"))


@query(
    f"""WITH {SALES}, {TAGGED},
    means AS (SELECT priority, avg(totalprice) AS prediction FROM tagged WHERE split_name = 'train' GROUP BY 1)
    SELECT split_name, count(*) AS n_rows, {metrics_sql('totalprice', 'prediction')}
    FROM tagged JOIN means USING (priority) GROUP BY split_name"""
)
def eval_by_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model is the mean price per priority, learned on train."""
    rows = sales(spark, sf_dir).select("locality", "o_year", "priority", "totalprice")
    tagged = split.explode_splits(split.tag_splits(rows, SPLIT))
    means = (
        split.train_split(rows, SPLIT).groupBy("priority").agg(F.avg("totalprice").alias("prediction"))
    )
    predicted = tagged.join(measured(means), "priority")
    return rounded_metrics(evaluate.evaluate_by(predicted, "split_name", "totalprice", "prediction"))
