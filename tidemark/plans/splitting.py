"""Locality and period splits on the sales frame."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import split
from tidemark.operators.synth import quarter_label as quarter_text
from tidemark.plans import query, table
from tidemark.plans.frames import IN_TEST, SALES, SPLIT, TAGGED, sales
from tidemark.session import scratch_path
from tidemark.sources.master import write_once

_COLUMNS = ["o_orderkey", "locality", "o_year", "totalprice"]
_PICK = ", ".join(_COLUMNS)


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales(spark, sf_dir).select(*_COLUMNS)


@query(f"WITH {SALES} SELECT {_PICK} FROM sales WHERE NOT {IN_TEST}")
def split_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.train_split(_sales(spark, sf_dir), SPLIT)


@query(f"WITH {SALES} SELECT {_PICK} FROM sales WHERE {IN_TEST} AND o_year BETWEEN 1997 AND 1998")
def split_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.reference_split(_sales(spark, sf_dir), SPLIT)


@query(
    f"WITH {SALES}, {TAGGED} SELECT split_name, {_PICK} FROM tagged WHERE split_name LIKE 'recent%'"
)
def split_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = split.explode_splits(split.tag_splits(_sales(spark, sf_dir), SPLIT))
    return tagged.where(F.col("split_name").isin(SPLIT.recent_names())).select("split_name", *_COLUMNS)


@query(
    f"WITH {SALES}, {TAGGED} SELECT 'master' AS split_name, count(*) AS n_rows FROM sales "
    "UNION ALL SELECT split_name, count(*) FROM tagged GROUP BY 1"
)
def split_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split_counts(split.tag_splits(_sales(spark, sf_dir), SPLIT))


@query(f"WITH {SALES} SELECT {_PICK} FROM sales WHERE {IN_TEST} AND o_year BETWEEN 1997 AND 1998")
def split_reference_frozen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later split with another period still sees the reference frozen first."""
    path = scratch_path(spark, "reference")
    rows = _sales(spark, sf_dir)
    write_once(split.reference_split(rows, SPLIT), path)
    moved = replace(SPLIT, reference_min=1999, reference_max=2000)
    return write_once(split.reference_split(rows, moved), path)[0]


@query(
    """WITH years AS (SELECT DISTINCT year(o_orderdate) AS y FROM orders),
    ranked AS (SELECT y, dense_rank() OVER (ORDER BY y) AS r FROM years),
    first AS (SELECT min(y) AS a, max(y) AS b FROM ranked WHERE r <= 3)
    SELECT o_orderkey, CASE WHEN year(o_orderdate) <= b THEN 'batch_' || a || '_' || b
                            ELSE 'batch_' || year(o_orderdate) END AS batch_name
    FROM orders, first"""
)
def period_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"))
    return split.period_batches(orders, "y", first=3).select("o_orderkey", "batch_name")


@query("SELECT o_orderkey, year(o_orderdate) || '-Q' || quarter(o_orderdate) AS quarter_label FROM orders")
def quarter_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    label = quarter_text(F.year("o_orderdate"), F.quarter("o_orderdate"))
    return orders.select("o_orderkey", label.alias("quarter_label"))
