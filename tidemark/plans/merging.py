"""Union, de-duplication and upsert on orders and lineitem."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import merge
from tidemark.plans import query, table

# The batch: the newest orders, and corrected copies of some early ones, once as
# a draft and once as final.
_UPSERT = """
master AS (
  SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'
),
batch AS (
  SELECT o_orderkey, o_orderstatus, o_totalprice, 1 AS seq FROM orders
  WHERE o_orderdate >= TIMESTAMP '2000-01-01'
  UNION ALL
  SELECT o_orderkey, 'D', o_totalprice * 1.5::DOUBLE, 2 FROM orders
  WHERE o_orderdate < TIMESTAMP '1996-01-01' AND o_orderstatus = 'P'
  UNION ALL
  SELECT o_orderkey, 'C', o_totalprice * 2.0::DOUBLE, 3 FROM orders
  WHERE o_orderdate < TIMESTAMP '1996-01-01' AND o_orderstatus = 'P' AND o_totalprice > 100000
)"""


def _day(text: str) -> F.Column:
    return F.lit(text).cast("timestamp_ntz")


def master_and_batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    master = orders.where(F.col("o_orderdate") < _day("2000-01-01")).select(*columns)
    fresh = orders.where(F.col("o_orderdate") >= _day("2000-01-01")).select(*columns, F.lit(1).alias("seq"))
    early = orders.where((F.col("o_orderdate") < _day("1996-01-01")) & (F.col("o_orderstatus") == "P"))

    def corrected(rows: DataFrame, status: str, factor: float, seq: int) -> DataFrame:
        return rows.select(
            "o_orderkey", F.lit(status).alias("o_orderstatus"),
            (F.col("o_totalprice") * factor).alias("o_totalprice"), F.lit(seq).alias("seq"),
        )

    drafts = corrected(early, "D", 1.5, 2)
    finals = corrected(early.where(F.col("o_totalprice") > 100000), "C", 2.0, 3)
    return master, fresh.unionByName(drafts).unionByName(finals)


@query(
    f"WITH {_UPSERT} SELECT * FROM master UNION ALL "
    "SELECT o_orderkey, o_orderstatus, o_totalprice FROM batch"
)
def merge_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    master, batch = master_and_batch(spark, sf_dir)
    return merge.union_all(master, batch.drop("seq").select("o_totalprice", "o_orderkey", "o_orderstatus"))


@query(
    f"""WITH {_UPSERT}, ranked AS (
      SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY seq DESC) AS rn
      FROM (SELECT *, 0 AS seq FROM master UNION ALL SELECT * FROM batch))
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM ranked WHERE rn = 1"""
)
def master_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    master, batch = master_and_batch(spark, sf_dir)
    return merge.upsert(master, batch, ["o_orderkey"], "last", ["seq"])


@query(
    f"""WITH {_UPSERT}
    SELECT (SELECT count(*) FROM master) AS rows_before, (SELECT count(*) FROM batch) AS rows_batch,
           count(DISTINCT o_orderkey) - (SELECT count(*) FROM master) AS rows_added,
           count(DISTINCT o_orderkey) AS rows_after
    FROM (SELECT o_orderkey FROM master UNION ALL SELECT o_orderkey FROM batch)"""
)
def upsert_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    master, batch = master_and_batch(spark, sf_dir)
    return merge.upsert_metrics(master, batch, ["o_orderkey"])


LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_tax"]
LINE_COLUMNS = [*LINE_KEY, "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_tax", "l_shipdate"]


def _deduplicated(spark: SparkSession, sf_dir: str, keep: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)
    return merge.drop_duplicates(lines, LINE_KEY, keep, [F.col(c) for c in LINE_ORDER])


def _dedup_sql(direction: str) -> str:
    order = ", ".join(f"{c} {direction}" for c in LINE_ORDER)
    return (
        f"SELECT {', '.join(LINE_COLUMNS)} FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS rn FROM lineitem) WHERE rn = 1"
    )


@query(_dedup_sql("DESC"))
def dedup_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _deduplicated(spark, sf_dir, "last")


@query(_dedup_sql("ASC"))
def dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _deduplicated(spark, sf_dir, "first")


@query(
    f"SELECT {', '.join(LINE_COLUMNS)} FROM (SELECT *, count(*) OVER "
    "(PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n = 1"
)
def dedup_keep_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _deduplicated(spark, sf_dir, "none")
