"""Contract and schema checks on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import ColumnRule, Contract, Feature, FeatureSchema
from tidemark.operators import contract as check
from tidemark.plans import query, table
from tidemark.plans.frames import SALES, sales
from tidemark.sources.tabular import concat_batch

ORDERS_CONTRACT = Contract(
    columns={
        "o_orderkey": ColumnRule("int", non_nullable=True),
        "o_custkey": ColumnRule("int"),
        "o_orderstatus": ColumnRule("string", allowed_values=("O", "F")),
        "o_totalprice": ColumnRule("float", non_nullable=True, min=0, max=400000),
        "o_orderpriority": ColumnRule("string", format=r"^[1-5]-[A-Z ]+$"),
    },
    primary_key=("o_orderkey",),
    target="o_totalprice",
)


def _union(source: str, rules: list[tuple[str, str, str]]) -> str:
    """One SELECT per rule: the number of rows and of offenders."""
    return " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, '{column}' AS \"column\", count(*) AS n_rows, "
        f"CAST(coalesce(sum(CASE WHEN {bad} THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_bad FROM {source}"
        for rule, column, bad in rules
    )


def _counts(report: DataFrame) -> DataFrame:
    return report.select("rule", "column", "n_rows", "n_bad")


def _kind(df: DataFrame, contract: Contract, *kinds: str) -> DataFrame:
    rules = [r for r in check.contract_rules(df, contract) if r.rule in kinds]
    return _counts(check.rule_report(df, rules, examples=False))


@query(
    _union(
        "orders",
        [
            ("not_null", "o_orderkey", "o_orderkey IS NULL"),
            ("type", "o_orderkey", "FALSE"),
            ("type", "o_custkey", "FALSE"),
            ("type", "o_orderstatus", "FALSE"),
            ("allowed_values", "o_orderstatus", "o_orderstatus NOT IN ('O', 'F')"),
            ("not_null", "o_totalprice", "o_totalprice IS NULL"),
            ("type", "o_totalprice", "FALSE"),
            ("min", "o_totalprice", "o_totalprice < 0"),
            ("max", "o_totalprice", "o_totalprice > 400000"),
            ("type", "o_orderpriority", "FALSE"),
            ("format", "o_orderpriority",
             "NOT regexp_full_match(o_orderpriority, '[1-5]-[A-Z ]+')"),
            ("pk_null", "o_orderkey", "o_orderkey IS NULL"),
        ],
    )
    + " UNION ALL SELECT 'pk_unique', 'o_orderkey', CAST(sum(n) AS BIGINT), "
    "CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) "
    "FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey)"
)
def contract_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").drop("o_orderdate")
    return _counts(check.contract_report(orders, ORDERS_CONTRACT, examples=False))


@query(
    "SELECT rule, \"column\", n_rows, n_rows AS n_bad FROM (SELECT count(*) AS n_rows FROM orders), "
    "(VALUES ('missing_column', 'o_clerk'), ('unexpected_column', 'o_orderdate')) AS p(rule, \"column\")"
)
def contract_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = [*ORDERS_CONTRACT.columns, "o_clerk"]
    return _counts(check.column_report(table(spark, sf_dir, "orders"), expected))


# Customers with gaps: negative balances and one segment are missing, very low
# balances are NaN.
GAPPY = """(SELECT c_custkey, c_name,
  CASE WHEN c_acctbal < -500 THEN 'NaN'::DOUBLE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal,
  NULLIF(c_mktsegment, 'MACHINERY') AS c_mktsegment FROM customer)"""

CUSTOMER_CONTRACT = Contract(
    columns={
        "c_custkey": ColumnRule("int", non_nullable=True),
        "c_name": ColumnRule("string", non_nullable=True),
        "c_acctbal": ColumnRule("float", non_nullable=True, min=1000, max=9000),
        "c_mktsegment": ColumnRule("string", non_nullable=True),
    },
    primary_key=("c_custkey", "c_mktsegment"),
    target="c_acctbal",
)


def gappy_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.col("c_acctbal")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name",
        F.when(balance < -500, F.lit(float("nan"))).when(balance >= 0, balance).alias("c_acctbal"),
        F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("c_mktsegment"),
    )


@query(
    _union(
        GAPPY,
        [
            ("not_null", "c_custkey", "c_custkey IS NULL"),
            ("not_null", "c_name", "c_name IS NULL"),
            ("not_null", "c_acctbal", "c_acctbal IS NULL OR isnan(c_acctbal)"),
            ("not_null", "c_mktsegment", "c_mktsegment IS NULL"),
        ],
    )
)
def contract_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kind(gappy_customers(spark, sf_dir), CUSTOMER_CONTRACT, "not_null")


@query(
    _union(
        GAPPY,
        [
            ("min", "c_acctbal", "NOT isnan(c_acctbal) AND c_acctbal < 1000"),
            ("max", "c_acctbal", "NOT isnan(c_acctbal) AND c_acctbal > 9000"),
        ],
    )
)
def contract_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kind(gappy_customers(spark, sf_dir), CUSTOMER_CONTRACT, "min", "max")


@query(_union(GAPPY, [("pk_null", "c_custkey,c_mktsegment", "c_custkey IS NULL OR c_mktsegment IS NULL")]))
def contract_pk_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kind(gappy_customers(spark, sf_dir), CUSTOMER_CONTRACT, "pk_null")


TEXT_LINES_CONTRACT = Contract(
    columns={
        "l_quantity": ColumnRule("int"),
        "l_extendedprice": ColumnRule("int"),
        "l_tax": ColumnRule("float"),
        "l_returnflag": ColumnRule("float"),
        "l_linenumber": ColumnRule("string"),
    }
)


@query(
    _union(
        "lineitem",
        [
            ("type", "l_quantity", "TRY_CAST(CAST(l_quantity AS VARCHAR) AS DOUBLE) % 1 <> 0"),
            ("type", "l_extendedprice", "TRY_CAST(CAST(l_extendedprice AS VARCHAR) AS DOUBLE) % 1 <> 0"),
            ("type", "l_tax", "TRY_CAST(CAST(l_tax AS VARCHAR) AS DOUBLE) IS NULL"),
            ("type", "l_returnflag", "TRY_CAST(l_returnflag AS DOUBLE) IS NULL"),
            ("type", "l_linenumber", "l_linenumber IS NOT NULL"),
        ],
    )
)
def contract_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = ["l_quantity", "l_extendedprice", "l_tax"]
    lines = table(spark, sf_dir, "lineitem").select(
        *[F.col(c).cast("string").alias(c) for c in text], "l_returnflag", "l_linenumber"
    )
    return _kind(lines, TEXT_LINES_CONTRACT, "type")


LANGUAGE_CONTRACT = Contract(columns={"lang": ColumnRule("string", allowed_values=("en", "fr"))})


@query(
    "SELECT lang AS value, count(*) AS n_rows FROM documents WHERE lang NOT IN ('en', 'fr') GROUP BY 1"
)
def contract_allowed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check.offending_values(
        table(spark, sf_dir, "documents"), LANGUAGE_CONTRACT, "lang", "allowed_values"
    )


PART_CONTRACT = Contract(
    columns={
        "p_name": ColumnRule("string", format=r"^(red|blue|small) \w+$"),
        "p_brand": ColumnRule("string", format=r"^Brand#[0-9]$"),
        "p_size": ColumnRule("int", format=r"[1-4]?\d"),
    }
)


@query(
    _union(
        "part",
        [
            ("format", "p_name", r"NOT regexp_full_match(p_name, '(red|blue|small) \w+')"),
            ("format", "p_brand", "NOT regexp_full_match(p_brand, 'Brand#[0-9]')"),
            ("format", "p_size", r"NOT regexp_full_match(CAST(p_size AS VARCHAR), '[1-4]?\d')"),
        ],
    )
)
def contract_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kind(table(spark, sf_dir, "part"), PART_CONTRACT, "format")


LINE_KEY = ("l_orderkey", "l_linenumber")


@query(
    "SELECT l_orderkey, l_linenumber, count(*) AS n_copies FROM lineitem "
    "GROUP BY ALL HAVING count(*) > 1"
)
def contract_pk_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check.duplicate_keys(table(spark, sf_dir, "lineitem"), LINE_KEY)


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem "
    "WHERE (l_orderkey, l_linenumber) IN (SELECT (l_orderkey, l_linenumber) FROM lineitem "
    "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)"
)
def contract_pk_duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_partkey", "l_suppkey", "l_extendedprice")
    return check.duplicate_rows(lines, LINE_KEY)


_BATCH = """batch AS (
  SELECT 'late.csv' AS file_name, o_orderkey, o_orderstatus, o_totalprice FROM orders
  WHERE o_orderdate >= TIMESTAMP '2000-01-01'
  UNION ALL
  SELECT 'early.csv', o_orderkey, o_orderstatus, o_totalprice FROM orders
  WHERE o_orderdate < TIMESTAMP '2000-01-01'
)"""

BATCH_CONTRACT = Contract(
    columns={
        "o_orderkey": ColumnRule("int", non_nullable=True),
        "o_orderstatus": ColumnRule("string", allowed_values=("O", "F")),
        "o_totalprice": ColumnRule("float", non_nullable=True, max=450000),
    },
    primary_key=("o_orderkey",),
    target="o_totalprice",
)


def _order_files(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Two batch files with different column orders."""
    orders = table(spark, sf_dir, "orders")
    late = F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")
    return {
        "late.csv": orders.where(late).select("o_totalprice", "o_orderstatus", "o_orderkey"),
        "early.csv": orders.where(~late).select("o_orderkey", "o_orderstatus", "o_totalprice"),
    }


@query(f"WITH {_BATCH} SELECT * FROM batch")
def batch_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return concat_batch(_order_files(spark, sf_dir), BATCH_CONTRACT)


@query(
    f"WITH {_BATCH} "
    + " UNION ALL ".join(
        f"SELECT file_name, '{rule}' AS rule, '{column}' AS \"column\", count(*) AS n_rows, "
        f"CAST(sum(CASE WHEN {bad} THEN 1 ELSE 0 END) AS BIGINT) AS n_bad FROM batch GROUP BY 1"
        for rule, column, bad in [
            ("not_null", "o_orderkey", "o_orderkey IS NULL"),
            ("type", "o_orderkey", "FALSE"),
            ("type", "o_orderstatus", "FALSE"),
            ("allowed_values", "o_orderstatus", "o_orderstatus NOT IN ('O', 'F')"),
            ("not_null", "o_totalprice", "o_totalprice IS NULL"),
            ("type", "o_totalprice", "FALSE"),
            ("max", "o_totalprice", "o_totalprice > 450000"),
            ("pk_null", "o_orderkey", "o_orderkey IS NULL"),
        ]
    )
)
def batch_file_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = concat_batch(_order_files(spark, sf_dir), BATCH_CONTRACT)
    rules = check.contract_rules(batch, BATCH_CONTRACT)
    report = check.rule_report(batch, rules, by=["file_name"], examples=False)
    return report.select("file_name", "rule", "column", "n_rows", "n_bad")


SALES_FEATURES = FeatureSchema(
    (
        Feature("acctbal", "numeric"),
        Feature("totalprice", "numeric"),
        Feature("segment", "categorical", impute="most_frequent", encoding="onehot"),
        Feature("priority", "categorical", encoding="ordinal",
                order=("5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH")),
        Feature("status", "categorical", encoding="binary", order=("F", "O")),
        Feature("locality", "numeric"),
    )
)


@query(
    f"WITH {SALES} "
    + _union(
        "sales",
        [
            ("missing_unimputed", "acctbal", "acctbal IS NULL"),
            ("missing_unimputed", "totalprice", "totalprice IS NULL"),
            ("in_order", "priority", "priority NOT IN ('5-LOW', '4-NOT SPECIFIED', '3-MEDIUM', '2-HIGH')"),
            ("missing_unimputed", "priority", "priority IS NULL"),
            ("in_order", "status", "status NOT IN ('F', 'O')"),
            ("missing_unimputed", "status", "status IS NULL"),
            ("numeric", "locality", "TRUE"),
            ("missing_unimputed", "locality", "locality IS NULL"),
        ],
    )
)
def feature_frame_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(check.feature_frame_report(sales(spark, sf_dir), SALES_FEATURES))


REQUEST_CONTRACT = Contract(
    columns={
        "acctbal": ColumnRule("float", min=500, max=9500),
        "segment": ColumnRule("string", allowed_values=("BUILDING", "AUTOMOBILE", "FURNITURE")),
        "priority": ColumnRule("string", format=r"^[1-3]-"),
        "totalprice": ColumnRule("float"),
    }
)
REQUEST_FEATURES = FeatureSchema(
    (
        Feature("acctbal", "numeric", impute="median"),
        Feature("segment", "categorical", encoding="onehot"),
        Feature("priority", "categorical", encoding="binary"),
    )
)


@query(
    f"""WITH {SALES}, checked AS (
      SELECT o_orderkey,
        CASE WHEN acctbal < 500 THEN 'min:acctbal' END AS v1,
        CASE WHEN acctbal > 9500 THEN 'max:acctbal' END AS v2,
        CASE WHEN segment IS NULL THEN 'required:segment' END AS v3,
        CASE WHEN segment NOT IN ('BUILDING', 'AUTOMOBILE', 'FURNITURE')
             THEN 'allowed_values:segment' END AS v4,
        CASE WHEN NOT regexp_matches(priority, '^[1-3]-') THEN 'format:priority' END AS v5
      FROM sales)
    SELECT o_orderkey, concat_ws(' ', v1, v2, v3, v4, v5) AS violations,
           concat_ws('', v1, v2, v3, v4, v5) = '' AS valid FROM checked"""
)
def scoring_input_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = sales(spark, sf_dir)
    rules = check.scoring_rules(requests, REQUEST_FEATURES, REQUEST_CONTRACT)
    return check.flag_rows(requests, rules).select(
        "o_orderkey",
        F.concat_ws(" ", "violations").alias("violations"),
        (F.size("violations") == 0).alias("valid"),
    )
