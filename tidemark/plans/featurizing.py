"""Feature transforms on the sales frame, lineitem and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import Feature, FeatureSchema
from tidemark.operators import features as feat
from tidemark.operators.ordered import forward_fill
from tidemark.plans import query, table
from tidemark.plans.frames import SALES, sales

PRIORITIES = ("5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT")
_MODE = (
    "(SELECT segment FROM sales WHERE segment IS NOT NULL GROUP BY segment "
    "ORDER BY count(*) DESC, segment LIMIT 1)"
)


def _fit_transform(df: DataFrame, key: list[str], *features: Feature) -> DataFrame:
    model = feat.fit(df, FeatureSchema(features))
    return model.transform(df, keep=key)


def _imputed(spark: SparkSession, sf_dir: str, *features: Feature) -> DataFrame:
    df = sales(spark, sf_dir)
    model = feat.fit(df, FeatureSchema(features))
    return model.impute(df).select("o_orderkey", *[f.name for f in features])


@query(f"WITH {SALES} SELECT acctbal, segment, priority, totalprice FROM sales")
def extract_xy(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = FeatureSchema(
        (
            Feature("acctbal", "numeric", impute="median"),
            Feature("segment", "categorical", impute="most_frequent", encoding="onehot"),
            Feature("priority", "categorical", encoding="ordinal", order=PRIORITIES),
        )
    )
    return feat.extract_xy(sales(spark, sf_dir), schema, "totalprice")


@query(
    f"WITH {SALES} SELECT o_orderkey, round(coalesce(acctbal, (SELECT avg(acctbal) FROM sales)), 6) "
    "AS acctbal FROM sales"
)
def impute_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = _imputed(spark, sf_dir, Feature("acctbal", "numeric", impute="mean"))
    return filled.select("o_orderkey", F.round("acctbal", 6).alias("acctbal"))


@query(
    f"WITH {SALES} SELECT o_orderkey, round(coalesce(acctbal, (SELECT median(acctbal) FROM sales)), 6) "
    "AS acctbal FROM sales"
)
def impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = _imputed(spark, sf_dir, Feature("acctbal", "numeric", impute="median"))
    return filled.select("o_orderkey", F.round("acctbal", 6).alias("acctbal"))


@query(f"WITH {SALES} SELECT o_orderkey, coalesce(segment, {_MODE}) AS segment FROM sales")
def impute_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    mode = Feature("segment", "categorical", impute="most_frequent", encoding="onehot")
    return _imputed(spark, sf_dir, mode)


@query(
    f"WITH {SALES} SELECT o_orderkey, coalesce(acctbal, 0) AS acctbal, "
    "coalesce(segment, 'missing_value') AS segment, coalesce(locality, 'nowhere') AS locality FROM sales"
)
def impute_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _imputed(
        spark, sf_dir,
        Feature("acctbal", "numeric", impute="constant"),
        Feature("segment", "categorical", impute="constant", encoding="onehot"),
        Feature("locality", "categorical", impute="constant", fill_value="nowhere", encoding="onehot"),
    )


@query(
    f"WITH {SALES} SELECT o_orderkey, CASE WHEN acctbal IS NOT NULL "
    "THEN least(greatest(acctbal, 1000.0::DOUBLE), 8000.0::DOUBLE) END AS acctbal FROM sales"
)
def clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fit_transform(
        sales(spark, sf_dir), ["o_orderkey"], Feature("acctbal", "numeric", clip=(1000, 8000))
    )


_FILLED = f"""{SALES}, filled AS (
  SELECT o_orderkey, totalprice,
         least(greatest(coalesce(acctbal, (SELECT avg(acctbal) FROM sales)), 1000.0::DOUBLE),
               8000.0::DOUBLE) AS x
  FROM sales)"""


@query(
    f"WITH {_FILLED} SELECT o_orderkey, round((x - (SELECT avg(x) FROM filled)) / "
    "(SELECT stddev_pop(x) FROM filled), 6) AS acctbal FROM filled"
)
def scale_standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = _fit_transform(
        sales(spark, sf_dir), ["o_orderkey"],
        Feature("acctbal", "numeric", impute="mean", clip=(1000, 8000), scaler="standard"),
    )
    return scaled.select("o_orderkey", F.round("acctbal", 6).alias("acctbal"))


@query(
    f"WITH {_FILLED} SELECT o_orderkey, round((totalprice - (SELECT min(totalprice) FROM filled)) / "
    "(SELECT max(totalprice) - min(totalprice) FROM filled), 6) AS totalprice FROM filled"
)
def scale_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = _fit_transform(
        sales(spark, sf_dir), ["o_orderkey"], Feature("totalprice", "numeric", scaler="minmax")
    )
    return scaled.select("o_orderkey", F.round("totalprice", 6).alias("totalprice"))


@query(
    "SELECT l_orderkey, l_linenumber, CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END::DOUBLE AS l_linestatus "
    "FROM lineitem"
)
def encode_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fit_transform(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"],
        Feature("l_linestatus", "categorical", encoding="binary"),
    )


@query(
    "SELECT o_orderkey, (list_position(['5-LOW', '4-NOT SPECIFIED', '3-MEDIUM', '2-HIGH', '1-URGENT'], "
    "o_orderpriority) - 1)::DOUBLE AS o_orderpriority FROM orders"
)
def encode_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fit_transform(
        table(spark, sf_dir, "orders"), ["o_orderkey"],
        Feature("o_orderpriority", "categorical", encoding="ordinal", order=PRIORITIES),
    )


_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD")


def _onehot_sql(value: str) -> str:
    return ", ".join(
        f"CASE WHEN {value} = '{s}' THEN 1.0 ELSE 0.0 END::DOUBLE AS segment_{s}" for s in _SEGMENTS
    )


@query(f"WITH {SALES} SELECT o_orderkey, {_onehot_sql('segment')} FROM sales")
def encode_onehot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fit_transform(
        sales(spark, sf_dir), ["o_orderkey"], Feature("segment", "categorical", encoding="onehot")
    )


MATRIX = FeatureSchema(
    (
        Feature("acctbal", "numeric", impute="median", clip=(0, 9000), scaler="standard"),
        Feature("totalprice", "numeric", scaler="minmax"),
        Feature("priority", "categorical", impute="most_frequent", encoding="ordinal", order=PRIORITIES),
        Feature("segment", "categorical", impute="most_frequent", encoding="onehot"),
        Feature("status", "categorical", encoding="binary"),
        Feature("o_year", "numeric"),
    )
)


@query(
    f"""WITH {SALES}, filled AS (
      SELECT o_orderkey, totalprice, priority, status, o_year,
             least(coalesce(acctbal, (SELECT median(acctbal) FROM sales)), 9000.0::DOUBLE) AS x,
             coalesce(segment, {_MODE}) AS seg
      FROM sales),
    stats AS (SELECT avg(x) AS m, stddev_pop(x) AS s, min(totalprice) AS lo, max(totalprice) AS hi FROM filled)
    SELECT o_orderkey, round((x - m) / s, 6) AS acctbal,
           round((totalprice - lo) / (hi - lo), 6) AS totalprice,
           (list_position(['5-LOW', '4-NOT SPECIFIED', '3-MEDIUM', '2-HIGH', '1-URGENT'], priority) - 1)::DOUBLE
             AS priority,
           {_onehot_sql('seg')},
           (list_position(['F', 'O', 'P'], status) - 1)::DOUBLE AS status,
           o_year::DOUBLE AS o_year
    FROM filled, stats"""
)
def feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = sales(spark, sf_dir)
    model = feat.fit(df, MATRIX)
    matrix = model.transform(df, keep=["o_orderkey"])
    rounded = {c: F.round(c, 6) for c in ("acctbal", "totalprice")}
    return matrix.withColumns(rounded)


@query(
    f"WITH {SALES} SELECT o_orderkey, round((ln(1 + totalprice) - (SELECT avg(ln(1 + totalprice)) FROM sales)) "
    "/ (SELECT stddev_pop(ln(1 + totalprice)) FROM sales), 6) AS log_price FROM sales"
)
def log1p_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = sales(spark, sf_dir).select("o_orderkey", "totalprice")
    scaled = feat.standard_scaled(df, {"log_price": F.log1p("totalprice")})
    return scaled.select("o_orderkey", F.round("log_price", 6).alias("log_price"))


@query(
    """SELECT event_id, user_id, last_value(CASE WHEN event_type <> 'error' THEN value END IGNORE NULLS)
         OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
         AS value
    FROM events"""
)
def ffill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error events carry no reading; the user's latest earlier one stands in."""
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "ts", F.when(F.col("event_type") != "error", F.col("value")).alias("value")
    )
    filled = forward_fill(events, ["value"], by=["user_id"], order=["ts", "event_id"])
    return filled.select("event_id", "user_id", "value")


@query(
    f"""WITH {SALES}
    SELECT o_orderkey, round(avg(totalprice) OVER (PARTITION BY segment), 4) AS segment_mean FROM sales"""
)
def target_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = feat.target_encode(sales(spark, sf_dir), "segment", "totalprice", "segment_mean")
    return encoded.select("o_orderkey", F.round("segment_mean", 4).alias("segment_mean"))
