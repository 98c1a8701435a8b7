"""Run table, registry, promotion and retrain queries on runs derived from part and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import lineage, runs as ops
from tidemark.plans import query, table
from tidemark.plans.frames import REGISTRY, RUNS, registry, runs

_PROD = f"""{RUNS}, {REGISTRY},
prod AS (SELECT name, version, runs.* EXCLUDE (name) FROM aliases JOIN versions USING (name, version)
         JOIN runs USING (run_id))"""


def _production(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    versions, aliases = registry(spark, sf_dir)
    if model is not None:
        aliases = aliases.where(F.col("name") == model)
    return ops.production_lookup(aliases, versions, runs(spark, sf_dir))


@query(
    f"WITH {_PROD} SELECT name, version, run_id, reference_rmsle, "
    "CAST(split_version AS VARCHAR) AS split_version FROM prod"
)
def prod_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _production(spark, sf_dir).select(
        "name", "version", "run_id",
        ops.lookup("metrics", "reference_rmsle").alias("reference_rmsle"),
        ops.lookup("params", "split_version").alias("split_version"),
    )


@query(
    f"WITH {RUNS} SELECT run_id, reference_rmsle AS metric, CAST(feature_version AS VARCHAR) AS param, "
    "type AS tag, NULL::DOUBLE AS absent FROM runs"
)
def run_metric_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs(spark, sf_dir).select(
        "run_id",
        ops.lookup("metrics", "reference_rmsle").alias("metric"),
        ops.lookup("params", "feature_version").alias("param"),
        ops.lookup("tags", "type").alias("tag"),
        ops.lookup("metrics", "no_such_metric").alias("absent"),
    )


@query(f"WITH {RUNS} SELECT run_id, split_version, feature_version, model_version::INTEGER AS model_version FROM runs")
def run_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.run_config(runs(spark, sf_dir))


@query(
    f"""WITH {_PROD}, cur AS (SELECT max(reference_rmsle) AS v FROM prod WHERE name = 'PROMO')
    SELECT run_id, 'reference_rmsle' AS metric_name, reference_rmsle AS candidate_metric,
           v AS production_metric,
           coalesce(CASE WHEN v IS NULL THEN reference_rmsle IS NOT NULL ELSE reference_rmsle < v END, FALSE)
             AS promoted
    FROM runs, cur"""
)
def promotion_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.promotion_decision(runs(spark, sf_dir), _production(spark, sf_dir, "PROMO"))


_LAST = """
last AS (
  SELECT split_version, feature_version, model_version::INTEGER AS model_version, run_id,
         coalesce(CAST(master_rows AS BIGINT), 0) AS last_rows
  FROM (SELECT *, row_number() OVER (PARTITION BY split_version, feature_version, model_version
                                     ORDER BY start_time DESC) AS rn FROM runs) WHERE rn = 1)"""


@query(f"WITH {RUNS}, {_LAST} SELECT * FROM last")
def last_rows_per_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.last_rows_per_config(runs(spark, sf_dir))


@query(
    f"""WITH {RUNS}, {_LAST}, cur AS (SELECT count(*) AS n FROM orders)
    SELECT split_version, feature_version, model_version, n AS master_rows, last_rows,
           n - last_rows AS new_rows, 1000::BIGINT AS threshold, n - last_rows > 1000 AS should_retrain
    FROM last, cur"""
)
def retrain_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = table(spark, sf_dir, "orders").agg(F.count(F.lit(1))).scalar()
    return ops.retrain_decisions(ops.last_rows_per_config(runs(spark, sf_dir)), current, 1000)


@query(
    f"""WITH {_PROD}, {_LAST}, cur AS (SELECT count(*) AS n FROM orders),
    picked AS (SELECT max(last_rows) AS l FROM prod JOIN last USING (split_version, feature_version)
               WHERE name = 'PROMO')
    SELECT n AS master_rows, l AS last_training_rows, n - l AS new_rows, 10::BIGINT AS threshold,
           n - l > 10 AS should_retrain FROM cur, picked"""
)
def dataset_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.dataset_overview(
        _production(spark, sf_dir, "PROMO"),
        ops.last_rows_per_config(runs(spark, sf_dir)),
        table(spark, sf_dir, "orders"),
    )


@query(
    f"WITH {RUNS} SELECT run_id, status, round((end_time - start_time) / 1000.0::DOUBLE, 2) "
    "AS run_duration_seconds, reference_rmsle FROM runs ORDER BY reference_rmsle NULLS LAST, run_id"
)
def leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    board = ops.leaderboard(runs(spark, sf_dir))
    return board.select("run_id", "status", "run_duration_seconds", "reference_rmsle")


@query(
    f"""WITH {RUNS} SELECT run_id, status, epoch_ms(start_time::BIGINT) AS start_time,
       epoch_ms(end_time::BIGINT) AS end_time, reference_rmsle, reference_r2,
       CAST(split_version AS VARCHAR) AS split_version, type FROM runs"""
)
def runs_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = ops.flatten_runs(
        runs(spark, sf_dir), ["reference_rmsle", "reference_r2"], ["split_version"], ["type"]
    )

    def utc(name: str) -> F.Column:
        return F.convert_timezone(None, F.lit("UTC"), F.col(name).cast("timestamp_ntz"))

    return flat.withColumns({c: utc(c) for c in ("start_time", "end_time")})


@query(
    f"""WITH {_PROD}, done AS (SELECT run_id, reference_r2 FROM runs WHERE status = 'FINISHED'),
    best AS (SELECT run_id AS b, reference_r2 AS v FROM done WHERE reference_r2 IS NOT NULL
             ORDER BY reference_r2 DESC, run_id LIMIT 1),
    cur AS (SELECT run_id AS c FROM prod WHERE name = 'PROMO')
    SELECT run_id, round(reference_r2, 6) AS reference_r2, run_id = c AS production, run_id = b AS best,
           CASE WHEN run_id = c THEN round(reference_r2 - v, 4) END AS delta
    FROM done, best, cur"""
)
def runs_best_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    prod_id = _production(spark, sf_dir, "PROMO").agg(F.max("run_id")).scalar()
    flagged = ops.flag_best(runs(spark, sf_dir), "reference_r2", prod_id)
    return flagged.withColumn("reference_r2", F.round("reference_r2", 6))


@query(
    f"""WITH {RUNS} SELECT run_id,
       CASE WHEN reference_rmsle IS NULL THEN 0 ELSE 2 END::INTEGER AS n_metrics, reference_r2,
       strftime(epoch_ms(coalesce(end_time, start_time)::BIGINT), '%Y-%m-%dT%H:%M:%S') ||
         CASE WHEN coalesce(end_time, start_time) % 1000 = 0 THEN ''
              ELSE strftime(epoch_ms(coalesce(end_time, start_time)::BIGINT), '.%f') END || '+00:00'
         AS last_updated_at,
       CAST(split_version AS VARCHAR) AS split_version FROM runs"""
)
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.run_summary(runs(spark, sf_dir)).select(
        "run_id",
        F.size("metrics").alias("n_metrics"),
        ops.lookup("metrics", "reference_r2").alias("reference_r2"),
        "last_updated_at",
        ops.lookup("data_version", "split_version").alias("split_version"),
    )


_STATE = (
    "CASE event_type WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'failed' "
    "WHEN 'view' THEN 'running' ELSE 'queued' END"
)


@query(
    f"""WITH tasks AS (SELECT user_id, {_STATE} AS state FROM events)
    SELECT user_id, count(*) AS total, count(*) FILTER (state = 'success') AS success,
           count(*) FILTER (state = 'running') AS running, count(*) FILTER (state = 'failed') AS failed,
           count(*) FILTER (state IN ('success', 'failed')) AS finished,
           round(count(*) FILTER (state IN ('success', 'failed')) / count(*), 6) AS progress
    FROM tasks GROUP BY user_id"""
)
def run_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    tasks = table(spark, sf_dir, "events").select("user_id", F.expr(_STATE).alias("state"))
    progress = ops.run_progress(tasks, by="user_id")
    return progress.withColumn("progress", F.round("progress", 6))


_KINDS = ("click", "purchase", "view")


@query(
    """WITH last AS (
      SELECT user_id, event_type, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                                     ORDER BY epoch_ms(ts) DESC, event_id DESC) AS rn FROM events)
      WHERE rn = 1),
    state AS (SELECT user_id, event_type AS status FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY epoch_ms(ts) DESC, event_id DESC) AS rn
        FROM events) WHERE rn = 1)
    SELECT 'user_' || user_id AS run_id, any_value(status) AS status, """
    + ", ".join(f"max(CASE WHEN event_type = '{k}' THEN value END) AS {k}" for k in _KINDS)
    + ", count(*)::INTEGER AS n_metrics FROM last JOIN state USING (user_id) GROUP BY user_id"
)
def runs_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user is a run that logs a metric per event type; its status is the last type."""
    events = table(spark, sf_dir, "events")
    entries = F.array(
        F.struct(F.lit("metric").alias("kind"), F.col("event_type").alias("key"),
                 F.col("value").cast("string").alias("value")),
        F.struct(F.lit("attribute").alias("kind"), F.lit("status").alias("key"),
                 F.col("event_type").alias("value")),
    )
    at = F.unix_millis(F.col("ts").cast("timestamp"))
    log = events.select(
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("run_id"),
        F.explode(entries).alias("e"), at.alias("ts"), F.col("event_id").alias("seq"),
    ).select("run_id", "e.kind", "e.key", "e.value", "ts", "seq")
    folded = ops.runs_from_events(log)
    return folded.select(
        "run_id", "status",
        *[ops.lookup("metrics", k).alias(k) for k in _KINDS],
        F.size("metrics").alias("n_metrics"),
    )


@query("SELECT DISTINCT p_type AS experiment_id, 'study_' || lower(p_type) AS name FROM part")
def experiment_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = table(spark, sf_dir, "part").select(
        F.col("p_type").alias("experiment_id"),
        F.concat(F.lit("study_"), F.lower("p_type")).alias("name"),
    )
    return ops.experiment_list(listed)


# Columns of the tables in the order of their names.
_COLUMNS = {
    "customer": "c_acctbal c_custkey c_mktsegment c_name c_nationkey".split(),
    "lineitem": "l_discount l_extendedprice l_linenumber l_linestatus l_orderkey l_partkey l_quantity l_returnflag l_shipdate "
                "l_suppkey l_tax".split(),
    "orders": "o_custkey o_orderdate o_orderkey o_orderpriority o_orderstatus o_totalprice".split(),
}


def _digest(*values: str) -> str:
    texts = [f"coalesce(length({v}::VARCHAR) || ':' || {v}::VARCHAR, 'N')" for v in values]
    return f"md5({' || '.join(texts)})"


def _folds(digest: str) -> str:
    """The two sums of a digest's halves, as text after a separator."""
    return " || ".join(
        f"'|' || coalesce(sum(('0x' || substr({digest}, {start}, 15))::BIGINT), 0)::VARCHAR" for start in (1, 16))


def _parts_sql(name: str, part: str, source: str | None = None) -> str:
    """``(part, n_rows, fingerprint)``; ``part`` may use the row's digest ``d``."""
    rows = f"SELECT *, {_digest(*_COLUMNS[name])} AS d FROM {source or name}"
    return f"SELECT {part} AS part, count(*) AS n_rows, md5(count(*)::VARCHAR || {_folds('d')}) AS fingerprint FROM ({rows}) GROUP BY 1"


def _fingerprint_sql(name: str) -> str:
    leaves = f"SELECT *, {_digest('part', 'n_rows', 'fingerprint')} AS d FROM ({_parts_sql(name, 'substr(d, 1, 2)')})"
    columns = ",".join(_COLUMNS[name])
    return (f"SELECT coalesce(sum(n_rows), 0)::BIGINT AS n_rows, md5('{columns}|' || coalesce(sum(n_rows), 0)::VARCHAR || {_folds('d')}) "
            f"AS fingerprint FROM ({leaves})")


_BY_FLAGS = "length(l_returnflag) || ':' || l_returnflag || '|' || length(l_linestatus) || ':' || l_linestatus"


@query(_fingerprint_sql("lineitem"))
def table_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.fingerprint(table(spark, sf_dir, "lineitem"))


@query(_parts_sql("lineitem", _BY_FLAGS))
def fingerprint_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.fingerprint_parts(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"])


@query(
    """SELECT '1:' || l_linenumber AS part, count(*) AS n_before,
              CASE WHEN l_linenumber = 3 THEN count(*) END AS n_after
    FROM lineitem WHERE l_linenumber IN (3, 5) GROUP BY l_linenumber"""
)
def changed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One part's values change, another part goes: these two are named."""
    lines = table(spark, sf_dir, "lineitem")
    later = lines.where("l_linenumber != 5").withColumn(
        "l_tax", F.when(F.col("l_linenumber") == 3, F.col("l_tax") + 1).otherwise(F.col("l_tax")))
    before, after = (lineage.fingerprint_parts(df, ["l_linenumber"]) for df in (lines, later))
    return lineage.changed_parts(before, after)


@query(" UNION ALL ".join(
    f"SELECT 'run_0' AS run_id, '{name}' AS table_name, * FROM ({_fingerprint_sql(name)})" for name in ("orders", "lineitem", "customer")))
def lineage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.lineage_rows("run_0", {n: table(spark, sf_dir, n) for n in ("orders", "lineitem", "customer")})
