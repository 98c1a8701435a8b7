"""Run table, model registry, promotion and retrain decisions.

``runs``: run_id, experiment_id, status, start_time and end_time (epoch ms),
metrics map<string,double>, params map<string,string>, tags map<string,string>.
``model_versions``: name, version, run_id. ``aliases``: name, alias, version, ts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import RunConfig
from tidemark.functions.missing import col

RUNS_SCHEMA = (
    "run_id string, experiment_id string, status string, start_time bigint, end_time bigint, "
    "metrics map<string,double>, params map<string,string>, tags map<string,string>"
)
MODEL_VERSIONS_SCHEMA = "name string, version bigint, run_id string"
ALIASES_SCHEMA = "name string, alias string, version bigint, ts bigint"
EVENTS_SCHEMA = "run_id string, kind string, key string, value string, ts bigint, seq bigint"

CONFIG_KEYS = ("split_version", "feature_version", "model_version")

# What a run summary shows.
KEY_METRICS = (
    "reference_rmsle", "reference_mae", "reference_r2", "train_rmsle", "train_mae", "train_r2",
)
LINEAGE_KEYS = ("raw_data_version", "reference_version", "split_version", "dataset_hash", "batch_id")

REFERENCE_METRIC = "reference_rmsle"
DEFAULT_THRESHOLD = 10


def lookup(mapping: str, key: str) -> Column:
    """Map entry, null if absent."""
    return F.try_element_at(F.col(mapping), F.lit(key))


def metric(name: str) -> Column:
    """A logged metric with NaN folded to null."""
    return F.nanvl(lookup("metrics", name), F.lit(None).cast("double"))


# --- registry --------------------------------------------------------------


def current_aliases(aliases: DataFrame) -> DataFrame:
    """The newest version of each (model, alias) in an append-only alias log."""
    return aliases.groupBy("name", "alias").agg(
        F.max_by("version", F.struct("ts", "version")).alias("version")
    )


def production_lookup(
    aliases: DataFrame, versions: DataFrame, runs: DataFrame, alias: str = "prod"
) -> DataFrame:
    """Alias → version → run, with the run's metrics and params; empty without alias."""
    wanted = current_aliases(aliases.where(F.col("alias") == alias))
    return (
        wanted.join(versions, ["name", "version"])
        .join(runs.select("run_id", "status", "start_time", "end_time", "metrics", "params", "tags"), "run_id")
        .select("name", "alias", "version", "run_id", "status", "start_time", "end_time",
                "metrics", "params", "tags")
    )


def run_config(runs: DataFrame) -> DataFrame:
    """The configuration versions of each run; a missing key fails the job."""
    columns = []
    for key in CONFIG_KEYS:
        value = lookup("params", key)
        complaint = F.concat(F.lit(f"run lacks parameter {key}: "), F.col("run_id"))
        columns.append(
            F.when(value.isNull(), F.raise_error(complaint)).otherwise(value).cast("int").alias(key)
        )
    return runs.select("run_id", *columns)


# --- promotion -------------------------------------------------------------


def is_better(candidate: Column, production: Column, higher_is_better: bool = False) -> Column:
    """Strictly better; no production value always loses, a missing candidate never wins."""
    wins = (candidate > production) if higher_is_better else (candidate < production)
    return F.coalesce(F.when(production.isNull(), candidate.isNotNull()).otherwise(wins), F.lit(False))


def promotion_decision(
    candidates: DataFrame, production: DataFrame, metric_name: str = REFERENCE_METRIC,
    higher_is_better: bool = False,
) -> DataFrame:
    """Compare every candidate run with the production run.

    ``production`` is ``production_lookup`` output of one model (at most one row).
    """
    current = production.select(metric(metric_name).alias("v")).agg(F.max("v")).scalar()
    out = candidates.select(
        "run_id",
        F.lit(metric_name).alias("metric_name"),
        metric(metric_name).alias("candidate_metric"),
        current.alias("production_metric"),
    )
    return out.withColumn(
        "promoted", is_better(F.col("candidate_metric"), F.col("production_metric"), higher_is_better)
    )


def next_version(versions: DataFrame, name: str) -> int:
    newest = versions.where(F.col("name") == name).agg(F.max("version").alias("v")).first()["v"]
    return 1 if newest is None else newest + 1


# --- retrain policy --------------------------------------------------------


def last_rows_per_config(
    runs: DataFrame, metric_name: str = "master_rows", experiment_id: str | None = None
) -> DataFrame:
    """Newest run of each configuration, of one experiment if named, and the master rows it was trained on (0 if unlogged)."""
    if experiment_id is not None:
        runs = runs.where(F.col("experiment_id") == experiment_id)
    typed = runs.select(
        *[lookup("params", k).cast("int").alias(k) for k in CONFIG_KEYS],
        F.struct("start_time", "run_id").alias("at"),
        F.struct(lookup("metrics", metric_name).alias("v"), "run_id").alias("run"),
    )
    newest = typed.groupBy(*CONFIG_KEYS).agg(F.max_by("run", "at").alias("run"))
    return newest.select(
        *CONFIG_KEYS,
        F.col("run.run_id").alias("run_id"),
        F.coalesce(F.col("run.v").cast("bigint"), F.lit(0).cast("bigint")).alias("last_rows"),
    )


def last_rows_for(
    runs: DataFrame, config: RunConfig, metric_name: str = "master_rows", experiment_id: str | None = None
) -> Column:
    """Scalar: master rows of the newest run with this configuration, of one experiment if named, 0 without one."""
    same = runs if experiment_id is None else runs.where(F.col("experiment_id") == experiment_id)
    for key in CONFIG_KEYS:
        same = same.where(lookup("params", key) == F.lit(str(getattr(config, key))))
    newest = same.agg(
        F.max_by(F.struct(lookup("metrics", metric_name).alias("v")), F.struct("start_time", "run_id"))
        .getField("v").cast("bigint")
    )
    return F.coalesce(newest.scalar(), F.lit(0).cast("bigint"))


def retrain_columns(current: Column, last: Column, threshold: int = DEFAULT_THRESHOLD) -> list[Column]:
    """New rows since the last training and the strict threshold test."""
    return [
        (current - last).alias("new_rows"),
        F.lit(threshold).cast("bigint").alias("threshold"),
        ((current - last) > threshold).alias("should_retrain"),
    ]


def retrain_decisions(
    last_rows: DataFrame, current_rows: Column, threshold: int = DEFAULT_THRESHOLD
) -> DataFrame:
    """Decision per configuration for a given current master size."""
    return last_rows.select(
        *CONFIG_KEYS, current_rows.cast("bigint").alias("master_rows"), "last_rows",
        *retrain_columns(current_rows, F.col("last_rows"), threshold),
    )


def dataset_overview(
    production: DataFrame, last_rows: DataFrame, master: DataFrame,
    threshold: int = DEFAULT_THRESHOLD,
) -> DataFrame:
    """One row: master rows, last training rows, new rows, threshold, decision.

    Without a production model all counts are zero and nothing retrains.
    """
    keyed = production.select(*[lookup("params", k).cast("int").alias(k) for k in CONFIG_KEYS])
    joined = keyed.join(last_rows, list(CONFIG_KEYS), "left")
    base = joined.agg(
        F.count(F.lit(1)).alias("models"), F.max(F.coalesce("last_rows", F.lit(0))).alias("last")
    )
    rows = master.agg(F.count(F.lit(1))).scalar()
    exists = F.col("models") > 0
    zero = F.lit(0).cast("bigint")
    counted = base.select(
        "models",
        F.when(exists, rows).otherwise(zero).alias("master_rows"),
        F.when(exists, F.col("last")).otherwise(zero).alias("last_training_rows"),
    )
    return counted.select(
        "master_rows", "last_training_rows",
        (F.col("master_rows") - F.col("last_training_rows")).alias("new_rows"),
        F.lit(threshold).cast("bigint").alias("threshold"),
        (exists & ((F.col("master_rows") - F.col("last_training_rows")) > threshold)).alias("should_retrain"),
    )


# --- run listing -----------------------------------------------------------


def leaderboard(runs: DataFrame, metric_name: str = REFERENCE_METRIC) -> DataFrame:
    """Runs by metric, missing last, with the duration in seconds."""
    duration = F.round((F.col("end_time") - F.col("start_time")) / 1000, 2)
    return runs.select(
        "run_id", "status", "start_time", "end_time",
        duration.alias("run_duration_seconds"),
        metric(metric_name).alias(metric_name),
        "metrics", "params", "tags",
    ).orderBy(F.col(metric_name).asc_nulls_last(), "run_id")


def flatten_runs(
    runs: DataFrame, metrics: Sequence[str] = (), params: Sequence[str] = (), tags: Sequence[str] = ()
) -> DataFrame:
    """Map entries as columns, epoch milliseconds as timestamps."""
    return runs.select(
        "run_id", "status",
        F.timestamp_millis("start_time").alias("start_time"),
        F.timestamp_millis("end_time").alias("end_time"),
        *[lookup("metrics", k).alias(k) for k in metrics],
        *[lookup("params", k).alias(k) for k in params],
        *[lookup("tags", k).alias(k) for k in tags],
    )


def map_keys_of(runs: DataFrame, mapping: str, limit: int = 10_000) -> list[str]:
    """Distinct keys of a map column, for ``flatten_runs``."""
    rows = runs.select(F.explode(F.map_keys(mapping)).alias("k")).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} distinct keys in {mapping!r}")
    return sorted(r["k"] for r in rows)


def flag_best(
    runs: DataFrame, metric_name: str = REFERENCE_METRIC, production_run_id: Column | None = None
) -> DataFrame:
    """Finished runs with production and best flags and the gap best vs production.

    Higher is better for r2-like metrics. The best run is one aggregate, not a
    sort of the table; ties go to the smallest run id.
    """
    higher = "r2" in metric_name.lower()
    finished = runs.where(F.col("status") == "FINISHED").withColumn("__m", metric(metric_name))
    rank = F.struct((-F.col("__m") if higher else F.col("__m")).alias("m"), F.col("run_id"))
    best = finished.agg(
        F.min_by(F.struct("run_id", "__m"), F.when(F.col("__m").isNotNull(), rank))
    ).scalar()
    prod_id = F.lit(None).cast("string") if production_run_id is None else production_run_id
    gap = F.col("__m") - best.getField("__m") if higher else best.getField("__m") - F.col("__m")
    is_prod = F.coalesce(F.col("run_id") == prod_id, F.lit(False))
    return finished.select(
        "run_id",
        F.col("__m").alias(metric_name),
        is_prod.alias("production"),
        F.coalesce(F.col("run_id") == best.getField("run_id"), F.lit(False)).alias("best"),
        F.when(is_prod, F.round(gap, 4)).alias("delta"),
    )


def iso_utc(epoch_ms: Column) -> Column:
    """ISO-8601 text in UTC; microseconds only if there are any."""
    local = F.timestamp_millis(epoch_ms).cast("timestamp_ntz")
    utc = F.convert_timezone(None, F.lit("UTC"), local)
    whole = F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(utc, "'.'SSSSSS")
    return F.concat(whole, F.when(epoch_ms % 1000 == 0, F.lit("")).otherwise(fraction), F.lit("+00:00"))


def run_summary(runs: DataFrame) -> DataFrame:
    """Key metrics, last update and lineage parameters of each run."""
    return runs.select(
        "run_id",
        F.map_filter("metrics", lambda k, _: k.isin(*KEY_METRICS)).alias("metrics"),
        iso_utc(F.coalesce("end_time", "start_time")).alias("last_updated_at"),
        F.map_filter("params", lambda k, _: k.isin(*LINEAGE_KEYS)).alias("data_version"),
    )


def run_progress(
    tasks: DataFrame, by: str = "run_id", finished: Sequence[str] = ("success", "failed")
) -> DataFrame:
    """Task counts by state and the finished share per run."""
    state = F.col("state")
    counts = tasks.groupBy(col(by)).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(state == "success").alias("success"),
        F.count_if(state == "running").alias("running"),
        F.count_if(state == "failed").alias("failed"),
        F.count_if(state.isin(*finished)).alias("finished"),
    )
    return counts.withColumn("progress", F.col("finished") / F.col("total"))


def experiment_list(runs: DataFrame, id_column: str = "experiment_id", name: str = "name") -> DataFrame:
    return runs.select(col(id_column).alias("experiment_id"), col(name).alias("name")).distinct()


# --- append-only run log ---------------------------------------------------


def latest_entries(events: DataFrame) -> DataFrame:
    """Last logged value of every (run, kind, key); later ``seq`` wins on equal time."""
    return events.groupBy("run_id", "kind", "key").agg(
        F.max_by("value", F.struct("ts", "seq")).alias("value")
    )


def runs_from_events(events: DataFrame) -> DataFrame:
    """The run table implied by an append-only log of metrics, params, tags and status.

    Entries are reduced per key before they are gathered per run, so a run's row
    is as large as its number of distinct keys.
    """
    latest = latest_entries(events)

    def entries(kind: str, value: Column) -> Column:
        return F.map_from_entries(
            F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.struct("key", value.alias("value")))))
        )

    def attribute(key: str) -> Column:
        return F.max(F.when((F.col("kind") == "attribute") & (F.col("key") == key), F.col("value")))

    return latest.groupBy("run_id").agg(
        attribute("experiment_id").alias("experiment_id"),
        attribute("status").alias("status"),
        attribute("start_time").cast("bigint").alias("start_time"),
        attribute("end_time").cast("bigint").alias("end_time"),
        entries("metric", F.col("value").cast("double")).alias("metrics"),
        entries("param", F.col("value")).alias("params"),
        entries("tag", F.col("value")).alias("tags"),
    )
