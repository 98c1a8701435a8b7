"""The master table and the streams, run over the whole test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark.config import ColumnRule, Contract
from tidemark.jobs.drops import ingest_drops
from tidemark.operators import monitor
from tidemark.plans import query, table
from tidemark.plans.merging import _UPSERT, master_and_batch
from tidemark.plans.monitoring import ALERTS_BY_RULE, EVENT_RULES, STRETCHES, event_signals
from tidemark.session import scratch_path
from tidemark.sources.folders import publish_parts, put_marker
from tidemark.sources.master import MasterTable
from tidemark.sources.tabular import files_with_rows, write_csv
from tidemark.streaming import events as stream
from tidemark.streaming.landing import ingest_stream

_MERGED = f"""WITH {_UPSERT}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY seq DESC) AS rn
  FROM (SELECT *, 0 AS seq FROM master UNION ALL SELECT * FROM batch))
SELECT o_orderkey, o_orderstatus, o_totalprice FROM ranked WHERE rn = 1"""


@query(_MERGED)
def master_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches through the versioned master; the second one twice."""
    first, second = master_and_batch(spark, sf_dir)
    master = MasterTable(spark, scratch_path(spark, "master"), ["o_orderkey"], "last", n_buckets=16)
    master.upsert(first, "first", ["o_orderkey"])
    for _ in range(2):
        master.upsert(second, "second", ["seq"], transient=["seq"])
    return master.read()


ORDER_FILES = Contract(
    columns={
        "o_orderkey": ColumnRule("int", non_nullable=True, min=0),
        "o_orderstatus": ColumnRule("string", allowed_values=("O", "F", "P")),
        "o_totalprice": ColumnRule("float", non_nullable=True, max=480000),
    },
    primary_key=("o_orderkey",),
    target="o_totalprice",
    dedup_subset=("o_orderkey",),
    dedup_keep="last",
)


def _deliveries(spark: SparkSession, sf_dir: str) -> tuple[MasterTable, str]:
    """Orders as CSV files in marked drops; one drop comes first with halved prices, then corrected under the same paths.

    Returns the master and the folder of the rows that were set aside.
    """
    root = scratch_path(spark, "landing")
    orders = table(spark, sf_dir, "orders").select(*ORDER_FILES.columns)
    master = MasterTable(spark, f"{root}/master", ORDER_FILES.primary_key, "last", n_buckets=16)
    open_orders = F.col("o_orderstatus") == "P"
    price = F.col("o_totalprice")
    halved = orders.where(open_orders).withColumn("o_totalprice", F.when(price <= 480000, price / 2).otherwise(price))
    for step, (drop, rows) in enumerate((("a", halved), ("b", orders.where(~open_orders)), ("a", orders.where(open_orders)))):
        written = f"{root}/written/{step}"
        write_csv(rows, written)
        publish_parts(spark, written, f"{root}/incoming/{drop}", ".csv", files_with_rows(spark, written))
        if drop == "a":
            put_marker(spark, f"{root}/incoming/a")
            ingest_drops(spark, f"{root}/incoming", f"{root}/raw", f"{root}/ledger", ORDER_FILES, master, f"{root}/rejects")
        else:  # this folder has no marker of its own, the stream takes what it finds
            ingest_stream(
                spark, f"{root}/incoming/b", f"{root}/raw", f"{root}/checkpoint", ORDER_FILES, master,
                rejects_path=f"{root}/rejects",
            ).awaitTermination()
    return master, f"{root}/rejects"


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_totalprice <= 480000")
def landed_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the deliveries leave in the master: the corrected prices, nothing over the limit."""
    return _deliveries(spark, sf_dir)[0].read()


@query(
    """SELECT o_orderkey, 'max:o_totalprice' AS violations,
       CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END::BIGINT AS n_deliveries
    FROM orders WHERE o_totalprice > 480000"""
)
def landed_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that were set aside, and how many deliveries held them."""
    rejects = spark.read.parquet(_deliveries(spark, sf_dir)[1])
    return rejects.groupBy(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), F.concat_ws(" ", "violations").alias("violations")).agg(
        F.countDistinct("batch_id").alias("n_deliveries"))


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    # A file source watches folders; the pattern narrows it to the one table.
    source = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    # The delay and the longest window: every window of the table closes, the marker's own does not.
    end = stream.end_marker(events, "ts", "2 HOURS", scratch_path(spark, "end"))
    return stream.with_event_time(source.unionByName(end), "ts", "1 hour")


def _drain(spark: SparkSession, writer: DataStreamWriter, label: str, schema) -> DataFrame:
    root = scratch_path(spark, label)
    started = (
        writer.outputMode("append").format("parquet").option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    )
    started.awaitTermination()
    return spark.read.schema(schema).parquet(f"{root}/out")


def _drain_stateful(spark: SparkSession, alerts: DataFrame, label: str) -> DataFrame:
    """Drain with the state store that user-defined state needs."""
    store = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(store)
    spark.conf.set(store, stream.ROCKSDB)
    try:
        return _drain(spark, alerts.writeStream, label, alerts.schema)
    finally:
        spark.conf.set(store, before)


def _wall_clock(name: str) -> F.Column:
    """Back to the wall-clock time the event time was cast from."""
    return F.col(name).cast("timestamp_ntz").alias(name)


def _bucket(minutes: int) -> str:
    return f"time_bucket(INTERVAL {minutes} MINUTE, ts, TIMESTAMP '1970-01-01')"


@query(
    f"SELECT {_bucket(30)} AS window_start, event_type, round(count(*) / 1800.0::DOUBLE, 9) AS rate "
    "FROM events GROUP BY ALL"
)
def rate_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request rates by Structured Streaming in append mode."""
    rates = monitor.request_rate(_event_stream(spark, sf_dir), "ts", ["event_type"], 30)
    out = _drain(spark, rates.writeStream, "rates", rates.schema)
    return out.select(_wall_clock("window_start"), "event_type", F.round("rate", 9).alias("rate"))


@query(
    f"""WITH {STRETCHES}
    SELECT event_type, since AS active_since, min(seen) AS firing_at
    FROM stretches WHERE seen >= since + INTERVAL 2 HOUR GROUP BY event_type, since"""
)
def alert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sustained alerts by a stateful stream; equals the batch islands."""
    evaluations = stream.evaluate_windows(
        _event_stream(spark, sf_dir), ["event_type"], "ts", "1 hour", F.avg("value") > 20
    )
    alerts = stream.sustained_alert_stream(evaluations, ["event_type"], 7200, 3600)
    out = _drain_stateful(spark, alerts, "alerts")
    return out.select("event_type", _wall_clock("active_since"), _wall_clock("firing_at"))


@query(ALERTS_BY_RULE)
def alerts_by_rule_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rules by a stateful stream: silence is noticed by timers on event time."""
    alerts = stream.alerts_by_rule_stream(event_signals(_event_stream(spark, sf_dir)), EVENT_RULES, "event_type", 3600)
    out = _drain_stateful(spark, alerts, "rule-alerts")
    return out.select("rule", "severity", "event_type", _wall_clock("active_since"), _wall_clock("firing_at"))
