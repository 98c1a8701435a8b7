"""The master table: hash buckets in immutable version folders, one commit row each.

``<root>/data/version=N/bucket=B/`` holds the rows of bucket B as last rewritten
by version N. ``<root>/commits`` is a small append-only JSON table; its newest
row names, per bucket, the version folder to read. A version becomes visible
only when its commit row is there, so readers never see half a write, and an
upsert rewrites only the buckets its batch touches.

One writer at a time is assumed, as one ingestion job runs at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.missing import col, present
from tidemark.operators.merge import drop_duplicates, upsert
from tidemark.sources.folders import exists

COMMIT_SCHEMA = (
    "version bigint, batch_id string, rows_batch bigint, rows_added bigint, rows_total bigint, "
    "buckets array<struct<bucket: int, version: bigint, rows: bigint>>"
)


def _nothing_there(error: AnalysisException) -> bool:
    """The path is absent, or holds no finished file."""
    return (error.getCondition() or "").startswith(("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"))


@dataclass(frozen=True)
class Commit:
    version: int
    batch_id: str
    rows_batch: int
    rows_added: int
    rows_total: int
    buckets: dict[int, tuple[int, int]]  # bucket -> (version folder, rows)


class MasterTable:
    """A keyed table that is upserted batch by batch."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        key: Sequence[str],
        keep: str | None = "last",
        n_buckets: int = 64,
    ) -> None:
        if n_buckets < 1:
            raise ValueError("need at least one bucket")
        if not key:
            raise ValueError("the master needs key columns")
        self._spark = spark
        self._data = f"{root.rstrip('/')}/data"
        self._commits = f"{root.rstrip('/')}/commits"
        self._key = list(key)
        self._keep = keep
        self._n = n_buckets

    # --- commits ---

    def commits(self) -> DataFrame:
        try:
            return self._spark.read.schema(COMMIT_SCHEMA).json(self._commits)
        except AnalysisException as error:
            if not _nothing_there(error):
                raise
            return self._spark.createDataFrame([], COMMIT_SCHEMA)

    def head(self) -> Commit | None:
        row = self.commits().agg(F.max_by(F.struct("*"), "version").alias("c")).first()["c"]
        if row is None:
            return None
        return Commit(
            row["version"], row["batch_id"], row["rows_batch"], row["rows_added"],
            row["rows_total"], {b["bucket"]: (b["version"], b["rows"]) for b in row["buckets"]},
        )

    def has_batch(self, batch_id: str) -> bool:
        return not self.commits().where(F.col("batch_id") == batch_id).isEmpty()

    # --- reading ---

    def exists(self) -> bool:
        return self.head() is not None

    def read(self) -> DataFrame:
        """The current rows; raises if there is no master or it is empty."""
        head = self.head()
        if head is None:
            raise FileNotFoundError(f"no master table at {self._data}")
        if head.rows_total == 0:
            raise ValueError("master table is empty")
        return self._read(head, list(head.buckets)).drop("bucket")

    def _read(self, head: Commit, buckets: Sequence[int]) -> DataFrame:
        paths = [
            f"{self._data}/version={head.buckets[b][0]}/bucket={b}"
            for b in buckets
            if b in head.buckets and head.buckets[b][1] > 0
        ]
        return self._spark.read.option("basePath", self._data).parquet(*paths).drop("version")

    def _bucket(self, df: DataFrame) -> Column:
        """Null and NaN keys are one key, so they share a bucket."""
        return F.pmod(F.xxhash64(*[present(df, k) for k in self._key]), F.lit(self._n)).cast("int")

    # --- writing ---

    def upsert(
        self, batch: DataFrame, batch_id: str, order: Sequence[str], transient: Sequence[str] = ()
    ) -> Commit:
        """Merge a batch and commit; a batch already committed is left alone.

        ``order`` names the columns that rank rows inside the batch for keep
        first/last; master rows count as earlier than any batch row. Columns in
        ``transient`` only serve the ranking and are not stored.
        """
        head = self.head()
        if head is not None and self.has_batch(batch_id):
            return head
        version = 1 if head is None else head.version + 1
        batch = batch.withColumn("bucket", self._bucket(batch))
        # At most one row per bucket comes back.
        counts = batch.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()
        touched = {r["bucket"]: r["n"] for r in counts}
        stored = {} if head is None else head.buckets
        current = [b for b in sorted(touched) if stored.get(b, (0, 0))[1]]
        key = ["bucket", *self._key]
        if current:
            merged = upsert(self._read(head, current), batch, key, self._keep, order)
        elif self._keep is None:
            merged = batch
        else:
            merged = drop_duplicates(batch, key, self._keep, [col(c) for c in order])
        target = f"{self._data}/version={version}"
        # Rows are spread by bucket and by a slice of the key, so that a large
        # bucket is written by several tasks and a small one as one file.
        (
            merged.drop(*transient).repartition(F.col("bucket"), self._slice())
            .write.mode("overwrite").partitionBy("bucket").parquet(target)
        )
        written = self._count(target, merged.drop(*transient).schema)
        buckets = {**stored, **{b: (version, written.get(b, 0)) for b in touched}}
        total = sum(rows for _, rows in buckets.values())
        commit = Commit(
            version, batch_id, sum(touched.values()),
            total - (0 if head is None else head.rows_total), total, buckets,
        )
        self._append(commit)
        return commit

    def _slice(self) -> Column:
        slices = int(self._spark.conf.get("spark.sql.shuffle.partitions")) // self._n + 1
        return F.pmod(F.hash(*[col(k) for k in self._key]), F.lit(slices))

    def _count(self, path: str, schema: T.StructType) -> dict[int, int]:
        """Rows per bucket of a written version, from the Parquet footers."""
        written = self._spark.read.schema(schema).parquet(path)
        rows = written.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()
        return {r["bucket"]: r["n"] for r in rows}

    def _append(self, c: Commit) -> None:
        row = (
            c.version, c.batch_id, c.rows_batch, c.rows_added, c.rows_total,
            [(b, v, n) for b, (v, n) in sorted(c.buckets.items())],
        )
        self._spark.createDataFrame([row], COMMIT_SCHEMA).coalesce(1).write.mode("append").json(
            self._commits
        )


def write_once(df: DataFrame, path: str) -> tuple[DataFrame, bool]:
    """Write a table unless it is there already; return the stored one and whether it is new.

    A folder without the marker of a finished write is what a dead job left; it
    is replaced.
    """
    spark = df.sparkSession
    stored = _find(spark, path) if exists(spark, f"{path}/_SUCCESS") else None
    if stored is not None:
        return stored, False
    if df.isEmpty():
        raise ValueError("the frozen table would be empty on first creation")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path), True


def load_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table that must exist and hold rows."""
    df = _find(spark, path)
    if df is None:
        raise FileNotFoundError(f"no table at {path}")
    if df.isEmpty():
        raise ValueError(f"table at {path} is empty")
    return df


def _find(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if not _nothing_there(error):
            raise
        return None
