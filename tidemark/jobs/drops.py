"""Deliveries closed by a marker, and the ledger of the files that were landed.

A drop is a folder with a marker file. The ledger has a row ``(path, modified,
length)`` for every file that landed; a file is new if the ledger does not know
these three, whatever its name or age. So a corrected file under an old path
lands again, an old file that is found late lands once, and nothing lands twice.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import Contract
from tidemark.jobs.ingestion import BatchResult, preprocess_batch
from tidemark.sources.folders import Marker, ready_markers
from tidemark.sources.listing import IngestionError
from tidemark.sources.master import MasterTable
from tidemark.session import scratch_path
from tidemark.streaming.landing import land_batch

LEDGER = "path string, modified timestamp, length bigint, batch_id string"
FACTS = ("path", "modified", "length")
# Fixed value: minutes after which a closed drop that has not landed is overdue.
OVERDUE_MINUTES = 20


class Ledger:
    """An append-only table of landed files and markers. One writer at a time is assumed."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path

    def read(self) -> DataFrame:
        try:
            return self._spark.read.schema(LEDGER).parquet(self._path)
        except AnalysisException as error:
            if not (error.getCondition() or "").startswith("PATH_NOT_FOUND"):
                raise
            return self._spark.createDataFrame([], LEDGER)

    def unknown(self, files: DataFrame) -> DataFrame:
        """The files that have not landed with this time and length."""
        known = self.read().select(*FACTS).distinct()
        return files.join(known, list(FACTS), "left_anti")

    def add(self, files: DataFrame, marker: Marker, batch_id: str | None) -> None:
        """The files of a batch and the marker that closed it, in one commit."""
        rows = files.select(*FACTS).unionByName(_marker_row(self._spark, marker))
        rows.withColumn("batch_id", F.lit(batch_id).cast("string")).write.mode("append").parquet(self._path)


def _marker_row(spark: SparkSession, marker: Marker) -> DataFrame:
    return spark.createDataFrame([(marker.path, marker.modified, marker.length)], "path string, modified timestamp, length bigint")


def open_drops(spark: SparkSession, incoming: str, ledger: Ledger) -> list[Marker]:
    """Markers that have not been answered yet, oldest first; a marker that is written again counts anew."""
    markers = ready_markers(spark, incoming)
    if not markers:
        return []
    rows = spark.createDataFrame([(m.path, m.modified, m.length) for m in markers], "path string, modified timestamp, length bigint")
    left = {r["path"] for r in ledger.unknown(rows).collect()}
    return [m for m in markers if m.path in left]


def overdue_drops(
    spark: SparkSession, incoming: str, ledger: Ledger, now: dt.datetime | None = None, minutes: int = OVERDUE_MINUTES
) -> list[Marker]:
    """Closed drops that wait for longer than they should: a job hangs, or the drop cannot land."""
    now = now or dt.datetime.now(dt.timezone.utc)
    return [m for m in open_drops(spark, incoming, ledger) if now - m.modified > dt.timedelta(minutes=minutes)]


def new_files(spark: SparkSession, marker: Marker, ledger: Ledger) -> DataFrame:
    """``(path, modified, length)`` of the drop's files that have not landed; what is newer than the marker waits for the next."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(marker.folder)
    files = listed.select("path", F.col("modificationTime").alias("modified"), "length")
    return ledger.unknown(files.where(F.col("modified") <= F.lit(marker.modified)))


def ingest_drops(
    spark: SparkSession,
    incoming: str,
    raw_root: str,
    ledger_path: str,
    contract: Contract,
    master: MasterTable,
    rejects_path: str | None = None,
    on_result: Callable[[BatchResult], None] | None = None,
) -> list[BatchResult]:
    """Land every closed drop as one batch each and merge it into the master.

    The file list is written once per drop and everything reads that copy, so a
    file that changes meanwhile belongs to the next marker. Contents are read of
    tabular files and images that are new, of nothing else. The batch id derives
    from the files, so after a crash between the master's commit and the
    ledger's the same batch comes again and changes nothing. A drop that cannot
    land stays open and does not hold up the others; its error is raised when
    all have been tried.
    """
    ledger, results, failed = Ledger(spark, ledger_path), [], []
    for marker in open_drops(spark, incoming, ledger):
        listing = scratch_path(spark, "drop")
        new_files(spark, marker, ledger).write.parquet(listing)
        files = spark.read.schema("path string, modified timestamp, length bigint").parquet(listing)
        try:
            landed = land_batch(
                files.withColumnRenamed("modified", "modificationTime"), raw_root, contract,
                contents=lambda paths: spark.read.format("binaryFile").load(paths))
            if landed is not None:
                raw = spark.read.parquet(landed.raw_path)
                images = None if landed.images_path is None else spark.read.parquet(landed.images_path)
                result = preprocess_batch(raw, landed.batch_id, contract, master, images, rejects_path)
                results.append(result)
                if on_result is not None:
                    on_result(result)
        except (ValueError, TypeError) as error:  # what checks of listings, contracts and images raise
            failed.append((marker, error))
            continue
        ledger.add(files, marker, None if landed is None else landed.batch_id)
    if failed:
        shown = "; ".join(f"{m.folder}: {e}" for m, e in failed[:10])
        raise IngestionError(f"{len(failed)} drops cannot land: {shown}") from failed[0][1]
    return results
