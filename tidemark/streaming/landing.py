"""Incremental landing of new files, and the ingest stream on top of it.

The checkpoint of the file source remembers which files were taken, so each file
enters exactly one batch. A retried micro-batch gets the same id, overwrites the
same raw folder and finds its id already committed in the master.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.config import Contract
from tidemark.jobs.ingestion import BatchResult, preprocess_batch
from tidemark.sources.images import image_headers
from tidemark.sources.listing import IngestionError, check_listing, classify
from tidemark.sources.master import MasterTable
from tidemark.sources.tabular import read_text_files

LISTING_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


@dataclass(frozen=True)
class Landed:
    batch_id: str
    tabular_files: int
    image_files: int
    raw_path: str
    images_path: str | None


def batch_id_of(files: DataFrame) -> str:
    """``batch_<newest file time>_<digest of the files' names, times, lengths>``: the same files, the same id."""
    # Two sums of independent hashes: 128 bits, in any order of the files.
    facts = (F.col("path"), F.col("modificationTime").cast("long"), F.col("length"))
    row = files.agg(
        F.date_format(F.max("modificationTime"), "yyyyMMdd_HHmmss").alias("t"),
        *[F.lpad(F.lower(F.hex(F.bit_xor(F.xxhash64(F.lit(i), *facts)))), 16, "0").alias(f"h{i}") for i in range(2)],
    ).first()
    return f"batch_{row['t']}_{row['h0']}{row['h1']}"


def land_batch(
    files: DataFrame, raw_root: str, contract: Contract, contents: Callable[[list[str]], DataFrame] | None = None
) -> Landed | None:
    """Check the new files and store them as one raw batch; None if there is nothing.

    ``files`` are ``binaryFile`` rows, without ``content`` if ``contents`` gives
    the rows of paths. Tabular files become a text table with positions; of the
    images only digest and header are kept.
    """
    spark = files.sparkSession
    listed = classify(files, contract)
    counts = check_listing(listed)
    if counts is None:
        return None
    batch_id = batch_id_of(files)
    # One path per new file, as many as one trigger admits.
    paths = sorted(r["path"] for r in listed.where(F.col("kind") == "tabular").select("path").collect())
    raw_path = f"{raw_root}/tabular/batch_id={batch_id}"
    read_text_files(spark, paths, contract).write.mode("overwrite").parquet(raw_path)
    if spark.read.parquet(raw_path).select("file_name").distinct().count() < len(paths):
        raise IngestionError(f"batch {batch_id} has files without rows")
    images_path = None
    if counts["image"]:
        images_path = f"{raw_root}/images/batch_id={batch_id}"
        if contents is not None:
            files = contents(sorted(r["path"] for r in listed.where(F.col("kind") == "image").select("path").collect()))
        images = classify(files, contract, keep=["content"]).where(F.col("kind") == "image")
        headers = image_headers(images, "content").select("file", "sha256", "bands", "height", "width")
        headers.write.mode("overwrite").parquet(images_path)
    return Landed(batch_id, counts["tabular"], counts["image"], raw_path, images_path)


def file_stream(spark: SparkSession, incoming: str, max_files: int | None = None) -> DataFrame:
    """New files below the drop folder as ``binaryFile`` rows."""
    reader = (
        spark.readStream.format("binaryFile").schema(LISTING_SCHEMA).option("recursiveFileLookup", True)
        # By default the source leaves out files that are a week older than the newest.
        .option("maxFileAge", "36500d")
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(incoming)


def ingest_stream(
    spark: SparkSession,
    incoming: str,
    raw_root: str,
    checkpoint: str,
    contract: Contract,
    master: MasterTable,
    rejects_path: str | None = None,
    on_result: Callable[[BatchResult], None] | None = None,
) -> StreamingQuery:
    """Take everything that is new, land it, merge it into the master, stop."""

    def handle(files: DataFrame, epoch: int) -> None:
        landed = land_batch(files, raw_root, contract)
        if landed is None:
            return
        raw = spark.read.parquet(landed.raw_path)
        images = None if landed.images_path is None else spark.read.parquet(landed.images_path)
        result = preprocess_batch(raw, landed.batch_id, contract, master, images, rejects_path)
        if on_result is not None:
            on_result(result)

    return (
        file_stream(spark, incoming)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
