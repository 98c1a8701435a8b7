"""What lies in a drop folder: files by extension, unknown files, duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import Contract

# Files that are never data.
IGNORED_NAMES = ("Thumbs.db", "_READY", "_PROCESSING")


class IngestionError(ValueError):
    """The drop folder holds something a batch cannot contain."""


def list_files(spark: SparkSession, root: str, contract: Contract) -> DataFrame:
    """``(path, file, length, kind)`` of all files below ``root``; contents are not read.

    The file source passes over files without any bytes.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return classify(listed, contract)


def classify(files: DataFrame, contract: Contract, keep: Sequence[str] = ()) -> DataFrame:
    """Name and kind of ``binaryFile`` rows, hidden and system files left out.

    ``kind`` is ``tabular``, ``image`` or ``unknown`` by the contract's extensions.
    """
    extension = F.regexp_extract("file", r"\.([^.]+)$", 1)
    kind = (
        F.when(extension.isin(*contract.tabular_extensions), "tabular")
        .when(extension.isin(*contract.image_extensions), "image")
        .otherwise("unknown")
    )
    named = files.withColumn("file", F.regexp_extract("path", r"([^/]+)$", 1))
    wanted = ~F.col("file").startswith(".") & ~F.col("file").isin(*IGNORED_NAMES)
    return named.where(wanted).select("path", "file", "length", kind.alias("kind"), *keep)


def listing_counts(files: DataFrame) -> dict[str, int]:
    """Number of files per kind."""
    row = files.agg(*[F.count_if(F.col("kind") == k).alias(k) for k in ("tabular", "image", "unknown")])
    return row.first().asDict()


def duplicate_names(files: DataFrame) -> DataFrame:
    """Base names that occur more than once within a kind."""
    return files.groupBy("kind", "file").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def check_listing(files: DataFrame) -> dict[str, int] | None:
    """Counts per kind; None if there is nothing to ingest; raises on a bad drop."""
    counts = listing_counts(files)
    if counts["unknown"]:
        shown = [r["path"] for r in files.where(F.col("kind") == "unknown").orderBy("path").limit(10).collect()]
        raise IngestionError(f"{counts['unknown']} unknown files, for example {shown}")
    if not counts["tabular"] and not counts["image"]:
        return None
    if not counts["tabular"]:
        raise IngestionError("images without any tabular file")
    twice = duplicate_names(files).limit(10).collect()
    if twice:
        raise IngestionError(f"duplicate file names: {[r['file'] for r in twice]}")
    return counts
