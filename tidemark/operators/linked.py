"""Files named by table columns: resolve, reject, rename, attach.

``files`` frames have a ``file`` column (base name); image frames add header
columns. Joins are plain equi-joins: Spark broadcasts the smaller side when its
measured size allows and splits skewed partitions of the table side otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import Contract
from tidemark.functions.missing import col


def references(df: DataFrame, contract: Contract) -> DataFrame:
    """Distinct ``(name, file)`` pairs the external-file columns mention."""
    pairs = [
        F.struct(F.lit(ext.name).alias("name"), col(c).cast("string").alias("file"))
        for c, ext in contract.external_columns().items()
        if c in df.columns
    ]
    if not pairs:
        raise ValueError("no external-file column in the frame")
    exploded = df.select(F.explode(F.array(*pairs)).alias("r")).select("r.name", "r.file")
    return exploded.where(F.col("file").isNotNull()).distinct()


def missing_references(refs: DataFrame, files: DataFrame) -> DataFrame:
    """References to files that are not there."""
    return refs.join(files.select("file"), "file", "left_anti").select("name", "file")


def unreferenced_files(refs: DataFrame, files: DataFrame) -> DataFrame:
    """Files that no row mentions."""
    return files.select("file").distinct().join(refs.select("file"), "file", "left_anti")


def resolved_references(refs: DataFrame, files: DataFrame) -> DataFrame:
    """Distinct mentioned files that are there."""
    return refs.select("file").distinct().join(files.select("file"), "file", "left_semi")


def header_violations(refs: DataFrame, headers: DataFrame, contract: Contract) -> DataFrame:
    """Referenced images whose band count, height or width differs from the contract."""
    found = refs.join(headers.select("file", "bands", "height", "width"), "file")
    checks = [
        F.when(
            (F.col("name") == ext.name) & ~F.col(what).eqNullSafe(F.lit(expected)),
            F.struct(
                F.lit(what).alias("rule"),
                F.lit(expected).cast("bigint").alias("expected"),
                F.col(what).cast("bigint").alias("actual"),
            ),
        )
        for ext in contract.external_columns().values()
        for what, expected in (("bands", ext.bands), ("height", ext.height), ("width", ext.width))
        if expected is not None
    ]
    if not checks:
        return found.where(F.lit(False)).select(
            "name", "file", F.lit("").alias("rule"),
            F.lit(0).cast("bigint").alias("expected"), F.lit(0).cast("bigint").alias("actual"),
        )
    return found.select(
        "name", "file", F.explode(F.array_compact(F.array(*checks))).alias("v")
    ).select("name", "file", "v.rule", "v.expected", "v.actual")


def canonical_mapping(refs: DataFrame, digests: DataFrame) -> DataFrame:
    """``(name, file, relative_path)`` with paths named after the content.

    ``digests`` holds ``(file, sha256)``. A retry yields the same paths, and two
    copies of one image share a path.
    """
    return refs.join(digests.select("file", "sha256"), "file").select(
        "name", "file",
        F.concat(F.lit("images/"), F.col("name"), F.lit("/"), F.col("sha256"), F.lit(".tif"))
        .alias("relative_path"),
    )


def attach_canonical_paths(df: DataFrame, mapping: DataFrame, contract: Contract) -> DataFrame:
    """Add ``<name>_relative_path`` for every declared external column.

    The column is always added, null where the file is not mapped.
    """
    out = df
    for column, ext in contract.external_columns().items():
        if column not in df.columns:
            continue
        lookup = mapping.where(F.col("name") == ext.name).select(
            F.col("file").alias("__file"), F.col("relative_path").alias(ext.path_column)
        )
        out = out.join(lookup, col(column).cast("string") == F.col("__file"), "left").drop("__file")
    return out


def null_dangling(df: DataFrame, files: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Set file columns to null where the named file is not there."""
    known = files.select(F.col("file").alias("__file")).distinct()
    out = df
    for column in columns:
        out = (
            out.join(known, col(column) == F.col("__file"), "left")
            .withColumn(column, F.when(F.col("__file").isNotNull(), col(column)))
            .drop("__file")
        )
    return out.select(*[col(c) for c in df.columns])


class LinkedFileError(ValueError):
    """A batch and its image files do not fit together."""


def link_images(
    df: DataFrame, images: DataFrame, contract: Contract
) -> tuple[DataFrame, DataFrame]:
    """Check a batch against its images and attach canonical paths.

    ``images`` holds ``(file, sha256, bands, height, width)``. Returns the batch
    with path columns and the mapping. Raises on missing, unreferenced or
    mis-sized images; messages show at most ten of them.
    """
    if not [c for c in contract.external_columns() if c in df.columns]:
        raise LinkedFileError("the batch has no external-file column")
    refs = references(df, contract)

    def fail_if_any(problems: DataFrame, what: str) -> None:
        shown = problems.limit(10).collect()
        if shown:
            raise LinkedFileError(f"{what}: {[tuple(r) for r in shown]}")

    fail_if_any(missing_references(refs, images), "referenced files not in the batch")
    fail_if_any(unreferenced_files(refs, images), "unreferenced image files")
    fail_if_any(header_violations(refs, images, contract), "image header differs")
    mapping = canonical_mapping(refs, images)
    return attach_canonical_paths(df, mapping, contract), mapping
