"""CSV batches: read as text, normalise missing tokens, cast by contract, concatenate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import Contract
from tidemark.functions.missing import col, na_tokens_to_null, parse_number

TABULAR_SUFFIXES = (".csv",)

# Where a row came from, in concatenation order: files by name, then file position.
POSITION = ("file_name", "file_block_start", "row_in_block")
_RAGGED = "__ragged"


def _check_suffix(paths: Sequence[str]) -> None:
    other = [p for p in paths if "." in p.rsplit("/", 1)[-1] and not p.lower().endswith(TABULAR_SUFFIXES)]
    if other:
        raise ValueError(f"unsupported tabular format: {other[:10]}")


def read_text_table(
    spark: SparkSession, paths: str | Sequence[str], multiline: bool = False
) -> DataFrame:
    """CSV files of one layout as text columns plus their position.

    Column names come from the first header; every other header is compared with
    it and a difference fails the job instead of shifting values. Missing tokens
    become null, and so do cells that a short row lacks; a row with more cells
    than the header fails the job when it is read in full. Large files are read
    by several tasks; set ``multiline`` if quoted cells contain line breaks (one
    task per file then).
    """
    chosen = [paths] if isinstance(paths, str) else list(paths)
    _check_suffix(chosen)
    header = spark.read.option("header", True).csv(chosen[0]).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, _RAGGED]])
    raw = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", multiline)
        .option("columnNameOfCorruptRecord", _RAGGED)
        .option("escape", '"')
        .csv(chosen)
    )
    # Rows whose number of cells differs come with their text; commas count outside quotes.
    bare = F.regexp_replace(F.col(_RAGGED), '"[^"]*"', "")
    surplus = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) >= len(header)
    first = F.when(surplus, F.raise_error(F.concat(
        F.lit("row with more cells than the header: "), F.substring(_RAGGED, 1, 200)))).otherwise(col(header[0]))
    raw = raw.select(
        first.alias(header[0]), *[col(c) for c in header[1:]],
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("file_block_start"),
    )
    return na_tokens_to_null(raw).withColumn("row_in_block", F.monotonically_increasing_id())


def read_text_files(spark: SparkSession, paths: Sequence[str], contract: Contract) -> DataFrame:
    """CSV files of a batch, each by its own header, as one text table with positions.

    One scan finds each file's header and whether a line has an open quote, so
    that only files with line breaks in cells are read by one task each.
    """
    lines = spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value",
        F.monotonically_increasing_id().alias("row"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    found = lines.groupBy("path").agg(
        F.min_by("value", F.struct("block", "row")).alias("header"),
        F.max(quotes % 2).alias("open"))
    layouts: dict[tuple[str, bool], list[str]] = {}
    for row in found.collect():  # one row per file
        layouts.setdefault((row["header"], row["open"] == 1), []).append(row["path"])
    frames = [read_text_table(spark, sorted(group), multiline) for (_, multiline), group in sorted(layouts.items())]
    if len(frames) == 1:
        return frames[0]
    return concat_batch({f"layout {i}": frame for i, frame in enumerate(frames)}, contract)


def concat_batch(frames: Mapping[str, DataFrame], contract: Contract) -> DataFrame:
    """Frames of a batch by column name, in contract order, tagged with ``file_name``."""
    parts = []
    for name in sorted(frames):
        frame = frames[name]
        missing = [c for c in contract.columns if c not in frame.columns]
        extra = [c for c in frame.columns if c not in contract.columns and c not in POSITION]
        if missing or extra:
            raise ValueError(f"{name}: missing columns {missing}, unexpected columns {extra}")
        tagged = frame if "file_name" in frame.columns else frame.withColumn("file_name", F.lit(name))
        rest = [c for c in POSITION if c in tagged.columns]
        parts.append(tagged.select(*[col(c) for c in contract.columns], *rest))
    if not parts:
        raise ValueError("no tabular files in the batch")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def cast_to_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """Text columns to the declared types; unreadable cells become null.

    Check the text frame against the contract first, so that nothing is lost
    silently. Integers go through double because "2.0" is an integer.
    """
    columns = {}
    for name, rule in contract.columns.items():
        if not isinstance(df.schema[name].dataType, T.StringType) or rule.type == "string":
            continue
        text = col(name)
        if rule.type == "float":
            columns[name] = parse_number(text)
        else:
            # Long integers beyond double precision keep their digits.
            columns[name] = F.coalesce(F.trim(text).try_cast("bigint"), parse_number(text).cast("bigint"))
    return df.withColumns(columns) if columns else df


def write_csv(df: DataFrame, path: str) -> None:
    """CSV sink with a header per file."""
    df.write.option("header", True).csv(path)


def files_with_rows(spark: SparkSession, path: str) -> set[str]:
    """Names of the files of a CSV table that hold more than a header: Spark's first task writes one even without rows."""
    rows = spark.read.option("header", True).csv(path).select(F.col("_metadata.file_name").alias("name"))
    return {r["name"] for r in rows.distinct().collect()}  # one row per file
