"""Image headers by column expressions.

TIFF and BigTIFF, both byte orders. Only the directory bytes of the first image
are looked at; pixel data never leaves the reader.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# TIFF tag numbers and the byte widths of its integer types.
TAG_WIDTH, TAG_HEIGHT, TAG_BANDS = 256, 257, 277
TYPE_BYTES = {3: 2, 4: 4, 16: 8}


def read_images(spark: SparkSession, root: str, pattern: str = "*.tif") -> DataFrame:
    """``(file, sha256, bands, height, width)`` of the images below ``root``."""
    raw = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(root)
    )
    return image_headers(raw, "content").select(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "sha256", "bands", "height", "width"
    )


def image_headers(df: DataFrame, content: str) -> DataFrame:
    """Replace a binary column by its digest and header numbers (null if not a TIFF)."""
    data = F.col(content)
    little = F.substring(data, 1, 2) == F.lit(b"II")
    staged = df.withColumns(
        {
            "sha256": F.sha2(data, 256),
            "__little": little,
            "__tiff": F.coalesce(little | (F.substring(data, 1, 2) == F.lit(b"MM")), F.lit(False)),
        }
    )
    staged = staged.withColumn("__big", _uint(data, F.lit(2), 2) == 43)
    staged = staged.withColumn(
        "__at", F.when(F.col("__big"), _uint(data, F.lit(8), 8)).otherwise(_uint(data, F.lit(4), 4))
    )
    count_bytes = F.when(F.col("__big"), F.lit(8)).otherwise(F.lit(2))
    entry_bytes = F.when(F.col("__big"), F.lit(20)).otherwise(F.lit(12))
    entries = F.when(F.col("__big"), _uint(data, F.col("__at"), 8)).otherwise(
        _uint(data, F.col("__at"), 2)
    )
    staged = staged.withColumn(
        "__directory",
        F.when(
            F.col("__tiff") & (entries > 0),
            F.substring(
                data, (F.col("__at") + count_bytes + 1).cast("int"), (entries * entry_bytes).cast("int")
            ),
        ),
    ).drop(content)
    directory = F.col("__directory")
    step = F.when(F.col("__big"), F.lit(20)).otherwise(F.lit(12))
    value_at = F.when(F.col("__big"), F.lit(12)).otherwise(F.lit(8))
    slots = F.sequence(F.lit(0), (F.length(directory) / step).cast("int") - 1)
    tags = F.transform(
        F.filter(slots, lambda i: _uint(directory, i * step, 2).isin(TAG_WIDTH, TAG_HEIGHT, TAG_BANDS)),
        lambda i: F.struct(
            _uint(directory, i * step, 2).alias("key"),
            _sized(directory, i * step + value_at, _uint(directory, i * step + 2, 2)).alias("value"),
        ),
    )
    known = F.map_from_entries(tags)
    parsed = staged.withColumn("__tags", F.when(F.length(directory) > 0, known))

    def tag(number: int) -> Column:
        return F.try_element_at("__tags", F.lit(number).cast("bigint"))

    has_size = tag(TAG_WIDTH).isNotNull()
    return parsed.withColumns(
        {
            "bands": F.when(has_size, F.coalesce(tag(TAG_BANDS), F.lit(1).cast("bigint"))),
            "height": tag(TAG_HEIGHT),
            "width": tag(TAG_WIDTH),
        }
    ).drop("__little", "__tiff", "__big", "__at", "__directory", "__tags")


def _uint(data: Column, offset: Column, width: int) -> Column:
    """Unsigned integer of ``width`` bytes at a zero-based offset, in the file's byte order."""
    parts = [F.hex(F.substring(data, (offset + i + 1).cast("int"), F.lit(1))) for i in range(width)]
    digits = F.when(F.col("__little"), F.concat(*reversed(parts))).otherwise(F.concat(*parts))
    return F.conv(digits, 16, 10).cast("bigint")


def _sized(data: Column, offset: Column, kind: Column) -> Column:
    value = F.lit(None).cast("bigint")
    for code, width in TYPE_BYTES.items():
        value = F.when(kind == code, _uint(data, offset, width)).otherwise(value)
    return value
