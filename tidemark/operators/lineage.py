"""Order-insensitive content fingerprints, whole and by part, and lineage rows.

A row is digested to two numbers of 60 bits, which add up over rows, so the digests of parts come from one aggregate and the
table's digest from those of its parts. All steps are plain text, MD5 and sums: any SQL engine can repeat them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.missing import col

# Hex digits of a half of a row's digest: what fits a signed 64-bit number.
_HALF = 15


def _text(value: Column) -> Column:
    """The value with its length before it, so that neighbouring values cannot be mistaken; ``N`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("N"))


def row_digest(columns: Sequence[Column]) -> Column:
    """MD5 of the values in order, 32 hex digits."""
    return F.md5(F.concat(F.lit(""), *map(_text, columns)))


def _half(digest: Column, start: int) -> Column:
    return F.conv(F.substring(digest, start, _HALF), 16, 10).cast("bigint")


def _folds(digest: Column) -> tuple[Column, Column]:
    # Each half adds up as two numbers of 30 bits: plain long sums, exact up to 2^33 rows a group.
    def fold(half: Column) -> Column:
        high, low = F.sum(F.shiftright(half, 30)), F.sum(half.bitwiseAND((1 << 30) - 1))
        return high.cast("decimal(28,0)") * F.lit(1 << 30).cast("decimal(10,0)") + low.cast("decimal(20,0)")

    return tuple(F.coalesce(fold(_half(digest, start)), F.lit(0)).cast("decimal(38,0)").alias(name)
                 for name, start in (("fold_a", 1), ("fold_b", 1 + _HALF)))


def _print(*parts: Column) -> Column:
    return F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))


def fingerprint_parts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(part, n_rows, fingerprint)``: by the values of ``by`` as text, else by the first byte of the row's digest.

    Equal for the same rows in any order, partitioning or column order. With ``by`` a changed value shows in its own
    part; without, in the parts the row left and entered. Combines before the shuffle: a hot part costs no more.
    """
    names = sorted(df.columns)
    digest = row_digest([col(c) for c in names])
    part = F.concat_ws("|", *[_text(col(c)) for c in by]) if by else F.substring(digest, 1, 2)
    rows = df.select(part.alias("part"), digest.alias("digest"))
    grouped = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n_rows"), *_folds(F.col("digest")))
    return grouped.select("part", "n_rows", _print(F.col("n_rows"), F.col("fold_a"), F.col("fold_b")).alias("fingerprint"))


def fold_parts(parts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(n_rows, fingerprint)`` of a table from those of its parts and its column names."""
    leaf = row_digest([F.col("part"), F.col("n_rows"), F.col("fingerprint")])
    total = parts.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"), *_folds(leaf))
    return total.select("n_rows", _print(
        F.lit(",".join(sorted(columns))), F.col("n_rows"), F.col("fold_a"), F.col("fold_b")).alias("fingerprint"))


def fingerprint(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row ``(n_rows, fingerprint)``: the fold of the parts. An empty table has zero rows."""
    return fold_parts(fingerprint_parts(df, by), df.columns)


def changed_parts(before: DataFrame, after: DataFrame) -> DataFrame:
    """``(part, n_before, n_after)`` of the parts, from ``fingerprint_parts``, that differ, came or went."""
    old = before.select("part", F.col("n_rows").alias("n_before"), F.col("fingerprint").alias("was"))
    new = after.select("part", F.col("n_rows").alias("n_after"), F.col("fingerprint").alias("now"))
    return old.join(new, "part", "full").where(~F.col("was").eqNullSafe(F.col("now"))).select("part", "n_before", "n_after")


def lineage_rows(run_id: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(run_id, table_name, n_rows, fingerprint)`` for the tables behind a run."""
    parts = [
        fingerprint(df).select(F.lit(run_id).alias("run_id"), F.lit(name).alias("table_name"), "*")
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
