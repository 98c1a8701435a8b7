"""Union, de-duplication and keep-last upsert into a master table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.functions.missing import col, fold_missing, present


def assert_same_columns(batch: DataFrame, master: DataFrame) -> None:
    if set(batch.columns) != set(master.columns):
        raise ValueError(
            "batch and master columns differ: "
            f"only in batch {sorted(set(batch.columns) - set(master.columns))}, "
            f"only in master {sorted(set(master.columns) - set(batch.columns))}"
        )


def union_all(master: DataFrame, batch: DataFrame) -> DataFrame:
    """Master rows then batch rows, by column name, in master column order."""
    assert_same_columns(batch, master)
    return master.unionByName(batch)


def drop_duplicates(
    df: DataFrame,
    subset: Sequence[str] | None,
    keep: str,
    order_by: Sequence[Column],
) -> DataFrame:
    """Keep the first, the last or none of the rows that share ``subset``.

    ``order_by`` fixes what first and last mean. Spark ranks inside each task
    before the shuffle (WindowGroupLimit), and counts combine map-side, so a key
    that owns a third of the rows still sends one row per task. Null and NaN
    keys equal each other.
    """
    keys = list(subset) if subset is not None else list(df.columns)
    if keep == "none":
        return _drop_all_copies(df, keys)
    if keep not in ("first", "last"):
        raise ValueError(f"unsupported keep {keep!r}")
    if not order_by:
        raise ValueError(f"keep {keep!r} needs an order")
    order = [c.desc_nulls_last() if keep == "last" else c.asc_nulls_first() for c in order_by]
    ranked = df.withColumn(
        "__rank", F.row_number().over(Window.partitionBy(*[present(df, k) for k in keys]).orderBy(*order))
    )
    return ranked.where(F.col("__rank") == 1).drop("__rank")


def _drop_all_copies(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs once, by partial counts instead of a window."""
    # Only single-row groups survive, so any row stands for its group.
    grouped = df.groupBy(*[present(df, k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(
        F.count(F.lit(1)).alias("__n"), F.any_value(F.struct(*[col(c) for c in df.columns])).alias("__row")
    )
    return grouped.where(F.col("__n") == 1).select(*[F.col("__row").getField(c).alias(c) for c in df.columns])


def upsert(
    master: DataFrame,
    batch: DataFrame,
    key: Sequence[str] | None,
    keep: str | None,
    batch_order: Sequence[str] = (),
) -> DataFrame:
    """Master after the batch, equal to de-duplicating their union.

    ``master`` must already be unique on ``key``; its rows count as earlier than
    any batch row. ``batch_order`` names the columns that rank batch rows among
    themselves; those the master lacks are dropped after ranking.

    The batch is de-duplicated on its own first; then one anti-join removes what
    it replaces, so the master is not shuffled while the batch fits a broadcast,
    and a hot key meets at most one row on each side.
    """
    transient = [c for c in batch_order if c not in master.columns]
    assert_same_columns(batch.drop(*transient), master)
    columns = [col(c) for c in master.columns]
    if keep is None:
        return master.unionByName(batch.select(*columns))
    keys = list(key) if key is not None else list(master.columns)
    if keep == "none":
        # A key present on both sides, or twice in the batch, vanishes.
        batch = batch.select(*columns)
        singles = drop_duplicates(batch, keys, "none", [])
        return _without(master, batch, keys).unionByName(_without(singles, master, keys))
    chosen = drop_duplicates(batch, keys, keep, [col(c) for c in batch_order]).select(*columns)
    if keep == "last":
        return _without(master, chosen, keys).unionByName(chosen)
    return master.unionByName(_without(chosen, master, keys))


def _without(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right`` (null and NaN keys match each other)."""
    probe = fold_missing(right.select(*[col(k) for k in keys])).distinct()
    probe = probe.select(*[col(k).alias(f"__k{i}") for i, k in enumerate(keys)])
    match = [present(left, k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    return left.join(probe, match, "left_anti")


def upsert_metrics(master: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: rows before, rows in the batch, rows added, rows after (keep first/last).

    One shuffle of partially counted keys covers all four numbers. Null and NaN
    keys are one key, as in ``upsert``.
    """
    def keyed(df: DataFrame, m: int, b: int) -> DataFrame:
        return df.select(*[present(df, k).alias(k) for k in key], F.lit(m).alias("m"), F.lit(b).alias("b"))

    tagged = keyed(master, 1, 0).unionByName(keyed(batch, 0, 1))
    per_key = tagged.groupBy(*[col(k) for k in key]).agg(F.sum("m").alias("m"), F.sum("b").alias("b"))
    total = per_key.agg(
        F.coalesce(F.sum("m"), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("b"), F.lit(0)).alias("rows_batch"),
        F.count_if(F.col("m") == 0).alias("new_keys"),
        F.count(F.lit(1)).alias("rows_after"),
    )
    return total.select(
        "rows_before", "rows_batch",
        (F.col("rows_after") - F.col("rows_before")).alias("rows_added"), "rows_after",
    )
