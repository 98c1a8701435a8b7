"""Sorted boundaries: bucket lookup and cumulative histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket_index(value: Column, bounds: Sequence[Column] | Column, n: int | None = None) -> Column:
    """How many of the ascending ``bounds`` are <= ``value`` (binary search).

    ``bounds`` are single columns, or one array column of ``n`` elements.
    """
    if not isinstance(bounds, Column):
        n, bounds = len(bounds), F.array(*bounds) if bounds else F.array()
    if n is None:
        raise ValueError("an array of bounds needs its length")
    if n == 0:
        return F.when(value.isNotNull(), F.lit(0))
    table = bounds
    steps = [1 << k for k in reversed(range(n.bit_length()))]

    def advance(pos: Column, step: Column) -> Column:
        ahead = pos + step
        hit = (ahead <= n) & (F.get(table, ahead - 1) <= value)
        return F.when(hit, ahead).otherwise(pos)

    found = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), advance)
    return F.when(value.isNotNull(), found)


def cumulative_counts(value: Column, bounds: Sequence[float]) -> list[Column]:
    """One aggregate per upper bound: rows with ``value`` <= bound."""
    return [F.count_if(value <= F.lit(float(b))) for b in bounds]


def quantile_from_counts(q: float, bounds: Sequence[float], counts: Column, total: Column) -> Column:
    """Quantile from cumulative bucket counts, linear inside the bucket hit.

    ``counts`` is an array column aligned with ``bounds``; rows above the last
    bound are only in ``total``. A rank up there yields the last bound, an empty
    histogram yields null; the first bucket starts at 0 when its bound is
    positive.
    """
    uppers = F.array(*[F.lit(float(b)) for b in bounds])
    rank = F.lit(float(q)) * total
    hit = F.aggregate(
        counts, F.lit(0), lambda pos, c: F.when(c < rank, pos + 1).otherwise(pos)
    )  # counts ascend, so this is the index of the first bucket reaching the rank
    upper = F.get(uppers, hit)
    first = F.lit(0.0) if bounds[0] > 0 else F.lit(float(bounds[0]))
    lower = F.when(hit == 0, first).otherwise(F.get(uppers, hit - 1))
    below = F.when(hit == 0, F.lit(0)).otherwise(F.get(counts, hit - 1))
    inside = F.get(counts, hit) - below
    if bounds[0] <= 0:
        flat = hit == 0
    else:
        flat = F.lit(False)
    interpolated = F.when((inside == 0) | flat, upper).otherwise(
        lower + (upper - lower) * ((rank - below) / inside)
    )
    return (
        F.when(total == 0, F.lit(None).cast("double"))
        .when(hit >= len(bounds), F.lit(float(bounds[-1])))
        .otherwise(interpolated)
    )
