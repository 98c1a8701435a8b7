"""Order-dependent operators that split long series.

A window over one series runs in one task. Series too long for that are found
first; their rows are cut into chunks along the ordering column, each
``(series, chunk)`` is processed on its own, and what a chunk needs from its
predecessors comes from a small table with one row per long series and chunk.
Short series take the plain window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.buckets import bucket_index
from tidemark.functions.joins import measured
from tidemark.functions.missing import col

ROWS_PER_CHUNK = 4_000_000
MAX_CHUNKS = 8192


@dataclass(frozen=True)
class Chunks:
    """The long series (their key columns) and the cut points of the ordering column."""

    series: DataFrame | None  # None: the frame is one long series
    cuts: Sequence[str]
    dtype: str

    def index(self, value: Column) -> Column:
        # One folded array literal, however many cut points there are.
        table = F.split(F.lit("\n".join(self.cuts)), "\n").cast(f"array<{self.dtype}>")
        return F.coalesce(bucket_index(value, table, len(self.cuts)), F.lit(-1))


def find_chunks(
    df: DataFrame, by: Sequence[str], order: str, rows_per_chunk: int = ROWS_PER_CHUNK
) -> Chunks | None:
    """Which series to cut and where; None if every series is short.

    Small frames cost one count. Otherwise rows are counted per series and the
    ordering column of the long ones is sketched; long series are few, since
    each holds more than ``rows_per_chunk`` rows. Cut points are quantiles, so
    chunks are even whatever the distribution over time.
    """
    total = df.count()
    if total <= rows_per_chunk:
        return None
    rows, long_series = df, None
    if by:
        counts = df.groupBy(*[col(b) for b in by]).agg(F.count(F.lit(1)).alias("__n"))
        counted = measured(
            counts.where(F.col("__n") > rows_per_chunk)
            .select(*[col(b).alias(f"__long_{i}") for i, b in enumerate(by)], "__n")
        )
        total = counted.agg(F.sum("__n").alias("n")).first()["n"]
        if total is None:
            return None
        long_series = counted.drop("__n")
        rows = df.join(long_series, _same(by, "__long_"), "left_semi")
    chunks = min(MAX_CHUNKS, -(-total // rows_per_chunk))
    grid = [i / chunks for i in range(1, chunks)]
    sketch = F.percentile_approx(col(order), grid, 10 * chunks)
    cuts = rows.agg(F.transform(sketch, lambda x: x.cast("string")).alias("c")).first()["c"]
    if not cuts:
        return None
    return Chunks(long_series, list(dict.fromkeys(cuts)), df.schema[order].dataType.simpleString())


def _same(by: Sequence[str], prefix: str) -> list[Column]:
    return [col(b).eqNullSafe(F.col(f"{prefix}{i}")) for i, b in enumerate(by)]


def last_before(
    df: DataFrame,
    values: Mapping[str, Column],
    *,
    by: Sequence[str],
    order: Sequence[str],
    inclusive: bool = False,
    chunks: Chunks | None = None,
) -> DataFrame:
    """Add, per name, the latest non-null value among the preceding rows of the series.

    ``inclusive`` lets a row see its own value (forward fill); otherwise it sees
    earlier rows only (a lag over non-null values). ``chunks`` comes from
    ``find_chunks`` on the same series and ``order[0]``.
    """
    span = (Window.unboundedPreceding, 0 if inclusive else -1)
    keys = [col(b) for b in by]
    in_order = [col(o) for o in order]
    if chunks is None:
        frame = Window.partitionBy(*keys).orderBy(*in_order).rowsBetween(*span)
        return df.withColumns({n: F.last(v, ignorenulls=True).over(frame) for n, v in values.items()})

    staged = df.withColumns({f"__v_{n}": v for n, v in values.items()})
    if chunks.series is None:
        is_long = F.lit(True)
    else:
        staged = staged.join(
            chunks.series.withColumn("__long", F.lit(True)), _same(by, "__long_"), "left"
        )
        is_long = F.col("__long").isNotNull()
    # Null: a short series, one chunk.
    staged = staged.withColumn("__chunk", F.when(is_long, chunks.index(in_order[0])))

    # A bare fixed-width column keeps this a hash aggregate.
    position = in_order[0] if len(order) == 1 else F.struct(*in_order)
    tails = staged.where(F.col("__chunk").isNotNull()).groupBy(*keys, "__chunk").agg(
        *[
            F.max_by(f"__v_{n}", F.when(F.col(f"__v_{n}").isNotNull(), position)).alias(f"__t_{n}")
            for n in values
        ]
    )
    earlier = (
        Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = measured(
        tails.select(
            *[col(b).alias(f"__by_{i}") for i, b in enumerate(by)],
            F.col("__chunk").alias("__at"),
            *[F.last(f"__t_{n}", ignorenulls=True).over(earlier).alias(f"__c_{n}") for n in values],
        )
    )
    joined = staged.join(carry, [*_same(by, "__by_"), F.col("__chunk") == F.col("__at")], "left")
    frame = Window.partitionBy(*keys, F.col("__chunk")).orderBy(*in_order).rowsBetween(*span)
    found = joined.withColumns(
        {
            n: F.coalesce(F.last(f"__v_{n}", ignorenulls=True).over(frame), F.col(f"__c_{n}"))
            for n in values
        }
    )
    return found.select(*[col(c) for c in df.columns if c not in values], *values)


def forward_fill(
    df: DataFrame,
    columns: Sequence[str],
    *,
    order: Sequence[str],
    by: Sequence[str] = (),
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Replace missing cells by the latest earlier value of the series."""
    filled = last_before(
        df, {f"__ff_{c}": col(c) for c in columns}, by=by, order=order, inclusive=True,
        chunks=find_chunks(df, by, order[0], rows_per_chunk),
    )
    return filled.select(
        *[F.col(f"__ff_{c}").alias(c) if c in columns else col(c) for c in df.columns]
    )
