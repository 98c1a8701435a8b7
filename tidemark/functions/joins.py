"""Joins with a side whose size is looked at first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side with at most this many rows is shipped to every task.
BROADCAST_ROWS = 100_000


def measured(small: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The frame, computed now and marked for broadcast, if it has few rows.

    An aggregate has no size estimate, so a plain join would shuffle its large
    partner before finding out. A larger frame comes back as it is and joins by
    shuffle. Rows should be narrow: keys and a few values.
    """
    rows = small.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return small
    return F.broadcast(small.sparkSession.createDataFrame(rows, small.schema))

