"""Labels of periods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quarter_label(year: Column, quarter: Column) -> Column:
    """``YYYY-Qn``."""
    return F.format_string("%d-Q%d", year.cast("int"), quarter.cast("int"))
