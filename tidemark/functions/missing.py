"""Missing values: NaN counts as null, CSV text tokens count as null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The text tokens a CSV cell may hold for "missing".
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# Java's parser also takes "1d" and "0x1p3"; a CSV number does not.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"


def col(name: str) -> Column:
    """Column by its literal name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def _is_floating(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.DoubleType, T.FloatType))


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def present(df: DataFrame, name: str) -> Column:
    """The column with NaN folded to null."""
    c = col(name)
    if _is_floating(df.schema[name].dataType):
        return F.nanvl(c, F.lit(None).cast(df.schema[name].dataType))
    return c


def is_missing(df: DataFrame, name: str) -> Column:
    c = col(name)
    if _is_floating(df.schema[name].dataType):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def fold_missing(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NaN → null in every floating column."""
    picked = df.columns if columns is None else columns
    folded = {n: present(df, n) for n in picked if _is_floating(df.schema[n].dataType)}
    return df.withColumns(folded) if folded else df


def na_tokens_to_null(df: DataFrame) -> DataFrame:
    """Text tokens for "missing" → null in every string column."""
    fixed = {
        f.name: F.when(~col(f.name).isin(*NA_TOKENS), col(f.name))
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType)
    }
    return df.withColumns(fixed) if fixed else df


def parse_number(text: Column) -> Column:
    """Number in a text cell, null where the text is no number."""
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))


def as_number(df: DataFrame, name: str) -> Column:
    """Numeric reading of a column of any type, NaN folded to null."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return parse_number(col(name))
    return present(df, name)
