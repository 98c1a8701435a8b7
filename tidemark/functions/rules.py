"""Row rules as boolean columns: true marks an offending row."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import ColumnRule
from tidemark.functions.missing import as_number, col, is_missing, is_numeric


@dataclass(frozen=True)
class RowRule:
    rule: str
    column: str
    bad: Column

    @property
    def tag(self) -> str:
        return f"{self.rule}:{self.column}"


def full_match(text: Column, pattern: str) -> Column:
    """Whole-string match with Unicode character classes."""
    return text.rlike(r"(?U)\A(?:" + pattern + r")\z")


def search_match(text: Column, pattern: str) -> Column:
    """Unanchored match; a closing ``$`` means the very end of the text."""
    if re.search(r"(?<!\\)(?:\\\\)*\$\Z", pattern):
        pattern = pattern[:-1] + r"\z"
    return text.rlike("(?U)" + pattern)


def type_violation(df: DataFrame, name: str, expected: str) -> Column:
    """Non-missing cells that do not read as the declared type."""
    dtype = df.schema[name].dataType
    there = ~is_missing(df, name)
    if expected == "string":
        return F.lit(False) if isinstance(dtype, T.StringType) else there
    if isinstance(dtype, T.IntegralType):
        return F.lit(False)
    if not (is_numeric(dtype) or isinstance(dtype, T.StringType)):
        return there
    number = as_number(df, name)
    # CSV text such as "nan" is missing, not mistyped.
    unreadable = there & number.isNull() & (F.lower(col(name).cast("string")) != "nan")
    if expected == "float":
        return F.coalesce(unreadable, F.lit(False))
    infinite = F.abs(number) == F.lit(float("inf"))
    return F.coalesce(unreadable | infinite | (number % 1 != 0), F.lit(False))


def column_rules(df: DataFrame, name: str, rule: ColumnRule) -> list[RowRule]:
    """The rules of one contract column, in checking order."""
    there = ~is_missing(df, name)
    out: list[RowRule] = []

    def add(kind: str, bad: Column) -> None:
        out.append(RowRule(kind, name, F.coalesce(bad, F.lit(False))))

    if rule.non_nullable:
        add("not_null", is_missing(df, name))
    add("type", type_violation(df, name, rule.type))
    if rule.min is not None:
        add("min", as_number(df, name) < F.lit(rule.min))
    if rule.max is not None:
        add("max", as_number(df, name) > F.lit(rule.max))
    if rule.allowed_values is not None:
        add("allowed_values", there & ~col(name).isin(*rule.allowed_values))
    if rule.format is not None:
        add("format", there & ~full_match(col(name).cast("string"), rule.format))
    return out
