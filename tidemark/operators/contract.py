"""Data-contract checks: one aggregate pass for all row rules, one shuffle for the key.

Every check is available as a violation table ``(rule, column, n_rows, n_bad,
example)``; ``assert_valid`` turns the first violation into an exception and
``split_valid`` separates good rows from bad ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import Contract, FeatureSchema
from tidemark.functions.missing import as_number, col, is_missing, is_numeric
from tidemark.functions.rules import RowRule, column_rules, search_match, type_violation

REPORT_SCHEMA = "rule string, column string, n_rows bigint, n_bad bigint, example string"

# A generated method beyond 64 KB runs interpreted, so wide contracts are
# aggregated in slices of this many rules.
RULES_PER_PASS = 150


class ContractViolation(ValueError):
    """Rows or columns break the contract."""


class ContractTypeViolation(ContractViolation, TypeError):
    """A column does not read as its declared type."""


# --- columns ---------------------------------------------------------------


def column_problems(
    actual: Sequence[str], expected: Sequence[str], strict: bool = True
) -> list[tuple[str, str]]:
    """``(rule, column)`` for every missing and, if strict, unexpected column."""
    problems = [("missing_column", c) for c in expected if c not in set(actual)]
    if strict:
        problems += [("unexpected_column", c) for c in actual if c not in set(expected)]
    return problems


def column_report(df: DataFrame, expected: Sequence[str], strict: bool = True) -> DataFrame:
    """Column problems with the row count, shaped like the violation table."""
    problems = column_problems(df.columns, expected, strict)
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"))
    if not problems:
        return counted.where(F.lit(False)).select(
            F.lit("").alias("rule"), F.lit("").alias("column"), "n_rows",
            F.col("n_rows").alias("n_bad"), F.lit(None).cast("string").alias("example"),
        )
    rows = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(c).alias("column")) for r, c in problems])
    return counted.select(F.explode(rows).alias("p"), "n_rows").select(
        "p.rule", "p.column", "n_rows", F.col("n_rows").alias("n_bad"),
        F.lit(None).cast("string").alias("example"),
    )


# --- row rules -------------------------------------------------------------


def contract_rules(df: DataFrame, contract: Contract) -> list[RowRule]:
    """Every row-level rule the frame can be checked for, in contract order."""
    rules: list[RowRule] = []
    for name, spec in contract.columns.items():
        if name in df.columns:
            rules += column_rules(df, name, spec)
    key = [c for c in contract.primary_key if c in df.columns]
    if key:
        any_missing = is_missing(df, key[0])
        for c in key[1:]:
            any_missing = any_missing | is_missing(df, c)
        rules.append(RowRule("pk_null", ",".join(contract.primary_key), any_missing))
    return rules


def rule_report(
    df: DataFrame, rules: Sequence[RowRule], by: Sequence[str] = (), examples: bool = True
) -> DataFrame:
    """Count the offenders of all rules in one pass over ``df``, per group if asked.

    ``example`` is the smallest offending value, so its size does not grow with
    the number of offenders; null if not asked for.
    """
    if not rules:
        raise ValueError("no rules to check")
    parts = [
        _report_slice(df, rules[i : i + RULES_PER_PASS], by, examples)
        for i in range(0, len(rules), RULES_PER_PASS)
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def _report_slice(
    df: DataFrame, rules: Sequence[RowRule], by: Sequence[str], examples: bool
) -> DataFrame:
    aggregates = [F.count(F.lit(1)).alias("n_rows")]
    shown: list[Column] = []
    for i, r in enumerate(rules):
        aggregates.append(F.count_if(r.bad).alias(f"bad_{i}"))
        if examples and r.rule not in ("not_null", "pk_null", "missing_unimputed"):
            aggregates.append(F.min(F.when(r.bad, col(r.column).cast("string"))).alias(f"ex_{i}"))
            shown.append(F.col(f"ex_{i}"))
        else:
            shown.append(F.lit(None).cast("string"))
    rows = F.array(
        *[
            F.struct(
                F.lit(r.rule).alias("rule"),
                F.lit(r.column).alias("column"),
                F.col("n_rows"),
                F.col(f"bad_{i}").alias("n_bad"),
                shown[i].alias("example"),
            )
            for i, r in enumerate(rules)
        ]
    )
    keys = [col(b) for b in by]
    totals = df.groupBy(*keys).agg(*aggregates) if by else df.agg(*aggregates)
    return totals.select(*keys, F.inline(rows))


# --- primary key -----------------------------------------------------------


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with ``n_copies``.

    Counts are combined before the shuffle, so a hot key costs one row per task.
    """
    counts = df.groupBy(*[col(k) for k in key]).agg(F.count(F.lit(1)).alias("n_copies"))
    return counts.where(F.col("n_copies") > 1)


def duplicate_rows(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """All rows of duplicated keys (every copy, nulls equal nulls)."""
    dup = duplicate_keys(df, key).select(*[col(k).alias(f"__dup_{i}") for i, k in enumerate(key)])
    match = [col(k).eqNullSafe(F.col(f"__dup_{i}")) for i, k in enumerate(key)]
    return df.join(dup, match, "left_semi")


def key_report(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Violation row for key uniqueness; ``n_bad`` counts every copy."""
    counts = df.groupBy(*[col(k) for k in key]).agg(F.count(F.lit(1)).alias("n_copies"))
    dup = F.col("n_copies") > 1
    shown = F.concat_ws(",", *[col(k).cast("string") for k in key])
    return counts.agg(
        F.coalesce(F.sum("n_copies"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(dup, F.col("n_copies"))), F.lit(0)).alias("n_bad"),
        F.min(F.when(dup, shown)).alias("example"),
    ).select(
        F.lit("pk_unique").alias("rule"), F.lit(",".join(key)).alias("column"),
        "n_rows", "n_bad", "example",
    )


# --- whole contract --------------------------------------------------------


def contract_report(
    df: DataFrame, contract: Contract, strict: bool = True, examples: bool = True
) -> DataFrame:
    """The full violation table: columns, row rules, key nulls, key uniqueness."""
    report = rule_report(df, contract_rules(df, contract), examples=examples)
    if column_problems(df.columns, list(contract.columns), strict):
        report = column_report(df, list(contract.columns), strict).unionByName(report)
    if contract.primary_key and set(contract.primary_key) <= set(df.columns):
        report = report.unionByName(key_report(df, contract.primary_key))
    return report


def offending_values(df: DataFrame, contract: Contract, column: str, rule: str) -> DataFrame:
    """Every distinct value breaking one rule, with its row count."""
    for r in column_rules(df, column, contract.columns[column]):
        if r.rule == rule:
            return (
                df.where(r.bad).groupBy(col(column).alias("value"))
                .agg(F.count(F.lit(1)).alias("n_rows"))
            )
    raise ValueError(f"contract has no {rule!r} rule on {column!r}")


def assert_valid(df: DataFrame, contract: Contract, strict: bool = True) -> int:
    """Raise on the first violation, in contract order; return the row count."""
    problems = column_problems(df.columns, list(contract.columns), strict)
    if not problems:
        rows = contract_report(df, contract, strict).collect()  # one row per rule
    else:
        rows = []
        if df.isEmpty():
            raise ContractViolation("input is empty")
    return raise_first(rows, problems, contract)


def raise_first(rows: list, problems: list[tuple[str, str]], contract: Contract) -> int:
    """Turn collected report rows into the first exception of the checking order."""
    if not problems and (not rows or rows[0]["n_rows"] == 0):
        raise ContractViolation("input is empty")
    for kind in ("missing_column", "unexpected_column"):
        found = [c for r, c in problems if r == kind]
        if found:
            raise ContractViolation(f"{kind}: {found}")
    for row in rows:
        if row["n_bad"] > 0:
            error = ContractTypeViolation if row["rule"] == "type" else ContractViolation
            raise error(
                f"column {row['column']!r} breaks {row['rule']}: {row['n_bad']} of "
                f"{row['n_rows']} rows, for example {row['example']!r}"
            )
    target = contract.target_problem()
    if target:
        raise ContractViolation(target)
    return rows[0]["n_rows"]


def flag_rows(df: DataFrame, rules: Sequence[RowRule]) -> DataFrame:
    """Add ``violations``: the tags of the rules each row breaks."""
    tags = F.array(*[F.when(r.bad, F.lit(r.tag)) for r in rules])
    return df.withColumn("violations", F.array_compact(tags))


def split_valid(df: DataFrame, rules: Sequence[RowRule]) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)``; rejected rows carry their ``violations``."""
    flagged = flag_rows(df, rules)
    valid = flagged.where(F.size("violations") == 0).drop("violations")
    return valid, flagged.where(F.size("violations") > 0)


# --- features and scoring input --------------------------------------------


def feature_rules(df: DataFrame, schema: FeatureSchema) -> list[RowRule]:
    """Per-feature data checks of a training frame."""
    rules: list[RowRule] = []
    for f in schema.features:
        there = ~is_missing(df, f.name)
        if f.type == "numeric" and not is_numeric(df.schema[f.name].dataType):
            rules.append(RowRule("numeric", f.name, F.lit(True)))
        if f.order is not None and f.encoding in ("ordinal", "binary"):
            rules.append(RowRule("in_order", f.name, there & ~col(f.name).isin(*f.order)))
        if f.impute is None:
            rules.append(RowRule("missing_unimputed", f.name, ~there))
    return rules


def feature_frame_report(df: DataFrame, schema: FeatureSchema, strict: bool = False) -> DataFrame:
    """Violation table of a training frame; column problems come first."""
    problems = column_problems(df.columns, schema.names, strict)
    if any(r == "missing_column" for r, _ in problems):
        return column_report(df, schema.names, strict)
    rules = feature_rules(df, schema)
    report = rule_report(df, rules) if rules else None
    if problems or report is None:
        columns = column_report(df, schema.names, strict)
        report = columns if report is None else columns.unionByName(report)
    return report


def assert_feature_frame(df: DataFrame, schema: FeatureSchema, strict: bool = False) -> None:
    problems = column_problems(df.columns, schema.names, strict)
    if problems:
        raise ContractViolation(f"feature columns: {problems}")
    rules = feature_rules(df, schema)
    rows = rule_report(df, rules).collect() if rules else []
    if (rows and rows[0]["n_rows"] == 0) or (not rows and df.isEmpty()):
        raise ContractViolation("input is empty")
    for row in rows:
        if row["n_bad"]:
            error = ContractTypeViolation if row["rule"] == "numeric" else ContractViolation
            raise error(f"feature {row['column']!r} breaks {row['rule']}: {row['n_bad']} rows")


def scoring_rules(df: DataFrame, schema: FeatureSchema, contract: Contract) -> list[RowRule]:
    """Rules a scoring request must meet; a missing field passes if it is imputed."""
    rules: list[RowRule] = []
    for f in schema.features:
        spec = contract.columns[f.name]
        if f.name not in df.columns:
            if f.impute is None:
                rules.append(RowRule("required", f.name, F.lit(True)))
            continue
        there = ~is_missing(df, f.name)

        def add(kind: str, bad: Column, name: str = f.name) -> None:
            rules.append(RowRule(kind, name, F.coalesce(bad, F.lit(False))))

        if f.impute is None:
            add("required", ~there)
        if spec.allowed_values is not None:
            add("allowed_values", there & ~col(f.name).isin(*spec.allowed_values))
        else:
            add("type", type_violation(df, f.name, spec.type))
        if spec.type in ("int", "float"):
            if spec.min is not None:
                add("min", as_number(df, f.name) < F.lit(spec.min))
            if spec.max is not None:
                add("max", as_number(df, f.name) > F.lit(spec.max))
        if spec.format is not None:
            add("format", there & ~search_match(col(f.name).cast("string"), spec.format))
    return rules


def split_scoring_input(
    df: DataFrame, schema: FeatureSchema, contract: Contract
) -> tuple[DataFrame, DataFrame]:
    """Scoring rows that pass, and rejected rows with the rules they break."""
    return split_valid(df, scoring_rules(df, schema, contract))
