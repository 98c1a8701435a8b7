"""From a landed text batch to a new master version."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import Contract
from tidemark.functions.missing import col
from tidemark.operators import contract as check
from tidemark.operators.linked import LinkedFileError, link_images
from tidemark.sources.master import Commit, MasterTable
from tidemark.sources.tabular import POSITION, cast_to_contract


@dataclass(frozen=True)
class BatchResult:
    batch_id: str
    rows_batch: int
    rows_added: int
    rows_rejected: int
    images_processed: int
    commit: Commit


def validate_files(raw: DataFrame, contract: Contract) -> None:
    """Check every file of a batch on its own; raise on the first violation.

    One aggregate per file and rule set, one shuffle for the keys. Only files
    with violations come back.
    """
    data = [c for c in raw.columns if c not in POSITION]
    problems = check.column_problems(data, list(contract.columns))
    if problems:
        check.raise_first([], problems, contract)
    rules = check.contract_rules(raw, contract)
    report = check.rule_report(raw, rules, by=["file_name"], examples=False)
    bad = report.where(F.col("n_bad") > 0)
    name = bad.agg(F.min("file_name").alias("n")).first()["n"]
    if name is not None:
        order = {(r.rule, r.column): i for i, r in enumerate(rules)}
        found = bad.where(F.col("file_name") == name).collect()  # one row per rule
        found.sort(key=lambda r: order[r["rule"], r["column"]])
        error = check.ContractTypeViolation if found[0]["rule"] == "type" else check.ContractViolation
        raise error(f"{name}: {[(r['rule'], r['column'], r['n_bad']) for r in found]}")
    if contract.primary_key:
        twice = check.duplicate_keys(raw, ["file_name", *contract.primary_key]).limit(10).collect()
        if twice:
            raise check.ContractViolation(f"duplicate primary keys, for example {[tuple(r) for r in twice]}")
    _check_target(contract)


def _check_target(contract: Contract) -> None:
    problem = contract.target_problem()
    if problem:
        raise check.ContractViolation(problem)


def flag_rejects(raw: DataFrame, contract: Contract) -> DataFrame:
    """``raw`` with the ``violations`` of each row; every copy of a key that a file repeats has one."""
    flagged = check.flag_rows(raw, check.contract_rules(raw, contract))
    if not contract.primary_key:
        return flagged
    key = ["file_name", *contract.primary_key]
    twice = check.duplicate_keys(raw, key).select(
        *[col(k).alias(f"__key_{i}") for i, k in enumerate(key)], F.lit(f"pk_unique:{','.join(contract.primary_key)}").alias("__twice"))
    match = [col(k).eqNullSafe(F.col(f"__key_{i}")) for i, k in enumerate(key)]
    return flagged.join(twice, match, "left").select(
        *[col(c) for c in raw.columns],
        F.array_compact(F.array_append("violations", F.col("__twice"))).alias("violations"))


def preprocess_batch(
    raw: DataFrame,
    batch_id: str,
    contract: Contract,
    master: MasterTable,
    images: DataFrame | None = None,
    rejects_path: str | None = None,
) -> BatchResult:
    """Validate, link images, merge into the master.

    ``raw`` is a text table with its position columns. Bad rows fail the batch;
    with ``rejects_path`` they are written there instead, with the rules they
    break, and the rest goes on. Both ways check the same: a key that a file
    repeats is bad in all its rows. A batch id that is committed already changes
    nothing.
    """
    if raw.isEmpty():
        raise check.ContractViolation("input is empty")
    rejected_rows = 0
    if rejects_path is None:
        validate_files(raw, contract)
        good = raw
    else:
        problems = check.column_problems([c for c in raw.columns if c not in POSITION], list(contract.columns))
        if problems:
            check.raise_first([], problems, contract)
        _check_target(contract)
        flagged = flag_rejects(raw, contract)
        good = flagged.where(F.size("violations") == 0).drop("violations")
        bad = flagged.where(F.size("violations") > 0)
        target = f"{rejects_path}/batch_id={batch_id}"
        bad.write.mode("overwrite").parquet(target)
        rejected_rows = bad.sparkSession.read.schema(bad.schema).parquet(target).count()
    typed = cast_to_contract(good, contract)
    linked, n_images = _link(typed, images, contract)
    commit = master.upsert(linked, batch_id, list(POSITION), transient=list(POSITION))
    return BatchResult(
        batch_id, commit.rows_batch, commit.rows_added, rejected_rows, n_images, commit
    )


def _link(df: DataFrame, images: DataFrame | None, contract: Contract) -> tuple[DataFrame, int]:
    external = contract.external_columns()
    if not external:
        return df, 0
    if images is not None:
        linked, mapping = link_images(df, images, contract)
        return linked, mapping.count()
    mentioned = df.where(F.coalesce(*[col(c).cast("string") for c in external]).isNotNull())
    if not mentioned.isEmpty():
        raise LinkedFileError("the batch names image files but has none")
    return df.withColumns({e.path_column: F.lit(None).cast("string") for e in external.values()}), 0
