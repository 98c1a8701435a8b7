from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.config import ColumnRule, Contract, Feature, FeatureSchema
from tidemark.operators import contract as check

MOCK = Contract(
    columns={
        "id": ColumnRule("int", non_nullable=True),
        "value": ColumnRule("float", non_nullable=True, min=0, max=10),
        "category": ColumnRule("string", allowed_values=("A", "B")),
    },
    primary_key=("id",),
    target="value",
)
SCHEMA = "id bigint, value double, category string"
GOOD = [(1, 1.0, "A"), (2, 2.0, "B"), (3, 3.0, None)]


def bad_counts(df, contract=MOCK):
    return {(r["rule"], r["column"]): r["n_bad"] for r in check.contract_report(df, contract).collect() if r["n_bad"]}


def test_valid_batch_passes(spark):
    assert check.assert_valid(spark.createDataFrame(GOOD, SCHEMA), MOCK) == 3


@pytest.mark.parametrize(
    "data, schema, error, text",
    [
        ([(1, 1.0)], "id bigint, value double", check.ContractViolation, "missing_column"),
        ([(1, 1.0, "A", 2)], SCHEMA + ", more int", check.ContractViolation, "unexpected_column"),
        ([("x", 1.0, "A")], "id string, value double, category string", TypeError, "type"),
        ([(1, -1.0, "A")], SCHEMA, check.ContractViolation, "min"),
        ([(1, 11.0, "A")], SCHEMA, check.ContractViolation, "max"),
        ([(1, 1.0, "C")], SCHEMA, check.ContractViolation, "allowed_values"),
        ([(1, None, "A")], SCHEMA, check.ContractViolation, "not_null"),
        ([(1, float("nan"), "A")], SCHEMA, check.ContractViolation, "not_null"),
        ([(1, 1.0, "A"), (1, 2.0, "B")], SCHEMA, check.ContractViolation, "pk_unique"),
        ([], SCHEMA, check.ContractViolation, "empty"),
    ],
)
def test_first_violation_raises(spark, data, schema, error, text):
    with pytest.raises(error, match=text):
        check.assert_valid(spark.createDataFrame(data, schema), MOCK)


def test_unexpected_columns_pass_when_not_strict(spark):
    df = spark.createDataFrame([(1, 1.0, "A", 2)], SCHEMA + ", more int")
    assert check.assert_valid(df, MOCK, strict=False) == 1


def test_target_definition_is_checked(spark):
    loose = Contract(columns={**MOCK.columns, "value": ColumnRule("float")}, target="value")
    with pytest.raises(check.ContractViolation, match="non_nullable"):
        check.assert_valid(spark.createDataFrame(GOOD, SCHEMA), loose)


def test_sample_batch_lacks_seven_contract_columns(spark):
    from tidemark.defaults import CONTRACT_V1

    present = [c for c in CONTRACT_V1.columns if c in {
        "data_id", "country", "year", "deflated_gdp_usd", "us_cpi", "developed_country", "landlocked",
        "access_to_airport", "access_to_highway", "access_to_port", "access_to_railway",
        "flood_risk_class", "region_economic_classification", "seismic_hazard_zone",
        "straight_distance_to_capital_km", "quarter_label"}]
    df = spark.createDataFrame([tuple("x" for _ in present)], present)
    problems = check.column_problems(df.columns, list(CONTRACT_V1.columns))
    assert [p[0] for p in problems] == ["missing_column"] * 7


def test_text_types(spark):
    contract = Contract(columns={"i": ColumnRule("int"), "f": ColumnRule("float"), "s": ColumnRule("string")})
    data = [("1", "1.5", "a"), ("2.0", "1e3", None), ("2.5", "1d", ""), ("x", "0x10", "é"),
            ("inf", "inf", "b"), (None, "nan", "c"), (" 7 ", "-.5", "d")]
    df = spark.createDataFrame(data, "i string, f string, s string")
    assert bad_counts(df, contract) == {("type", "i"): 3, ("type", "f"): 2}


def test_nan_is_missing_for_ranges(spark):
    contract = Contract(columns={"x": ColumnRule("float", min=0, max=5)})
    df = spark.createDataFrame([(float("nan"),), (None,), (float("inf"),), (-0.0,), (-1.0,)], "x double")
    assert bad_counts(df, contract) == {("min", "x"): 1, ("max", "x"): 1}


def test_all_null_string_column_is_fine(spark):
    contract = Contract(columns={"s": ColumnRule("string", format="a+")})
    assert bad_counts(spark.createDataFrame([(None,)], "s string"), contract) == {}


def test_format_is_a_unicode_full_match(spark):
    contract = Contract(columns={"s": ColumnRule("string", format=r"^\w+$")})
    df = spark.createDataFrame([("é",), ("ab\n",), ("a b",), ("ok",)], "s string")
    assert bad_counts(df, contract) == {("format", "s"): 2}


def test_more_rules_than_one_pass_holds(spark):
    wide = Contract(columns={f"c{i}": ColumnRule("int", min=0) for i in range(100)})
    df = spark.createDataFrame([tuple(range(-1, 99))], ", ".join(f"c{i} bigint" for i in range(100)))
    report = check.rule_report(df, check.contract_rules(df, wide)).collect()
    assert len(report) == 200 and sum(r["n_bad"] for r in report) == 1


def test_duplicate_rows_lists_every_copy(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d"), (2, "e")], "k bigint, v string")
    assert rows(check.duplicate_rows(df, ["k"]).select("v")) == [("a",), ("b",), ("c",), ("d",)]
    assert rows(check.duplicate_keys(df, ["k"])) == [(1, 2), (None, 2)]


def test_valid_and_rejected_make_up_the_input(spark):
    df = spark.createDataFrame(GOOD + [(None, 99.0, "Z")], SCHEMA)
    valid, rejected = check.split_valid(df, check.contract_rules(df, MOCK))
    assert valid.count() == 3
    found = rejected.collect()
    assert found[0]["violations"] == ["not_null:id", "max:value", "allowed_values:category", "pk_null:id"]


def test_offending_values(spark):
    df = spark.createDataFrame([(1, 1.0, "Z"), (2, 1.0, "Z"), (3, 1.0, "A"), (4, 1.0, None)], SCHEMA)
    assert rows(check.offending_values(df, MOCK, "category", "allowed_values")) == [("Z", 2)]


FEATURES = FeatureSchema(
    (
        Feature("x", "numeric"),
        Feature("y", "numeric", impute="mean"),
        Feature("level", "categorical", encoding="ordinal", order=("low", "high")),
    )
)


def test_feature_frame(spark):
    df = spark.createDataFrame(
        [(1.0, None, "low"), (None, 1.0, "odd"), (float("nan"), 1.0, None)], "x double, y double, level string"
    )
    report = {(r["rule"], r["column"]): r["n_bad"] for r in check.feature_frame_report(df, FEATURES).collect()}
    assert report == {("missing_unimputed", "x"): 2, ("in_order", "level"): 1, ("missing_unimputed", "level"): 1}
    with pytest.raises(check.ContractViolation, match="missing_unimputed"):
        check.assert_feature_frame(df, FEATURES)
    with pytest.raises(check.ContractViolation, match="missing_column"):
        check.assert_feature_frame(df.drop("x"), FEATURES)
    with pytest.raises(TypeError):
        check.assert_feature_frame(df.withColumn("x", F.lit("t")), FEATURES)


def test_scoring_input(spark):
    contract = Contract(
        columns={
            "x": ColumnRule("float", min=0, max=10),
            "level": ColumnRule("string", allowed_values=("low", "high")),
            "code": ColumnRule("string", format=r"^[a-z]+$"),
        }
    )
    schema = FeatureSchema(
        (
            Feature("x", "numeric", impute="median"),
            Feature("level", "categorical", encoding="binary"),
            Feature("code", "categorical", impute="most_frequent", encoding="onehot"),
        )
    )
    df = spark.createDataFrame(
        [(1, 1.0, "low", "ab"), (2, None, "low", None), (3, 11.0, "low", "a"), (4, 1.0, None, "a"),
         (5, 1.0, "mid", "a"), (6, 1.0, "high", "A1"), (7, 1.0, "high", "ab\n")],
        "n int, x double, level string, code string",
    )
    valid, rejected = check.split_scoring_input(df, schema, contract)
    assert rows(valid.select("n")) == [(1,), (2,)]
    assert {r["n"]: r["violations"] for r in rejected.collect()} == {
        3: ["max:x"], 4: ["required:level"], 5: ["allowed_values:level"], 6: ["format:code"], 7: ["format:code"],
    }
