import pytest
from pyspark.sql import functions as F

from tallyloom.operators import contracts as C
from tallyloom.spec import TELCO

RAW = C.raw_contract(TELCO)


def found(df, rules=RAW):
    return {
        (r["column"], r["rule"]) for r in C.violations(df, rules, "customerID").collect()
    }


def test_valid_and_blank_total_pass(accounts):
    assert found(accounts({}, {"TotalCharges": " "}, {"TotalCharges": None})) == set()


@pytest.mark.parametrize(
    "override, expected",
    [
        ({"Churn": "Maybe"}, {("Churn", "one_of")}),
        ({"MonthlyCharges": "-0.5"}, {("MonthlyCharges", "in_range")}),
        ({"MonthlyCharges": "130"}, set()),
        ({"tenure": "73"}, {("tenure", "in_range")}),
        ({"tenure": "abc"}, {("tenure", "coercible")}),
        ({"SeniorCitizen": "5"}, {("SeniorCitizen", "one_of")}),
        ({"TotalCharges": "12x"}, {("TotalCharges", "number_or_blank")}),
        ({"gender": None}, {("gender", "not_null")}),
        ({"customerID": ""}, {("customerID", "non_empty")}),
    ],
)
def test_single_violations(accounts, override, expected):
    assert found(accounts(override)) == expected


def test_all_violations_are_collected(accounts):
    assert found(accounts({"Churn": "x", "gender": "y", "tenure": "-1"})) == {
        ("Churn", "one_of"),
        ("gender", "one_of"),
        ("tenure", "in_range"),
    }


def test_scoring_contract_takes_new_categories_and_wide_bounds(accounts):
    rules = C.scoring_contract(TELCO)
    df = accounts(
        {"PaymentMethod": "Cryptocurrency"},
        {"tenure": "120", "MonthlyCharges": "999", "TotalCharges": "199000"},
    )
    assert found(df, rules) == set()
    assert found(accounts({"TotalCharges": "200001"}), rules) == {("TotalCharges", "in_range")}


@pytest.mark.parametrize(
    "override",
    [
        {"tenure": "-4"},
        {"MonthlyCharges": "-0.5"},
        {"gender": "Unknown"},
        {"Contract": "Weekly"},
        {"SeniorCitizen": "3"},
        {"tenure": None},
        {"customer_id": "x" * 65},
    ],
)
def test_request_contract_rejects(accounts, override):
    given = {k: v for k, v in override.items() if k != "customer_id"}
    df = accounts(given).withColumn("customer_id", F.lit(override.get("customer_id", "a")))
    assert found(df, C.request_contract(TELCO))


def test_missing_column_is_an_error(accounts):
    with pytest.raises(C.MissingColumnsError, match="Contract"):
        C.violations(accounts({}).drop("Contract"), RAW, "customerID")
    with pytest.raises(C.MissingColumnsError, match="Contract"):
        C.require_columns(accounts({}).drop("Contract"), TELCO.features)


def test_fail_fast_and_empty_guards(accounts):
    with pytest.raises(C.ContractViolationError, match="1 violations"):
        C.require_valid(accounts({"Churn": "x"}), RAW, "customerID")
    with pytest.raises(ValueError, match="empty"):
        C.require_rows(accounts({}).limit(0))


def test_quarantine_keeps_every_row_and_names_errors(accounts):
    df = accounts({}, {"tenure": "-1", "gender": "?"}, {})
    judged = {r["customerID"]: r for r in C.with_verdict(df, RAW).collect()}
    assert judged["TEST-0000"]["ok"] and judged["TEST-0000"]["error"] is None
    assert judged["TEST-0001"]["error"] == "tenure: in_range; gender: one_of"
    good, bad = C.accept_and_quarantine(df, RAW)
    assert (good.count(), bad.count()) == (2, 1)


def test_unique_rule_reports_each_copy(accounts):
    df = accounts({}, {"customerID": "TEST-0000"}, {})
    rows = C.unique_violations(df, "customerID").collect()
    assert [r["value"] for r in rows] == ["TEST-0000", "TEST-0000"]


def test_unknown_keys_and_batch_size(spark):
    df = spark.createDataFrame([('{"a": 1, "ssn": 2}', [1, 2, 3])], "j string, items array<int>")
    assert df.select(C.unknown_keys(F.col("j"), ["a"])).first()[0] == ["ssn"]
    rules = [C.size_between("items", 1, 2)]
    assert not C.with_verdict(df, rules).first()["ok"]
    assert C.with_verdict(df, [C.size_between("items", 1, 3)]).first()["ok"]


def test_top_violations_are_ordered(accounts):
    report = C.violations(accounts(*[{"Churn": "x"}] * 30), RAW, "customerID")
    top = C.top_violations(report, "customerID").collect()
    assert [r["customerID"] for r in top] == [f"TEST-{i:04d}" for i in range(20)]
    assert C.violation_summary(report).first()["n"] == 30
