import pytest
from pyspark.sql import functions as F

from tallyloom.functions import text as X
from tallyloom.functions.features import tenure_group
from tallyloom.operators.cleaning import clean, engineer, fill_categories, with_label
from tallyloom.spec import TELCO


def test_total_coercion_and_trim(accounts):
    df = accounts(
        {"TotalCharges": "100.5", "gender": " Male"},
        {"TotalCharges": ""},
        {"TotalCharges": None},
        {"TotalCharges": " 200 "},
    )
    rows = clean(df, TELCO).orderBy("customerID").collect()
    assert [r["TotalCharges"] for r in rows] == [100.5, None, None, 200.0]
    assert rows[0]["gender"] == "Male"


@pytest.mark.parametrize("text", ["nan", "1.5d", "<NA>", " ", "inf", "x", None])
def test_numbers_never_become_nan(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(X.to_number(F.col("t"))).first()[0] is None


def test_new_customer(accounts):
    row = engineer(
        clean(
            accounts({"tenure": "0", "TotalCharges": None, "InternetService": "DSL", "PhoneService": "Yes"}), TELCO
        ),
        TELCO,
    ).first()
    assert row["avg_monthly_charges"] is None
    assert (row["no_security_support"], row["service_count"]) == (1, 2)
    assert row["tenure_group"] == "0-12m"


def test_average_is_total_over_tenure_plus_one(accounts):
    row = engineer(clean(accounts({"tenure": "9", "TotalCharges": "50"}), TELCO), TELCO).first()
    assert row["avg_monthly_charges"] == 5.0


def test_missing_access_service_counts_as_a_service(accounts):
    row = engineer(clean(accounts({"InternetService": None, "PhoneService": "Yes", "OnlineBackup": "Yes"}), TELCO), TELCO).first()
    assert row["service_count"] == 3
    assert row["no_security_support"] == 1


@pytest.mark.parametrize(
    "months, group",
    [(0, "0-12m"), (12, "0-12m"), (13, "13-24m"), (24, "13-24m"), (25, "25-48m"), (48, "25-48m"),
     (49, "49m+"), (-1, None), (None, None)],
)
def test_tenure_bins_are_right_closed(spark, months, group):
    df = spark.createDataFrame([(months,)], "m int")
    assert df.select(tenure_group(F.col("m"))).first()[0] == group


def test_missing_categories_and_label(accounts):
    df = fill_categories(accounts({"gender": None, "Churn": None}), ["gender"])
    row = with_label(df, TELCO).first()
    assert (row["gender"], row["label"]) == ("missing", 0)


def test_pseudonym_hop_and_request_id(spark):
    df = spark.createDataFrame(
        [("a", " 1.2.3.4 , 5", "h", "r1"), ("", "", None, None), (None, None, "h", "")],
        "id string, fwd string, host string, rid string",
    )
    rows = df.select(
        X.pseudonym(F.col("id")).alias("p"),
        X.first_hop(F.col("fwd"), F.col("host")).alias("c"),
        X.request_id_or_new(F.col("rid")).alias("r"),
    ).collect()
    assert rows[0]["p"] == "ca978112ca1bbdca" and rows[1]["p"] is None and rows[2]["p"] is None
    assert [r["c"] for r in rows] == ["1.2.3.4", "unknown", "h"]
    assert rows[0]["r"] == "r1" and len(rows[1]["r"]) == 36 and rows[1]["r"] != rows[2]["r"]
