"""Golden rows: every null / blank / unknown case of the standardisation and
service-feature steps, with hand-computed expectations."""

import math

import pytest

from attrix.functions import columns as C
from attrix.operators.service import compute_service_features
from attrix.operators.standardise import demographic, standardise_customers
from attrix.sources.csv import RAW_CUSTOMER_SCHEMA

OPTS = C.OPTIONAL_SERVICE_COLUMNS


def raw_row(cid, tenure, monthly, total, opts, contract, churn, partner="Yes", senior=0):
    d = {c: None for c in RAW_CUSTOMER_SCHEMA.fieldNames()}
    d.update(customerID=cid, gender="Male", SeniorCitizen=senior, Partner=partner,
             Dependents="No", tenure=tenure, PhoneService="Yes", MultipleLines="No",
             InternetService="DSL", Contract=contract, PaperlessBilling="Yes",
             PaymentMethod="Mailed check", MonthlyCharges=monthly, TotalCharges=total, Churn=churn)
    for c, v in zip(OPTS, opts):
        d[c] = v
    return d


@pytest.fixture(scope="module")
def golden(spark):
    nis = "No internet service"
    rows = [
        raw_row("a1", 1, 29.85, "29.85", ["Yes", "No", "No", "No", "No", "No"], "Month-to-month", "No"),
        raw_row("a2", 0, 20.0, " ", [nis] * 6, "Two year", "No"),
        raw_row("a3", 10, 100.5, "900.25", ["Yes"] * 6, "One year", "Yes", senior=1),
        raw_row("a4", 5, 80.0, "", [None, "Yes", "Yes", "Yes", "No", "No"], "Weekly", None,
                partner=None),
    ]
    df = spark.createDataFrame(rows, RAW_CUSTOMER_SCHEMA)
    telco = standardise_customers(df)
    feats = compute_service_features(telco)
    return {r["customerID"]: r for r in telco.collect()}, {r["customerID"]: r for r in feats.collect()}


def test_contract_months_and_unknown(golden):
    telco, _ = golden
    assert telco["a1"]["Contract"] == 1
    assert telco["a2"]["Contract"] == 24
    assert telco["a3"]["Contract"] == 12
    assert telco["a4"]["Contract"] is None


def test_blank_total_becomes_null_then_zero(golden):
    telco, feats = golden
    assert telco["a2"]["TotalCharges"] is None
    assert telco["a4"]["TotalCharges"] is None
    assert feats["a2"]["TotalCharges"] == 0.0
    assert feats["a4"]["TotalCharges"] == 0.0
    assert telco["a1"]["TotalCharges"] == 29.85


def test_label_and_booleans(golden):
    telco, _ = golden
    assert [telco[k]["Churn"] for k in ("a1", "a2", "a3", "a4")] == [0, 0, 1, 0]
    assert telco["a4"]["Partner"] is None
    assert telco["a1"]["Partner"] is True
    assert telco["a3"]["SeniorCitizen"] is True and telco["a1"]["SeniorCitizen"] is False


def test_option_count_and_price_increase(golden):
    _, feats = golden
    assert [feats[k]["NumOptionalServices"] for k in ("a1", "a2", "a3", "a4")] == [1, 0, 6, 3]
    assert feats["a1"]["AvgPriceIncrease"] == pytest.approx(0.0)
    assert feats["a2"]["AvgPriceIncrease"] == 0.0
    assert feats["a3"]["AvgPriceIncrease"] == pytest.approx(100.5 - 900.25 / 10)
    # blank total filled with 0.0 before the ratio: increase = monthly charge
    assert feats["a4"]["AvgPriceIncrease"] == pytest.approx(80.0)


def test_service_columns_exclude_demographics(golden, spark):
    _, feats = golden
    cols = list(next(iter(feats.values())).asDict())
    for c in C.NON_SERVICE_COLUMNS:
        assert c not in cols
    assert cols[-2:] == ["NumOptionalServices", "AvgPriceIncrease"]
    assert len(cols) == 18


def test_pandas_udf_matches_native(spark):
    rows = [("Yes", None, "No", "Yes", "Yes", "No internet service"),
            (None, None, None, None, None, None), ("Yes",) * 6]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in OPTS))
    out = df.select(C.num_optional_services().alias("a"),
                    C.num_optional_services_udf(*OPTS).alias("b")).collect()
    assert [(r.a, r.b) for r in out] == [(3, 3), (0, 0), (6, 6)]


def test_guarded_cast_survives_ansi(spark):
    df = spark.createDataFrame([(" ",), ("",), ("12.5",), (None,)], "t string")
    out = [r[0] for r in df.select(C.blank_to_null_cast("t")).collect()]
    assert out == [None, None, 12.5, None]
    out2 = [r[0] for r in df.select(C.coerce_numeric("t")).collect()]
    assert out2 == [None, None, 12.5, None]


def test_single_projection_plan(spark):
    df = spark.createDataFrame([raw_row("x", 1, 1.0, "1", ["No"] * 6, "One year", "No")],
                               RAW_CUSTOMER_SCHEMA)
    plan = standardise_customers(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") == 1


def test_demographic_projection(golden, spark):
    telco, _ = golden
    assert C.DEMOGRAPHIC_COLUMNS == ["customerID", "gender", "SeniorCitizen", "Partner",
                                     "Dependents", "Churn"]
    assert not math.isnan(telco["a3"]["MonthlyCharges"])
    df = spark.createDataFrame([raw_row("x", 1, 1.0, "1", ["No"] * 6, "One year", "No")],
                               RAW_CUSTOMER_SCHEMA)
    assert demographic(standardise_customers(df)).columns == C.DEMOGRAPHIC_COLUMNS
