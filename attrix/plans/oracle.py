"""SQL text (DuckDB dialect) that derives the same frames as the Spark code.

Used only by ``oracle_sql()``: the driver runs these next to the DataFrame
queries and compares results. The Spark side is written with the DataFrame
API independently, so the comparison checks two separate derivations.
"""

from __future__ import annotations

from attrix.functions.columns import NON_SERVICE_COLUMNS, OPTIONAL_SERVICE_COLUMNS
from attrix.sources.csv import RAW_CUSTOMER_SCHEMA
from attrix.sources.synthetic import (
    CHURN_DAYS,
    FIBER_MIN_EVENTS,
    MOVIES_MIN_VALUE,
    MULTI_LINE_MIN_ORDERS,
    OPTION_EVENT_TYPES,
    OPTION_MIN_EVENTS,
)

_type_counts = ",\n    ".join(
    f"count(CASE WHEN event_type = '{t}' THEN 1 END) AS n_{t}" for t in OPTION_EVENT_TYPES.values())
_options = ",\n    ".join(
    f"CASE WHEN ev.n_events IS NULL THEN 'No internet service' "
    f"WHEN ev.n_{t} > {OPTION_MIN_EVENTS} THEN 'Yes' ELSE 'No' END AS {c}"
    for c, t in OPTION_EVENT_TYPES.items())

TELCO_RAW_CTE = f"""
cut AS (SELECT max(o_orderdate) - INTERVAL '{CHURN_DAYS}' DAY AS cutoff FROM orders),
oh AS (
  SELECT o_custkey, max(o_orderdate) AS last_order,
         count(CASE WHEN o_orderdate < (SELECT cutoff FROM cut) THEN 1 END) AS n_hist
  FROM orders GROUP BY o_custkey),
ev AS (
  SELECT user_id,
    CAST(count(DISTINCT CAST(ts AS DATE)) AS INTEGER) AS active_days,
    count(*) AS n_events,
    CAST(sum(CAST(round(value * 100e0) AS BIGINT)) AS BIGINT) AS cents,
    max(value) AS max_value,
    {_type_counts}
  FROM events GROUP BY user_id),
telco_raw AS (
  SELECT c.c_custkey AS customerID,
    CASE WHEN c.c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
    CASE WHEN c.c_acctbal < 0 THEN 1 ELSE 0 END AS SeniorCitizen,
    CASE WHEN c.c_custkey % 53 = 0 THEN NULL WHEN c.c_nationkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS Partner,
    CASE WHEN c.c_custkey % 53 = 0 THEN NULL WHEN c.c_nationkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS Dependents,
    COALESCE(ev.active_days, 0) AS tenure,
    CASE WHEN COALESCE(oh.n_hist, 0) > 0 THEN 'Yes' ELSE 'No' END AS PhoneService,
    CASE WHEN COALESCE(oh.n_hist, 0) = 0 THEN 'No phone service'
         WHEN oh.n_hist > {MULTI_LINE_MIN_ORDERS} THEN 'Yes' ELSE 'No' END AS MultipleLines,
    CASE WHEN ev.n_events IS NULL THEN 'No' WHEN ev.n_events > {FIBER_MIN_EVENTS} THEN 'Fiber optic'
         ELSE 'DSL' END AS InternetService,
    {_options},
    CASE WHEN ev.n_events IS NULL THEN 'No internet service'
         WHEN ev.max_value > {MOVIES_MIN_VALUE!r} THEN 'Yes' ELSE 'No' END AS StreamingMovies,
    CASE WHEN c.c_nationkey % 4 = 0 THEN 'Month-to-month' WHEN c.c_nationkey % 4 = 1 THEN 'One year'
         WHEN c.c_nationkey % 4 = 2 THEN 'Two year' ELSE 'Other' END AS Contract,
    CASE WHEN c.c_acctbal > 5000 THEN 'Yes' ELSE 'No' END AS PaperlessBilling,
    c.c_mktsegment AS PaymentMethod,
    ev.cents / 100e0 / ev.n_events AS MonthlyCharges,
    CASE WHEN ev.n_events IS NULL THEN NULL WHEN c.c_custkey % 97 = 0 THEN ' '
         ELSE CAST(ev.cents / 100e0 AS VARCHAR) END AS TotalCharges,
    CASE WHEN oh.last_order < (SELECT cutoff FROM cut) THEN 'Yes' ELSE 'No' END AS Churn
  FROM customer c
  LEFT JOIN oh ON c.c_custkey = oh.o_custkey
  LEFT JOIN ev ON c.c_custkey = ev.user_id)"""

TELCO_CTE = TELCO_RAW_CTE + """,
telco AS (
  SELECT customerID, gender, SeniorCitizen = 1 AS SeniorCitizen, Partner = 'Yes' AS Partner,
    Dependents = 'Yes' AS Dependents, tenure, PhoneService = 'Yes' AS PhoneService, MultipleLines,
    InternetService, OnlineSecurity, OnlineBackup, DeviceProtection, TechSupport, StreamingTV,
    StreamingMovies,
    CASE WHEN Contract = 'Month-to-month' THEN 1 WHEN Contract = 'One year' THEN 12
         WHEN Contract = 'Two year' THEN 24 END AS Contract,
    PaperlessBilling = 'Yes' AS PaperlessBilling, PaymentMethod, MonthlyCharges,
    CASE WHEN length(trim(TotalCharges)) = 0 THEN NULL ELSE CAST(TotalCharges AS DOUBLE) END AS TotalCharges,
    CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS Churn
  FROM telco_raw)"""

NUM_OPTS_SQL = " + ".join(
    f"CASE WHEN {c} = 'Yes' THEN 1 ELSE 0 END"
    for c in OPTIONAL_SERVICE_COLUMNS)

# the raw columns without the demographic ones, then the two derived features
SERVICE_COLUMNS = [c for c in RAW_CUSTOMER_SCHEMA.fieldNames() if c not in NON_SERVICE_COLUMNS] + [
    "NumOptionalServices", "AvgPriceIncrease"]

FEATURES_CTE = TELCO_CTE + f""",
demographic AS (
  SELECT customerID, gender, SeniorCitizen, Partner, Dependents, Churn FROM telco),
service_features AS (
  SELECT customerID, tenure, PhoneService, MultipleLines, InternetService, OnlineSecurity,
    OnlineBackup, DeviceProtection, TechSupport, StreamingTV, StreamingMovies, Contract,
    PaperlessBilling, PaymentMethod, MonthlyCharges,
    COALESCE(TotalCharges, 0e0) AS TotalCharges,
    ({NUM_OPTS_SQL}) AS NumOptionalServices,
    CASE WHEN tenure > 0 THEN MonthlyCharges - COALESCE(TotalCharges, 0e0) / tenure
         ELSE 0e0 END AS AvgPriceIncrease
  FROM telco),
demographic_service AS (
  SELECT d.*, s.* EXCLUDE (customerID)
  FROM demographic d LEFT JOIN service_features s ON d.customerID = s.customerID)"""


def with_features(select_sql: str) -> str:
    """Prefix a SELECT with the full derivation (telco -> features)."""
    return "WITH " + FEATURES_CTE + "\n" + select_sql
