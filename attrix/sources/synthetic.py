"""Telco-shaped customer rows derived from the synthetic TPC-H-style tables.

The reference works on one CSV of telecom customers (21 columns). The test
data has no such file, so we derive a frame of the same shape from
``customer``, ``orders`` and ``events`` with two grouped aggregations and two
key joins. Its size grows with the input tables, and every value is
reproducible in plain SQL (see ``attrix.plans.oracle``).

Derivation (per customer ``c``):
  customerID        c_custkey
  gender            Male when c_custkey is even, else Female
  SeniorCitizen     1 when c_acctbal < 0 else 0
  Partner           null when c_custkey % 53 = 0, Yes when c_nationkey is even
  Dependents        null when c_custkey % 53 = 0, Yes when c_nationkey % 3 = 0
  tenure            distinct event days of the customer (0 without events)
  PhoneService      Yes when the customer ordered before the churn cutoff
  MultipleLines     "No phone service" / Yes when > 8 such orders / No
  InternetService   No without events / Fiber optic when > 66 events / DSL
  five options      per event type: Yes when > 13 events of that type
  StreamingMovies   Yes when the largest event value > 220
                    (options are "No internet service" without events)
  Contract          c_nationkey % 4 -> Month-to-month, One year, Two year, Other
  PaperlessBilling  Yes when c_acctbal > 5000
  PaymentMethod     c_mktsegment
  MonthlyCharges    mean event value (exact: summed in integer cents)
  TotalCharges      summed event value as text, " " when c_custkey % 97 = 0
  Churn             Yes when the last order is over 365 days before the
                    latest order date in the table

The cutoff is a scalar subquery, computed once and inlined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Event types mapped to the first five optional-service columns.
OPTION_EVENT_TYPES = {
    "OnlineSecurity": "error",
    "OnlineBackup": "signup",
    "DeviceProtection": "purchase",
    "TechSupport": "click",
    "StreamingTV": "view",
}
OPTION_MIN_EVENTS = 13
MULTI_LINE_MIN_ORDERS = 8
FIBER_MIN_EVENTS = 66
MOVIES_MIN_VALUE = 220.0
CHURN_DAYS = 365

RAW_COLUMNS = [
    "customerID", "gender", "SeniorCitizen", "Partner", "Dependents", "tenure", "PhoneService",
    "MultipleLines", "InternetService", "OnlineSecurity", "OnlineBackup", "DeviceProtection",
    "TechSupport", "StreamingTV", "StreamingMovies", "Contract", "PaperlessBilling",
    "PaymentMethod", "MonthlyCharges", "TotalCharges", "Churn",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def churn_cutoff(orders: DataFrame):
    """Scalar subquery: latest order date minus the churn window."""
    return orders.select(
        (F.max("o_orderdate") - F.make_dt_interval(days=F.lit(CHURN_DAYS))).alias("cutoff")
    ).scalar()


def order_history(orders: DataFrame) -> DataFrame:
    """One row per ordering customer: last order date, orders before cutoff."""
    cutoff = churn_cutoff(orders)
    return orders.groupBy(F.col("o_custkey")).agg(
        F.max("o_orderdate").alias("last_order"),
        F.count(F.when(F.col("o_orderdate") < cutoff, F.lit(1))).alias("n_hist"),
        F.max(F.lit(1)).alias("has_orders"),
    ).withColumn("churned", F.col("last_order") < cutoff)


def event_usage(events: DataFrame) -> DataFrame:
    """One row per active user: active days, counts per type, value totals.

    One distinct aggregate (days) next to plain ones: Spark plans it as a
    two-level aggregation keyed by (user, day) then user, both with map-side
    partial aggregation, so a user with a huge share of events does not
    land whole in one task.
    """
    per_type = [
        F.count(F.when(F.col("event_type") == F.lit(t), F.lit(1))).alias(f"n_{t}")
        for t in OPTION_EVENT_TYPES.values()
    ]
    return events.groupBy(F.col("user_id")).agg(
        F.count_distinct(F.to_date("ts")).cast("int").alias("active_days"),
        F.count(F.lit(1)).alias("n_events"),
        F.sum(F.round(F.col("value") * F.lit(100.0)).cast("bigint")).alias("cents"),
        F.max("value").alias("max_value"),
        *per_type,
    )


def telco_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw telco-shaped rows (string-typed like a CSV read with inference)."""
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_type", "value")

    hist = order_history(orders)
    usage = event_usage(events)
    j = (customer
         .join(hist, customer.c_custkey == hist.o_custkey, "left")
         .join(usage, customer.c_custkey == usage.user_id, "left"))

    key = F.col("c_custkey")
    nation = F.col("c_nationkey")
    no_events = F.col("n_events").isNull()
    n_hist = F.coalesce(F.col("n_hist"), F.lit(0))

    def yes_no(cond):
        return F.when(cond, F.lit("Yes")).otherwise(F.lit("No"))

    def option(cond):
        return F.when(no_events, F.lit("No internet service")).otherwise(yes_no(cond))

    options = {
        col: option(F.col(f"n_{etype}") > OPTION_MIN_EVENTS)
        for col, etype in OPTION_EVENT_TYPES.items()
    }
    total_text = F.when(no_events, F.lit(None).cast("string")).when(
        key % 97 == 0, F.lit(" ")).otherwise((F.col("cents") / F.lit(100.0)).cast("string"))

    cols = {
        "customerID": key,
        "gender": F.when(key % 2 == 0, F.lit("Male")).otherwise(F.lit("Female")),
        "SeniorCitizen": F.when(F.col("c_acctbal") < 0, F.lit(1)).otherwise(F.lit(0)),
        "Partner": F.when(key % 53 == 0, F.lit(None).cast("string")).otherwise(yes_no(nation % 2 == 0)),
        "Dependents": F.when(key % 53 == 0, F.lit(None).cast("string")).otherwise(yes_no(nation % 3 == 0)),
        "tenure": F.coalesce(F.col("active_days"), F.lit(0)),
        "PhoneService": yes_no(n_hist > 0),
        "MultipleLines": F.when(n_hist == 0, F.lit("No phone service")).otherwise(
            yes_no(n_hist > MULTI_LINE_MIN_ORDERS)),
        "InternetService": F.when(no_events, F.lit("No")).when(
            F.col("n_events") > FIBER_MIN_EVENTS, F.lit("Fiber optic")).otherwise(F.lit("DSL")),
        **options,
        "StreamingMovies": option(F.col("max_value") > MOVIES_MIN_VALUE),
        "Contract": F.when(nation % 4 == 0, F.lit("Month-to-month"))
                     .when(nation % 4 == 1, F.lit("One year"))
                     .when(nation % 4 == 2, F.lit("Two year"))
                     .otherwise(F.lit("Other")),
        "PaperlessBilling": yes_no(F.col("c_acctbal") > 5000),
        "PaymentMethod": F.col("c_mktsegment"),
        "MonthlyCharges": F.col("cents") / F.lit(100.0) / F.col("n_events"),
        "TotalCharges": total_text,
        "Churn": F.when(F.col("churned"), F.lit("Yes")).otherwise(F.lit("No")),
    }
    return j.select(*[cols[c].alias(c) for c in RAW_COLUMNS])
