"""Registered queries: one per operator, each with its DuckDB oracle when the
operator is expressible in SQL.

Every query reads the given tables under ``sf_dir`` (through the telco
derivation or directly) and runs over them whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrix.functions import columns as C
from attrix.functions.hashing import seeded_hash32_sql, seeded_hash60_sql
from attrix.functions.rounding import significant, significant_sql
from attrix.operators import sampling
from attrix.operators.lookup import FeatureLookup, create_training_set
from attrix.operators.preprocess import CATEGORICAL_FEATURES
from attrix.operators.service import compute_service_features, select_except
from attrix.plans.frames import KEY, LABEL, frames, tbl
from attrix.plans.oracle import with_features
from attrix.sources.features import key_violations

from attrix.plans.catalog import QUERIES, SQL, register  # noqa: E402


# Seeds and fractions of the reference's flow.
SAMPLE_SEED = 42
SPLIT_SEED = 810302555
EXPLAIN_SAMPLE_FRACTION = 0.05
BACKGROUND_FRACTION = 0.25
TRAIN_FRACTION = 0.9


# --------------------------------------------------------------------------
# Flagship: telco rows -> standardise -> features -> lookup -> churn by segment

def churn_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = frames(spark, sf_dir).training_set(label=LABEL)
    return ts.groupBy(F.col("PaymentMethod").alias("segment")).agg(
        F.count(F.lit(1)).alias("n_customers"),
        F.sum("Churn").cast("bigint").alias("n_churned"),
        (F.sum("Churn") / F.count(F.lit(1))).alias("churn_rate"),
        significant(F.avg("tenure")).alias("avg_tenure"),
        significant(F.avg("AvgPriceIncrease")).alias("avg_price_increase"),
        significant(F.avg("NumOptionalServices")).alias("avg_optional_services"),
    )


register("churn_by_segment", with_features(f"""
SELECT PaymentMethod AS segment, count(*) AS n_customers,
  CAST(sum(Churn) AS BIGINT) AS n_churned, sum(Churn) / count(*) AS churn_rate,
  {significant_sql('avg(CAST(tenure AS DOUBLE))')} AS avg_tenure,
  {significant_sql('avg(CAST(AvgPriceIncrease AS DOUBLE))')} AS avg_price_increase,
  {significant_sql('avg(CAST(NumOptionalServices AS DOUBLE))')} AS avg_optional_services
FROM demographic_service GROUP BY PaymentMethod"""))(churn_by_segment)


# --------------------------------------------------------------------------
# Projections

@register("demographic_select", with_features(
    "SELECT customerID, gender, SeniorCitizen, Partner, Dependents, Churn FROM telco"))
def q_demographic_select(spark, sf_dir):
    return frames(spark, sf_dir).demographic


@register("select_except", with_features(
    "SELECT * EXCLUDE (gender, SeniorCitizen, Partner, Dependents, Churn) FROM telco"))
def q_select_except(spark, sf_dir):
    return select_except(frames(spark, sf_dir).telco, C.NON_SERVICE_COLUMNS)


@register("drop_columns", with_features(
    "SELECT * EXCLUDE (customerID, Churn) FROM demographic_service"))
def q_drop_columns(spark, sf_dir):
    return frames(spark, sf_dir).training_set(label=LABEL, keep_key=True).drop(KEY, LABEL)


# --------------------------------------------------------------------------
# Scalar expressions (on the raw rows)

@register("int_to_bool", with_features(
    "SELECT customerID, SeniorCitizen = 1 AS SeniorCitizen FROM telco_raw"))
def q_int_to_bool(spark, sf_dir):
    raw = frames(spark, sf_dir).raw
    return raw.select(KEY, C.int_to_bool("SeniorCitizen").alias("SeniorCitizen"))


@register("yes_no_to_bool", with_features(
    "SELECT customerID, " + ", ".join(f"{c} = 'Yes' AS {c}" for c in C.YES_NO_COLUMNS)
    + " FROM telco_raw"))
def q_yes_no_to_bool(spark, sf_dir):
    raw = frames(spark, sf_dir).raw
    return raw.select(KEY, *[C.yes_no_to_bool(c).alias(c) for c in C.YES_NO_COLUMNS])


@register("label_binarise", with_features(
    "SELECT customerID, CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS Churn FROM telco_raw"))
def q_label_binarise(spark, sf_dir):
    raw = frames(spark, sf_dir).raw
    return raw.select(KEY, C.label_binarise("Churn").alias("Churn"))


@register("category_to_months", with_features(
    "SELECT customerID, CASE WHEN Contract = 'Month-to-month' THEN 1 WHEN Contract = 'One year' "
    "THEN 12 WHEN Contract = 'Two year' THEN 24 END AS Contract FROM telco_raw"))
def q_category_to_months(spark, sf_dir):
    raw = frames(spark, sf_dir).raw
    return raw.select(KEY, C.category_to_number("Contract", C.CONTRACT_MONTHS).alias("Contract"))


@register("blank_to_null_cast", with_features(
    "SELECT customerID, CASE WHEN length(trim(TotalCharges)) = 0 THEN NULL "
    "ELSE CAST(TotalCharges AS DOUBLE) END AS TotalCharges FROM telco_raw"))
def q_blank_to_null_cast(spark, sf_dir):
    raw = frames(spark, sf_dir).raw
    return raw.select(KEY, C.blank_to_null_cast("TotalCharges").alias("TotalCharges"))


@register("coerce_numeric", with_features(
    "SELECT customerID, TRY_CAST(TotalCharges AS DOUBLE) AS TotalCharges, "
    "TRY_CAST(MonthlyCharges AS DOUBLE) AS MonthlyCharges, TRY_CAST(tenure AS DOUBLE) AS tenure, "
    "TRY_CAST(PaymentMethod AS DOUBLE) AS PaymentMethod FROM telco_raw"))
def q_coerce_numeric(spark, sf_dir):
    raw = frames(spark, sf_dir).raw
    return raw.select(KEY, *[C.coerce_numeric(c).alias(c) for c in
                             ("TotalCharges", "MonthlyCharges", "tenure", "PaymentMethod")])


@register("fill_null", with_features(
    "SELECT customerID, COALESCE(TotalCharges, 0e0) AS TotalCharges FROM telco"))
def q_fill_null(spark, sf_dir):
    telco = frames(spark, sf_dir).telco
    return telco.select(KEY, "TotalCharges").fillna({"TotalCharges": 0.0})


@register("num_optional_services", with_features(
    "SELECT customerID, NumOptionalServices FROM service_features"))
def q_num_optional_services(spark, sf_dir):
    telco = frames(spark, sf_dir).telco
    return telco.select(KEY, C.num_optional_services().alias("NumOptionalServices"))


@register("num_optional_services_udf", with_features(
    "SELECT customerID, NumOptionalServices FROM service_features"))
def q_num_optional_services_udf(spark, sf_dir):
    telco = frames(spark, sf_dir).telco
    return telco.select(KEY, C.num_optional_services_udf(*C.OPTIONAL_SERVICE_COLUMNS)
                        .alias("NumOptionalServices"))


@register("avg_price_increase", with_features(
    "SELECT customerID, AvgPriceIncrease FROM service_features"))
def q_avg_price_increase(spark, sf_dir):
    telco = frames(spark, sf_dir).telco.fillna({"TotalCharges": 0.0})
    return telco.select(KEY, C.avg_price_increase().alias("AvgPriceIncrease"))


@register("impute_constant", with_features(
    "SELECT customerID, " + ", ".join(f"COALESCE({c}, '{C.MISSING_CATEGORY}') AS {c}" for c in CATEGORICAL_FEATURES)
    + " FROM demographic_service"))
def q_impute_constant(spark, sf_dir):
    ts = frames(spark, sf_dir).training_set()
    return ts.select(KEY, *[C.impute_constant(c).alias(c) for c in CATEGORICAL_FEATURES])


@register("service_features", with_features("SELECT * FROM service_features"))
def q_service_features(spark, sf_dir):
    return frames(spark, sf_dir).service_features


@register("service_features_udf", with_features("SELECT * FROM service_features"))
def q_service_features_udf(spark, sf_dir):
    return compute_service_features(frames(spark, sf_dir).telco, use_pandas_udf=True)


# --------------------------------------------------------------------------
# Lookups

@register("feature_lookup", with_features("SELECT * EXCLUDE (customerID) FROM demographic_service"))
def q_feature_lookup(spark, sf_dir):
    f = frames(spark, sf_dir)
    ts = create_training_set(f.demographic, [FeatureLookup(lookup_key=KEY, df=f.service_features)],
                             label=None, exclude_columns=KEY)
    return ts.load_df()


_ORDER_FEATURES_SQL = """
order_features AS (
  SELECT o_custkey AS customerID, count(*) AS n_orders,
         CAST(sum(CAST(round(o_totalprice * 100e0) AS BIGINT)) AS BIGINT) AS order_cents
  FROM orders GROUP BY o_custkey)"""


def order_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second keyed feature table: order counts and totals per customer."""
    orders = tbl(spark, sf_dir, "orders")
    return orders.groupBy(F.col("o_custkey").alias(KEY)).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(F.round(F.col("o_totalprice") * F.lit(100.0)).cast("bigint")).alias("order_cents"))


@register("feature_lookup_multi", with_features(
    "SELECT d.* EXCLUDE (customerID), s.* EXCLUDE (customerID), o.n_orders, o.order_cents "
    "FROM demographic d LEFT JOIN service_features s ON d.customerID = s.customerID "
    "LEFT JOIN order_features o ON d.customerID = o.customerID").replace(
        "demographic_service AS (", _ORDER_FEATURES_SQL.strip() + ",\ndemographic_service AS (", 1))
def q_feature_lookup_multi(spark, sf_dir):
    f = frames(spark, sf_dir)
    ts = create_training_set(
        f.demographic,
        [FeatureLookup(lookup_key=KEY, df=f.service_features),
         FeatureLookup(lookup_key=KEY, df=order_features(spark, sf_dir))],
        label=LABEL, exclude_columns=KEY)
    return ts.load_df()


@register("feature_lookup_partial",
          "SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def q_feature_lookup_partial(spark, sf_dir):
    """A lookup whose feature table covers only part of the base keys:
    documents get their quality/toxicity labels, unlabelled ones get nulls."""
    ts = create_training_set(tbl(spark, sf_dir, "documents"),
                             [FeatureLookup(lookup_key="doc_id", df=tbl(spark, sf_dir, "labels"))])
    return ts.load_df()


_EVENT_FEATURES = ["tenure", "InternetService", "MonthlyCharges", "NumOptionalServices",
                   "AvgPriceIncrease"]


@register("event_feature_lookup", with_features(
    "SELECT e.*, " + ", ".join(f"s.{c}" for c in _EVENT_FEATURES)
    + " FROM events e LEFT JOIN service_features s ON e.user_id = s.customerID"))
def q_event_feature_lookup(spark, sf_dir):
    """Every event row gets its customer's service features: a lookup whose
    base has many rows per key, run through the hot-key salted join."""
    feats = frames(spark, sf_dir).service_features.select(
        F.col(KEY).alias("user_id"), *_EVENT_FEATURES)
    ts = create_training_set(tbl(spark, sf_dir, "events"),
                             [FeatureLookup(lookup_key="user_id", df=feats)])
    return ts.load_df(salted=True)


# --------------------------------------------------------------------------
# Filters, profile figures

@register("filter_label", with_features("SELECT * FROM demographic_service WHERE Churn = 1"))
def q_filter_label(spark, sf_dir):
    return frames(spark, sf_dir).training_set().filter(F.col(LABEL) == 1)


@register("churn_rate", with_features(
    "SELECT PaymentMethod AS segment, count(*) AS n_customers, CAST(sum(Churn) AS BIGINT) AS n_churned, "
    "sum(Churn) / count(*) AS churn_rate FROM demographic_service GROUP BY ROLLUP (PaymentMethod)"))
def q_churn_rate(spark, sf_dir):
    ts = frames(spark, sf_dir).training_set()
    return ts.rollup(F.col("PaymentMethod").alias("segment")).agg(
        F.count(F.lit(1)).alias("n_customers"),
        F.sum(LABEL).cast("bigint").alias("n_churned"),
        (F.sum(LABEL) / F.count(F.lit(1))).alias("churn_rate"))


@register("feature_key_violations",
          "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem "
          "GROUP BY l_orderkey, l_linenumber "
          "HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL")
def q_feature_key_violations(spark, sf_dir):
    return key_violations(tbl(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("service_key_violations", with_features(
    "SELECT customerID, count(*) AS n_rows FROM service_features GROUP BY customerID "
    "HAVING count(*) > 1 OR customerID IS NULL"))
def q_service_key_violations(spark, sf_dir):
    return key_violations(frames(spark, sf_dir).service_features, KEY)


@register("input_example", with_features(
    "SELECT * EXCLUDE (Churn) FROM demographic_service ORDER BY customerID LIMIT 100"))
def q_input_example(spark, sf_dir):
    ts = frames(spark, sf_dir).training_set(label=LABEL)
    return ts.drop(LABEL).orderBy(KEY).limit(100)


# --------------------------------------------------------------------------
# Sampling and splitting

_H_SAMPLE = seeded_hash60_sql("customerID", SAMPLE_SEED)
_H_SPLIT = seeded_hash32_sql("customerID", SPLIT_SEED)


@register("hash_sample", with_features(
    f"SELECT * FROM demographic_service WHERE {_H_SAMPLE} < {sampling.sample_limit(EXPLAIN_SAMPLE_FRACTION)}"))
def q_hash_sample(spark, sf_dir):
    ts = frames(spark, sf_dir).training_set()
    return sampling.hash_sample(ts, KEY, EXPLAIN_SAMPLE_FRACTION, SAMPLE_SEED)


@register("stratified_split", with_features(f"""
SELECT customerID, Churn,
  CASE WHEN row_number() OVER (PARTITION BY Churn ORDER BY {_H_SPLIT}, customerID)
       <= floor(count(*) OVER (PARTITION BY Churn) * {TRAIN_FRACTION}e0) THEN 'train' ELSE 'validation' END
  AS split
FROM demographic_service"""))
def q_stratified_split(spark, sf_dir):
    ts = frames(spark, sf_dir).training_set()
    out = sampling.stratified_split(ts, KEY, LABEL, TRAIN_FRACTION, SPLIT_SEED)
    return out.select(KEY, LABEL, "split")


@register("stratified_split_sizes", with_features(f"""
SELECT Churn, split, count(*) AS n_rows FROM (
  SELECT Churn,
    CASE WHEN row_number() OVER (PARTITION BY Churn ORDER BY {_H_SPLIT}, customerID)
         <= floor(count(*) OVER (PARTITION BY Churn) * {TRAIN_FRACTION}e0) THEN 'train'
         ELSE 'validation' END AS split
  FROM demographic_service) GROUP BY Churn, split"""))
def q_stratified_split_sizes(spark, sf_dir):
    ts = frames(spark, sf_dir).training_set()
    out = sampling.stratified_split(ts, KEY, LABEL, TRAIN_FRACTION, SPLIT_SEED)
    return out.groupBy(LABEL, "split").agg(F.count(F.lit(1)).alias("n_rows"))


_H_ORDERS = seeded_hash32_sql("k", SPLIT_SEED)


@register("stratified_split_nulls", f"""
WITH o AS (SELECT CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey END AS k,
                  CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS label FROM orders)
SELECT label, split, k IS NULL AS null_key, count(*) AS n_rows FROM (
  SELECT k, label, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY {_H_ORDERS}, k NULLS FIRST)
    <= floor(count(*) OVER (PARTITION BY label) * {TRAIN_FRACTION}e0) THEN 'train' ELSE 'validation' END AS split
  FROM o) GROUP BY ALL""")
def q_stratified_split_nulls(spark, sf_dir):
    """Null labels are a class, null keys stay: no row is lost."""
    o = tbl(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderkey")).alias("k"),
        F.when(F.col("o_custkey") % 5 != 0, F.col("o_orderstatus")).alias("label"))
    out = sampling.stratified_split(o, "k", "label", TRAIN_FRACTION, SPLIT_SEED)
    return out.groupBy("label", "split", F.col("k").isNull().alias("null_key")).agg(F.count(F.lit(1)).alias("n_rows"))


# The other query groups register themselves on import.
from attrix.plans import (  # noqa: E402,F401
    queries_attribution,
    queries_halving,
    queries_map,
    queries_model,
    queries_profile,
    queries_search,
    queries_states,
    queries_tables,
)

__all__ = ["QUERIES", "SQL", "churn_by_segment"]
