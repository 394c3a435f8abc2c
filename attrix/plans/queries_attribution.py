"""Registered queries: attributions by weighted least squares, and what is computed from them.

The checked ones explain an additive scorecard, whose Shapley values are known:
the weight times the feature's distance from the background's mean.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrix.functions.hashing import seeded_hash32_sql, seeded_hash60_sql
from attrix.functions.rounding import decimals, decimals_sql
from attrix.operators import explain as X
from attrix.operators import kernel_shap as K
from attrix.operators import sampling
from attrix.plans.catalog import register
from attrix.plans.frames import KEY, LABEL
from attrix.plans.lifecycle import BACKGROUND_FRACTION, FEATURES, SAMPLE_SEED, explanation_split
from attrix.plans.oracle import with_features
from attrix.plans.queries_model import CHECK_FRACTION, _fitted, _ts

#: feature -> (Spark and DuckDB expression, weight) of the scorecard
SCORECARD = {
    "tenure": ("CAST(tenure AS DOUBLE)", -0.125),
    "monthly": ("coalesce(MonthlyCharges, 0.0)", 0.25),
    "total": ("coalesce(TotalCharges, 0.0)", -0.0625),
    "options": ("CAST(NumOptionalServices AS DOUBLE)", 0.5),
    "months": ("CAST(coalesce(Contract, 0) AS DOUBLE)", -0.75),
    "senior": ("CASE WHEN SeniorCitizen THEN 1.0 ELSE 0.0 END", 1.5),
    "male": ("CASE WHEN gender = 'Male' THEN 1.0 ELSE 0.0 END", 0.375),
    "paperless": ("CASE WHEN PaperlessBilling THEN 1.0 ELSE 0.0 END", -0.25),
    "partner": ("CASE WHEN Partner THEN 1.0 ELSE 0.0 END", 2.0),
}

_H = seeded_hash32_sql("customerID", SAMPLE_SEED)
_SPLIT_SQL = f"""
WITH s AS (SELECT customerID, gender, Churn, {", ".join(f"CAST({e} AS DOUBLE) AS x_{f}" for f, (e, _) in SCORECARD.items())},
    row_number() OVER (PARTITION BY Churn ORDER BY {_H}, customerID) > floor(count(*) OVER (PARTITION BY Churn) * {BACKGROUND_FRACTION}e0) AS explained
  FROM demographic_service WHERE {seeded_hash60_sql("customerID", SAMPLE_SEED)} < {sampling.sample_limit(CHECK_FRACTION)}),
m AS (SELECT {", ".join(f"avg(x_{f}) AS m_{f}" for f in SCORECARD)} FROM s WHERE NOT explained),
phi AS ({" UNION ALL ".join(f"SELECT customerID, gender, Churn, '{f}' AS feature, {w}e0 * (x_{f} - m_{f}) AS phi FROM s, m WHERE explained"
                            for f, (_, w) in SCORECARD.items())})"""


def _scorecard(rows: DataFrame) -> DataFrame:
    return rows.withColumn("__f", sum((F.lit(w) * F.col(f) for f, (_, w) in SCORECARD.items()), F.lit(0.0)))


def _scorecard_values(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Attributions of the scorecard against the background's mean row; the explained rows."""
    background, example = explanation_split(_ts(spark, sf_dir), CHECK_FRACTION)
    cells = [F.expr(e).cast("double").alias(f) for f, (e, _) in SCORECARD.items()]
    mean = (background.select(*cells).agg(*[F.avg(f).alias(f) for f in SCORECARD]).withColumn(KEY, F.lit(0).cast("bigint")))
    phi = K.kernel_values(_scorecard, example.select(KEY, *cells), mean, KEY, list(SCORECARD))
    return phi, example


@register("kernel_attributions_check", with_features(f"""
SELECT customerID, feature, {decimals_sql('phi', 6)} AS phi, true AS additive FROM ({_SPLIT_SQL} SELECT * FROM phi) p"""))
def q_kernel_check(spark, sf_dir):
    """Values of the additive scorecard; each row's add up to its prediction."""
    phi, _ = _scorecard_values(spark, sf_dir)
    whole = phi.groupBy(KEY).agg((F.abs(F.sum("phi") - F.first("prediction") + F.first("base_value")) < 1e-9).alias("additive"))
    return phi.join(whole, KEY).select(KEY, "feature", decimals("phi", 6).alias("phi"), "additive")


@register("global_importance_check", with_features(f"""
SELECT feature, {decimals_sql('avg(abs(phi))', 6)} AS mean_abs_phi, count(*) AS n_rows
FROM ({_SPLIT_SQL} SELECT * FROM phi) p GROUP BY feature"""))
def q_global_importance_check(spark, sf_dir):
    phi, _ = _scorecard_values(spark, sf_dir)
    return X.global_importance(phi).select("feature", decimals("mean_abs_phi", 6).alias("mean_abs_phi"), "n_rows")


@register("shapley_group_difference_check", with_features(f"""
SELECT feature, count(*) FILTER (gender = 'Male') AS n_in_group, count(*) FILTER (gender <> 'Male') AS n_out_group,
  {decimals_sql("avg(phi) FILTER (gender = 'Male') - avg(phi) FILTER (gender <> 'Male')", 6)} AS difference
FROM ({_SPLIT_SQL} SELECT * FROM phi WHERE Churn = 1) p GROUP BY feature"""))
def q_group_difference_check(spark, sf_dir):
    phi, example = _scorecard_values(spark, sf_dir)
    groups = example.where(F.col(LABEL) == 1).select(KEY, (F.col("gender") == "Male").alias("is_male"))
    out = X.group_difference(phi, KEY, groups, "is_male")
    return out.select("feature", "n_in_group", "n_out_group", decimals("difference", 6).alias("difference"))


@register("explanation_clusters_check", with_features(f"""
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(4 AS BIGINT) AS n_clusters, {decimals_sql('avg(CAST(tenure AS DOUBLE))', 6)} AS avg_tenure
FROM demographic_service WHERE customerID IN (SELECT customerID FROM ({_SPLIT_SQL} SELECT customerID FROM s WHERE explained) e)"""))
def q_explanation_clusters_check(spark, sf_dir):
    """The clusters share out all explained rows: their sizes and size-weighted means add up to the sample's."""
    phi, example = _scorecard_values(spark, sf_dir)
    _, summary = X.explanation_clusters(phi.select(KEY, "feature", "phi"), KEY, list(SCORECARD), example.select(KEY, "tenure"))
    return summary.agg(F.sum("n_rows").alias("n_rows"), F.count(F.lit(1)).alias("n_clusters"),
                       decimals(F.sum(F.col("avg_tenure") * F.col("n_rows")) / F.sum("n_rows"), 6).alias("avg_tenure"))


@register("kernel_attributions")
def q_kernel_attributions(spark, sf_dir):
    """The fitted trees, every feature, the reference's budget of sets, all background rows."""
    ts = _ts(spark, sf_dir)
    model = _fitted(ts)
    background, example = explanation_split(ts)
    return K.kernel_values(model, example, background, KEY, FEATURES, seed=SAMPLE_SEED)
