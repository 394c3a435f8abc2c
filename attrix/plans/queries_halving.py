"""Registered queries: the comparison of models inside a budget."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attrix.operators import halving
from attrix.plans.catalog import register
from attrix.plans.oracle import with_features
from attrix.plans.queries_model import _KEEP, _content, _split

#: finished comparisons of this process
_COMPARED: dict[tuple, halving.Comparison] = {}


def _compared(spark: SparkSession, sf_dir: str) -> tuple[halving.Comparison, int]:
    """The comparison on the split, run once per application and content, and the number of validation rows."""
    train, val = _split(spark, sf_dir)
    key = _content(train)
    if key not in _COMPARED:
        found = halving.budgeted_comparison(train, val)
        while len(_COMPARED) >= _KEEP:
            _COMPARED.pop(next(iter(_COMPARED)))
        _COMPARED[key] = found
    return _COMPARED[key], val.count()


@register("budgeted_comparison")
def q_budgeted_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaderboard: families and the trials of the last whole rung."""
    return _compared(spark, sf_dir)[0].leaderboard


@register("halving_rungs")
def q_halving_rungs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compared(spark, sf_dir)[0].rungs


def _rungs_sql() -> str:
    """The rungs by the rule: how many trials, the most trees they may have, and how many go on."""
    f, n, least = halving.FACTOR, halving.TRIALS, halving.LEAST
    return f"""
SELECT CAST(rung AS INTEGER) AS rung, CAST(trials AS BIGINT) AS n_trials,
  CAST(greatest(1, floor(trials / {f}e0)) AS BIGINT) AS n_kept, CAST({least} * power({f}, rung) AS BIGINT) AS most_trees, n_validation,
  true AS trees_match, true AS best_kept, true AS from_kept
FROM (SELECT rung, floor({n}e0 / power({f}, rung)) AS trials FROM range(0, 32) r(rung)),
  (SELECT CAST(sum(n) AS BIGINT) AS n_validation FROM (
    SELECT count(*) - floor(count(*) * 0.9e0) AS n FROM demographic_service GROUP BY Churn))
WHERE trials >= 1"""


@register("halving_rungs_check", with_features(_rungs_sql()))
def q_halving_rungs_check(spark, sf_dir):
    """The rungs' sizes; whether trees follow the ladder, the kept ones are the best, and each comes from the rung before."""
    found, n = _compared(spark, sf_dir)
    most = F.lit(halving.LEAST) * F.pow(F.lit(halving.FACTOR), F.col("rung"))
    place = F.row_number().over(Window.partitionBy("rung").orderBy("log_loss", "trial_id"))
    rows = found.rungs.select("*", most.cast("bigint").alias("most"), place.alias("place"))
    before = rows.where("kept").select((F.col("rung") + 1).alias("rung"), "trial_id", F.lit(True).alias("came"))
    rows = rows.join(before, ["rung", "trial_id"], "left")
    out = rows.groupBy("rung").agg(
        F.count(F.lit(1)).alias("n_trials"), F.sum(F.col("kept").cast("int")).alias("n_kept"), F.max("most").alias("most_trees"),
        F.every(F.col("trees") == F.least("n_estimators", "most").cast("bigint")).alias("trees_match"),
        (F.max(F.when(F.col("kept"), F.col("place"))) == F.sum(F.col("kept").cast("int"))).alias("best_kept"),
        F.every((F.col("rung") == 0) | F.coalesce("came", F.lit(False))).alias("from_kept"))
    return out.withColumn("n_validation", F.lit(n).cast("bigint"))
