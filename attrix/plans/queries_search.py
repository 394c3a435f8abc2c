"""Registered queries: adaptive search over a churn scorecard.

The objective is one aggregation over the training set for a whole batch of
parameter sets, so forty trials are seven jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrix.functions.metrics import EPS, log_loss
from attrix.functions.rounding import decimals, decimals_sql
from attrix.operators import tpe
from attrix.operators.tuning import PARALLELISM, SEARCH_SEED, LogUniform, QUniform
from attrix.plans.catalog import register
from attrix.plans.frames import LABEL
from attrix.plans.oracle import with_features
from attrix.plans.queries_model import _ts

SCORE_SPACE = {
    "base": QUniform(-4, 4, 0.25),
    "per_month": LogUniform(-6, 1),
    "per_charge": LogUniform(-8, 0),
    "senior": QUniform(-2, 2, 0.5),
}
EVALUATIONS = 40


def _chance(p: dict[str, float]):
    z = (F.lit(p["base"]) - F.lit(p["per_month"]) * F.col("tenure") + F.lit(p["per_charge"]) * F.coalesce("MonthlyCharges", F.lit(0.0))
         + F.lit(p["senior"]) * F.col("SeniorCitizen").cast("int"))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _trials(spark: SparkSession, sf_dir: str) -> list[tuple[dict[str, float], float]]:
    rows = _ts(spark, sf_dir).select(LABEL, "tenure", "MonthlyCharges", "SeniorCitizen")

    def evaluate(batch):
        return list(rows.agg(*[log_loss(F.col(LABEL), _chance(p)).alias(f"l{i}") for i, p in enumerate(batch)]).first())
    return tpe.search(evaluate, SCORE_SPACE, EVALUATIONS, PARALLELISM, SEARCH_SEED)


_SCHEMA = "trial_id int, " + ", ".join(f"{k} double" for k in SCORE_SPACE) + ", log_loss double"


@register("adaptive_trials")
def q_adaptive_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(i, *p.values(), loss) for i, (p, loss) in enumerate(_trials(spark, sf_dir))], _SCHEMA)


def _startup_sql() -> str:
    import numpy as np

    rng = np.random.default_rng(SEARCH_SEED)
    draws = [{k: d.draw(rng) for k, d in SCORE_SPACE.items()} for _ in range(tpe.STARTUP)]
    values = ", ".join("(" + ", ".join([str(i), *[f"CAST('{v!r}' AS DOUBLE)" for v in d.values()]]) + ")" for i, d in enumerate(draws))
    z = "base - per_month * tenure + per_charge * coalesce(MonthlyCharges, 0e0) + senior * CAST(SeniorCitizen AS INTEGER)"
    p = f"least(greatest(1e0 / (1e0 + exp(-({z}))), {EPS!r}), 1e0 - {EPS!r})"
    loss = f"avg(-ln(CASE WHEN Churn = 1 THEN {p} ELSE 1e0 - {p} END))"
    return (f"SELECT CAST(trial_id AS INTEGER) AS trial_id, {', '.join(SCORE_SPACE)}, {decimals_sql(loss, 7)} AS log_loss, "
            f"CAST({EVALUATIONS - tpe.STARTUP} AS BIGINT) AS proposals, true AS better "
            f"FROM demographic_service, (VALUES {values}) d(trial_id, {', '.join(SCORE_SPACE)}) "
            f"GROUP BY trial_id, {', '.join(SCORE_SPACE)}")


@register("adaptive_trials_check", with_features(_startup_sql()))
def q_adaptive_trials_check(spark, sf_dir):
    """The seeded draws with their losses; how many proposals follow, and whether one of them beats all draws."""
    trials = q_adaptive_trials(spark, sf_dir)
    start = F.col("trial_id") < tpe.STARTUP
    facts = trials.agg(F.count(F.when(~start, 1)).alias("proposals"),
                       (F.min(F.when(~start, F.col("log_loss"))) < F.min(F.when(start, F.col("log_loss")))).alias("better")).first()
    return trials.where(start).select("trial_id", *SCORE_SPACE, decimals("log_loss", 7).alias("log_loss"),
                                      F.lit(facts["proposals"]).cast("bigint").alias("proposals"), F.lit(facts["better"]).alias("better"))
