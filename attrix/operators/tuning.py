"""Hyperparameter search, best trial, baseline comparison, promotion gate.

Search: seeded random draws from the reference's four distributions, fitted on
the training split and evaluated on the validation split. The models of
``parallelism`` draws are grown together, one pass over the rows per level of
all their trees (``attrix.operators.boosting``). A tree-structured Parzen estimator draws at random for its first 20 trials, so
with 8 trials it is this same method; ``adaptive_search`` goes on with proposals
from ``attrix.operators.tpe``.

Results form a ``trials`` DataFrame: trial_id, the four parameters,
log_loss, accuracy. Best trial = lowest log loss, ties by trial id.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrix.functions.metrics import accuracy, log_loss
from attrix.operators import boosting
from attrix.operators.model import (
    baseline_classifiers,
    evaluate,
    fit,
    prepared,
    score,
)
from attrix.operators.preprocess import feature_pipeline


@dataclass(frozen=True)
class QUniform:
    low: float
    high: float
    q: float

    def draw(self, rng: np.random.Generator) -> float:
        return float(np.round(rng.uniform(self.low, self.high) / self.q) * self.q)


@dataclass(frozen=True)
class LogUniform:
    low: float
    high: float

    def draw(self, rng: np.random.Generator) -> float:
        return float(math.exp(rng.uniform(self.low, self.high)))


# ---------------------------------------------------------------------------
# The reference's search space, budget and seed.
SEARCH_SPACE = {
    "max_depth": QUniform(3, 10, 1),
    "learning_rate": LogUniform(-5, -1),
    "min_child_weight": LogUniform(0, 2),
    "n_estimators": QUniform(50, 500, 10),
}
MAX_EVALS = 8
PARALLELISM = 8
SEARCH_SEED = 42
ACCURACY_GATE = 0.8
# ---------------------------------------------------------------------------

PARAM_NAMES = ["max_depth", "learning_rate", "min_child_weight", "n_estimators"]

TRIALS_SCHEMA = T.StructType([
    T.StructField("trial_id", T.IntegerType()),
    T.StructField("max_depth", T.DoubleType()),
    T.StructField("learning_rate", T.DoubleType()),
    T.StructField("min_child_weight", T.DoubleType()),
    T.StructField("n_estimators", T.DoubleType()),
    T.StructField("log_loss", T.DoubleType()),
    T.StructField("accuracy", T.DoubleType()),
])


def draw_params(space: Mapping[str, object] = SEARCH_SPACE, n: int = MAX_EVALS,
                seed: int = SEARCH_SEED) -> list[dict[str, float]]:
    rng = np.random.default_rng(seed)
    return [{k: space[k].draw(rng) for k in PARAM_NAMES} for _ in range(n)]


def validation_metrics(rows: DataFrame, grown: Sequence[boosting.Grown], label: str) -> list[tuple[float, float]]:
    """(log loss, accuracy) of every model on (features, label), in one pass."""
    scored = rows.select(label, boosting.chances(grown, "features").alias("p"))
    row = scored.agg(*[m for i in range(len(grown)) for m in (
        log_loss(F.col(label), F.col("p")[i]), accuracy(F.col(label), (F.col("p")[i] > 0.5).cast("int")))]).first()
    return [(float(row[2 * i]), float(row[2 * i + 1])) for i in range(len(grown))]


def _fit_batch(train: DataFrame, validation: DataFrame, label: str):
    """A function from parameter sets to (log loss, accuracy) on the validation rows, and what frees its rows.

    The preprocessing stages do not depend on the searched parameters, so they are fitted
    once and both splits are turned into vectors once (``prepared``); a batch's trees
    are grown together (``boosting.grow``) and all its models score in one pass.
    """
    prep = fit(feature_pipeline(), train, label)
    tr, va = prepared(prep, train, label), prepared(prep, validation, label)

    def batch(params: Sequence[Mapping[str, float]]) -> list[tuple[float, float]]:
        return validation_metrics(va, boosting.grow(tr, params, label), label)

    def free() -> None:
        tr.unpersist()
        va.unpersist()
    return batch, free


def adaptive_search(train: DataFrame, validation: DataFrame, label: str = "Churn",
                    space: Mapping[str, object] = SEARCH_SPACE, max_evals: int = MAX_EVALS,
                    parallelism: int = PARALLELISM, seed: int = SEARCH_SEED) -> DataFrame:
    """The trials table: ``parallelism`` models at a time, all grown together.

    The first ``tpe.STARTUP`` trials are the seeded draws, later ones are
    proposed from the finished ones; so the reference's eight are draws.
    """
    from attrix.operators import tpe

    batch, free = _fit_batch(train, validation, label)
    metrics: list[tuple[float, float]] = []

    def losses(params):
        metrics.extend(found := batch(params))
        return [m[0] for m in found]

    try:
        done = tpe.search(losses, {k: space[k] for k in PARAM_NAMES}, max_evals, max(1, parallelism), seed)
    finally:
        free()
    # One small row per trial: the trial count is the search budget.
    return train.sparkSession.createDataFrame([(i, *[float(p[k]) for k in PARAM_NAMES], *m)
                                               for i, ((p, _), m) in enumerate(zip(done, metrics))], TRIALS_SCHEMA)


def random_search(train: DataFrame, validation: DataFrame, label: str = "Churn",
                  space: Mapping[str, object] = SEARCH_SPACE, max_evals: int = MAX_EVALS,
                  parallelism: int = PARALLELISM, seed: int = SEARCH_SEED) -> DataFrame:
    """The same with seeded draws throughout."""
    draws = draw_params(space, max_evals, seed)
    batch, free = _fit_batch(train, validation, label)
    try:
        step = max(1, parallelism)
        metrics = [m for i in range(0, len(draws), step) for m in batch(draws[i:i + step])]
    finally:
        free()
    return train.sparkSession.createDataFrame([(i, *[float(p[k]) for k in PARAM_NAMES], *m)
                                               for i, (p, m) in enumerate(zip(draws, metrics))], TRIALS_SCHEMA)


def best_trial(trials: DataFrame) -> DataFrame:
    """The trial with the lowest log loss (ties: lowest trial id)."""
    return trials.orderBy(F.col("log_loss").asc(), F.col("trial_id").asc()).limit(1)


def best_params(trials: DataFrame) -> dict[str, float]:
    row = best_trial(trials).first()
    return {k: row[k] for k in PARAM_NAMES}


def compare_baselines(train: DataFrame, validation: DataFrame, label: str = "Churn",
                      parallelism: int = 3) -> DataFrame:
    """Fit each baseline family on the same split (shared preprocessing, as
    in ``random_search``); one metrics row each."""
    spark = train.sparkSession
    models = baseline_classifiers(label)
    prep = fit(feature_pipeline(), train, label)
    tr, va = prepared(prep, train, label), prepared(prep, validation, label)

    def one(item):
        name, clf = item
        r = evaluate(score(clf.fit(tr), va, keep=[label]), label).first()
        return (name, int(r["n_rows"]), float(r["log_loss"]), float(r["accuracy"]))

    try:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            rows = list(pool.map(one, models.items()))
    finally:
        tr.unpersist()
        va.unpersist()
    return spark.createDataFrame(rows, "model string, n_validation bigint, log_loss double, accuracy double")


def promotion_gate(metrics: DataFrame, metric: str = "accuracy", threshold: float = ACCURACY_GATE,
                   model_col: str = "model", higher_is_better: bool = True) -> DataFrame:
    """(model, metric, value, threshold, passed) per model row of ``metrics``.

    The decision is data: the caller promotes the models with ``passed``.
    """
    value = F.col(metric).cast("double")
    passed = value >= F.lit(threshold) if higher_is_better else value <= F.lit(threshold)
    return metrics.select(F.col(model_col).alias("model"), F.lit(metric).alias("metric"),
                          value.alias("value"), F.lit(float(threshold)).alias("threshold"),
                          F.coalesce(passed, F.lit(False)).alias("passed"))


def trials_from_rows(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), TRIALS_SCHEMA)
