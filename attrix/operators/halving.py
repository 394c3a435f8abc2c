"""Comparison of models inside a budget: successive halving of boosted trees, beside the baseline families.

``trials`` seeded draws start with ``least`` trees each. A rung scores them on the
validation split, keeps the best share ``1 / factor`` by log loss (ties: lower trial id) and
lets those go on to ``factor`` times as many trees; they continue from the trees they have
(``boosting.grow`` with ``begun``), so no tree is grown twice. A trial never grows past its own
``n_estimators``. All trials of a rung grow together, one pass over the rows per level.

The budget is wall-clock time, as in a managed comparison run: a rung is grown in steps of
``least`` trees, and a step starts only if the last step's time per tree says that it ends in
time. A rung that could not be ended is left out; the last whole rung then ranks the trials.
Only the first step always runs. The driver holds one small row per trial and rung.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrix.operators import boosting
from attrix.operators.model import baseline_classifiers, evaluate, fit, prepared, score
from attrix.operators.preprocess import feature_pipeline
from attrix.operators.tuning import PARAM_NAMES, SEARCH_SEED, SEARCH_SPACE, draw_params, validation_metrics

TRIALS, LEAST, FACTOR = 8, 10, 2
SECONDS = 600.0
FAMILIES = ("logistic_regression", "random_forest")
RUNGS_SCHEMA = ("rung int, trial_id int, " + ", ".join(f"{p} double" for p in PARAM_NAMES)
                + ", trees bigint, log_loss double, accuracy double, kept boolean")
LEADER_SCHEMA = "model string, trial_id int, trees bigint, log_loss double, accuracy double"


def ladder(trials: int, least: int, factor: int) -> list[tuple[int, int]]:
    """(trials, trees at most) of every rung; the last one holds fewer than ``factor`` trials."""
    if trials < 1 or least < 1 or factor < 2:
        raise ValueError(f"trials={trials}, least={least}, factor={factor} is out of range")
    out = [(trials, least)]
    while out[-1][0] >= factor:
        out.append((out[-1][0] // factor, out[-1][1] * factor))
    return out


@dataclass(frozen=True)
class Standing:
    """A trial at the end of a rung."""

    rung: int
    trial: int
    trees: int
    log_loss: float
    accuracy: float
    kept: bool


def halve(params: Sequence[Mapping[str, float]], go_on: Callable, measure: Callable, least: int, factor: int,
          seconds: float, clock: Callable[[], float] = time.monotonic) -> tuple[list[Standing], dict[int, object]]:
    """All standings, rung by rung, and the models of the last whole rung by trial.

    ``go_on(params, models)`` grows models (None: new ones) up to their ``n_estimators``;
    ``measure(models)`` gives (log loss, accuracy) of each.
    """
    start, standings = clock(), []
    alive, models = list(range(len(params))), None
    per_tree, ended = 0.0, {}
    rungs = ladder(len(params), least, factor)
    for rung, (_, most) in enumerate(rungs):
        reached = 0 if rung == 0 else rungs[rung - 1][1]
        while reached < most:
            began = clock()
            step = min(least, most - reached)
            if models is not None and began - start + per_tree * step > seconds:
                return standings, ended
            reached += step
            models = go_on([{**params[t], "n_estimators": min(params[t]["n_estimators"], reached)} for t in alive], models)
            per_tree = (clock() - began) / step
        found = measure(models)
        order = sorted(range(len(alive)), key=lambda k: (found[k][0], alive[k]))
        keep = set(order[:rungs[rung + 1][0]]) if rung + 1 < len(rungs) else {order[0]}
        standings += [Standing(rung, t, int(min(params[t]["n_estimators"], most)), *found[k], k in keep)
                      for k, t in enumerate(alive)]
        ended = dict(zip(alive, models))
        alive, models = [t for k, t in enumerate(alive) if k in keep], [m for k, m in enumerate(models) if k in keep]
    return standings, ended


@dataclass
class Comparison:
    rungs: DataFrame        # RUNGS_SCHEMA
    leaderboard: DataFrame  # LEADER_SCHEMA: the families and the trials of the last whole rung, best first
    best: boosting.Grown    # the best trial's trees, on ``prep``'s vectors
    prep: object


def budgeted_comparison(train: DataFrame, validation: DataFrame, label: str = "Churn",
                        space: Mapping[str, object] = SEARCH_SPACE, trials: int = TRIALS, least: int = LEAST,
                        factor: int = FACTOR, seconds: float = SECONDS, families: Sequence[str] = FAMILIES,
                        seed: int = SEARCH_SEED, clock: Callable[[], float] = time.monotonic) -> Comparison:
    """Fit the baseline ``families``, then halve boosters in the time that is left.

    Preprocessing is fitted on ``train`` once and both splits become vectors once. Families
    that the budget has no time for any more are left out of the leaderboard. A null label
    fits and scores nothing; without any labelled training row the fit raises.
    """
    spark, start = train.sparkSession, clock()
    params = draw_params(space, trials, seed)
    train, validation = (rows.where(F.col(label).isNotNull()) for rows in (train, validation))
    prep = fit(feature_pipeline(), train, label)
    tr, va = prepared(prep, train, label), prepared(prep, validation, label)
    try:
        leaders: list[tuple] = []
        for name in families:
            if clock() - start > seconds:
                break
            r = evaluate(score(baseline_classifiers(label)[name].fit(tr), va, keep=[label]), label).first()
            leaders.append((name, None, None, r["log_loss"], r["accuracy"]))
        standings, ended = halve(params, lambda p, m: boosting.grow(tr, p, label, begun=m),
                                 lambda m: validation_metrics(va, m, label), least, factor,
                                 seconds - (clock() - start), clock)
    finally:
        tr.unpersist()
        va.unpersist()
    last = [s for s in standings if s.rung == standings[-1].rung]
    leaders += [("boosted_trees", s.trial, s.trees, s.log_loss, s.accuracy) for s in last]
    leaders.sort(key=lambda r: (r[3], r[0], r[1] or 0))
    rows = [(s.rung, s.trial, *[float(params[s.trial][k]) for k in PARAM_NAMES], s.trees, s.log_loss, s.accuracy, s.kept)
            for s in standings]
    best = min(last, key=lambda s: (s.log_loss, s.trial)).trial
    # one small row per trial and rung
    return Comparison(spark.createDataFrame(rows, RUNGS_SCHEMA), spark.createDataFrame(leaders, LEADER_SCHEMA), ended[best], prep)
