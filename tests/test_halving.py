"""Successive halving: rungs, ties, the budget, and boosters that go on from the trees they have."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from attrix.operators import boosting as B
from attrix.operators import halving as H

PARAMS = [{"max_depth": 3, "learning_rate": 0.3, "min_child_weight": 1.0, "n_estimators": 9},
          {"max_depth": 2, "learning_rate": 0.1, "min_child_weight": 2.0, "n_estimators": 4}]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.normal(size=300).round(1), rng.integers(0, 4, 300), rng.integers(0, 2, 300)]).astype(float)
    y = (rng.random(300) < 1 / (1 + np.exp(-(x[:, 0] + x[:, 1] - 1.5)))).astype(float)
    return spark.createDataFrame([(Vectors.dense(r), float(v)) for r, v in zip(x, y)], ["features", "Churn"]).persist()


@pytest.mark.parametrize("parts", [1, 3])
def test_going_on_equals_one_run(rows, parts):
    rows = rows.coalesce(1) if parts == 1 else rows.repartition(parts).persist()
    whole = B.grow(rows, PARAMS)
    part = B.grow(rows, [{**p, "n_estimators": 3} for p in PARAMS])
    part = B.grow(rows, [{**p, "n_estimators": min(p["n_estimators"], 7)} for p in PARAMS], begun=part)
    assert [len(m.trees) for m in part] == [7, 4]
    part = B.grow(rows, PARAMS, begun=part)
    for a, b in zip(whole, part):
        assert [(t.feature, t.cut, t.left) for t in a.trees] == [(t.feature, t.cut, t.left) for t in b.trees]
        assert all(np.allclose(s.value, t.value, atol=1e-12) for s, t in zip(a.trees, b.trees))
    with pytest.raises(ValueError):
        B.grow(rows, PARAMS, begun=part[:1])


def test_ladder():
    assert H.ladder(8, 10, 2) == [(8, 10), (4, 20), (2, 40), (1, 80)]
    assert H.ladder(10, 4, 3) == [(10, 4), (3, 12), (1, 36)]
    assert H.ladder(1, 5, 2) == [(1, 5)]
    for wrong in ((0, 1, 2), (1, 0, 2), (1, 1, 1)):
        with pytest.raises(ValueError):
            H.ladder(*wrong)


class Clock:
    """Every tree of a step takes one second."""

    now = 0.0

    def __call__(self):
        return self.now


def fake(clock, losses):
    """Models are (trial, trees); what is grown anew costs a second per tree."""
    calls = []

    def go_on(params, models):
        had = [m[1] for m in models] if models else [0] * len(params)
        new = [int(p["n_estimators"]) for p in params]
        clock.now += max([b - a for a, b in zip(had, new)] + [0])
        calls.append((had, new))
        return [(p["id"], t) for p, t in zip(params, new)]
    return calls, go_on, lambda models: [(losses[m[0]] / (1 + m[1]), 0.5) for m in models]


def plain(n, losses, estimators, least, factor):
    """Kept sets rung by rung."""
    alive, trees, out = list(range(n)), least, []
    while True:
        order = sorted(alive, key=lambda t: (losses[t] / (1 + min(estimators[t], trees)), t))
        kept = order[:max(1, len(alive) // factor)]
        out.append((sorted(alive), sorted(kept)))
        if len(alive) < factor:
            return out
        alive, trees = kept, trees * factor


@pytest.mark.parametrize("n,least,factor", [(8, 3, 2), (10, 2, 3), (1, 4, 2), (7, 1, 2)])
def test_rungs_equal_plain_halving(n, least, factor):
    rng = np.random.default_rng(n)
    losses, estimators = rng.integers(1, 4, n).astype(float), rng.integers(2, 30, n)
    clock = Clock()
    calls, go_on, measure = fake(clock, losses)
    standings, ended = H.halve([{"id": t, "n_estimators": float(e)} for t, e in enumerate(estimators)], go_on, measure,
                               least, factor, 1e9, clock)
    got = []
    for rung in range(standings[-1].rung + 1):
        here = [s for s in standings if s.rung == rung]
        assert all(s.trees == min(estimators[s.trial], least * factor ** rung) for s in here)
        got.append((sorted(s.trial for s in here), sorted(s.trial for s in here if s.kept)))
    assert got == plain(n, losses, estimators, least, factor)
    assert sorted(ended) == got[-1][0]
    assert all(a <= b for had, new in calls for a, b in zip(had, new))


@pytest.mark.parametrize("seconds,rungs", [(0, 1), (3, 1), (5.9, 1), (6, 2), (11.9, 2), (12, 3), (1e9, 4)])
def test_budget_is_held(seconds, rungs):
    clock = Clock()
    _, go_on, measure = fake(clock, [4.0, 3.0, 2.0, 1.0, 5.0, 6.0, 7.0, 8.0])
    standings, ended = H.halve([{"id": t, "n_estimators": 100.0} for t in range(8)], go_on, measure, 3, 2, seconds, clock)
    assert standings[-1].rung + 1 == rungs
    assert clock.now <= max(seconds, 3)
    assert len(ended) == 8 >> (rungs - 1)


def test_comparison_over_a_split(spark):
    from attrix.plans.frames import LABEL
    from attrix.plans.queries_model import _split

    train, val = _split(spark, "/root/testdata/sf0.001")
    nobody = val.limit(1).withColumn(LABEL, val[LABEL].cast("int") * None)
    found = H.budgeted_comparison(train, val.unionByName(nobody.select(val.columns)), trials=3, least=2, families=["logistic_regression"])
    rungs = [r.asDict() for r in found.rungs.collect()]
    assert [(r["rung"], r["trees"]) for r in rungs] == [(0, 2)] * 3 + [(1, 4)]
    board = found.leaderboard.collect()
    assert [r["log_loss"] for r in board] == sorted(r["log_loss"] for r in board)
    assert {r["model"] for r in board} == {"logistic_regression", "boosted_trees"}
    assert len(found.best.trees) == 4
