"""Parzen search: densities and proposals against plain forms, draws, and gain over random draws."""

import math

import numpy as np
import pytest

from attrix.operators import tpe
from attrix.operators.tuning import PARAM_NAMES, SEARCH_SPACE, LogUniform, QUniform, draw_params

LOW, HIGH = -2.0, 3.0


def plain_mixture(values):
    """(centre, width, weight) of every component, one by one."""
    n = len(values)
    out = []
    everything = sorted([*values, (LOW + HIGH) / 2])
    for i, v in enumerate(values):
        at = sorted([*values, (LOW + HIGH) / 2]).index(v)
        left = v - (everything[at - 1] if at else LOW)
        right = (everything[at + 1] if at + 1 < len(everything) else HIGH) - v
        width = min(max(left, right, (HIGH - LOW) / min(100, n + 2)), HIGH - LOW)
        faded = n - tpe.FULL_WEIGHT
        weight = 1.0 if i >= faded else 1 / n + (1 - 1 / n) * (i / (faded - 1) if faded > 1 else 0)
        out.append((v, width, weight))
    return [*out, ((LOW + HIGH) / 2, HIGH - LOW, 1.0)]


def plain_cdf(x, mu, s):
    return 0.5 * (1 + math.erf((x - mu) / (s * math.sqrt(2))))


@pytest.mark.parametrize("n", [1, 2, 7, 40])
def test_densities_equal_plain_sums(n):
    values = np.random.default_rng(n).uniform(LOW, HIGH, n).tolist()
    parts = plain_mixture(values)
    inside = sum(w * (plain_cdf(HIGH, m, s) - plain_cdf(LOW, m, s)) for m, s, w in parts)
    fit = tpe.Parzen(values, LOW, HIGH)
    for x in np.linspace(LOW, HIGH, 23):
        density = sum(w * math.exp(-0.5 * ((x - m) / s) ** 2) / (s * math.sqrt(2 * math.pi)) for m, s, w in parts)
        assert fit.log_density([x])[0] == pytest.approx(math.log(density / inside), abs=1e-9)
        lo, hi = max(LOW, x - 0.25), min(HIGH, x + 0.25)
        mass = sum(w * (plain_cdf(hi, m, s) - plain_cdf(lo, m, s)) for m, s, w in parts)
        assert fit.log_mass([x], 0.5)[0] == pytest.approx(math.log(mass / inside), abs=1e-9)
    drawn = fit.draw(np.random.default_rng(0), 200)
    assert ((LOW <= drawn) & (drawn <= HIGH)).all()


@pytest.mark.parametrize("dim", [QUniform(-2, 3, 0.5), LogUniform(-2, 3)])
def test_proposal_is_the_best_candidate(dim):
    rng = np.random.default_rng(4)
    values = [dim.draw(rng) for _ in range(30)]
    best, rest = values[:4], values[4:]
    got = tpe.propose_value(dim, best, rest, np.random.default_rng(11))
    back = math.log if isinstance(dim, LogUniform) else float
    drawn = tpe.Parzen([back(v) for v in best], LOW, HIGH).draw(np.random.default_rng(11), tpe.CANDIDATES)

    def chance(x, part):
        parts = plain_mixture([back(v) for v in part])
        inside = sum(w * (plain_cdf(HIGH, m, s) - plain_cdf(LOW, m, s)) for m, s, w in parts)
        if isinstance(dim, LogUniform):
            return sum(w * math.exp(-0.5 * ((x - m) / s) ** 2) / s for m, s, w in parts) / inside
        return sum(w * (plain_cdf(min(HIGH, x + .25), m, s) - plain_cdf(max(LOW, x - .25), m, s)) for m, s, w in parts) / inside
    if isinstance(dim, QUniform):
        drawn = [round(x / 0.5) * 0.5 for x in drawn]
    want = max(drawn, key=lambda x: chance(x, best) / chance(x, rest))
    assert back(got) == pytest.approx(want, abs=1e-12)


def test_best_and_rest_keep_age_and_put_failures_last():
    assert tpe.best_and_rest([3.0, float("nan"), 1.0, 2.0, None]) == ([2], [0, 1, 3, 4])
    best, rest = tpe.best_and_rest(list(range(100, 0, -1)))
    assert best == [97, 98, 99] and rest == list(range(97))


def run(objective, evals, parallelism, seed, startup=tpe.STARTUP):
    space = {k: SEARCH_SPACE[k] for k in PARAM_NAMES}
    return tpe.search(lambda batch: [objective(p) for p in batch], space, evals, parallelism, seed, startup)


def bowl(p):
    return ((math.log(p["learning_rate"]) + 2.2) ** 2 + 0.2 * (p["max_depth"] - 5) ** 2
            + (math.log(p["min_child_weight"]) - 0.4) ** 2 + ((p["n_estimators"] - 320) / 80) ** 2)


def test_first_trials_are_the_seeded_draws():
    assert [p for p, _ in run(bowl, 20, 8, 42)] == draw_params(SEARCH_SPACE, 20, 42)
    assert [p for p, _ in run(bowl, 8, 8, 42)] == draw_params(SEARCH_SPACE, 8, 42)
    assert run(bowl, 33, 8, 5) == run(bowl, 33, 8, 5)


def test_beats_random_draws():
    adaptive = [min(x for _, x in run(bowl, 40, 4, s)) for s in range(20)]
    random = [min(bowl(p) for p in draw_params(SEARCH_SPACE, 40, s)) for s in range(20)]
    assert np.mean(adaptive) < 0.9 * np.mean(random) and np.median(adaptive) < np.median(random)
    for p, _ in run(bowl, 40, 4, 1):
        assert 3 <= p["max_depth"] <= 10 and p["max_depth"] == round(p["max_depth"])
        assert 50 <= p["n_estimators"] <= 500 and p["n_estimators"] % 10 == 0
        assert math.exp(-5) <= p["learning_rate"] <= math.exp(-1)


def test_batches_and_arguments():
    sizes = []
    space = {"x": QUniform(0, 1, 0.1)}
    tpe.search(lambda batch: sizes.append(len(batch)) or [0.0] * len(batch), space, 11, 4, 1)
    assert sizes == [4, 4, 3]
    with pytest.raises(ValueError):
        tpe.search(lambda batch: [0.0] * len(batch), space, 3, 1, 1, startup=0)
