"""Adaptive search by tree-structured Parzen estimators.

Finished trials are parted into the best few and the rest. Per parameter, each
part gives a Parzen density: one normal per value, as wide as the wider gap to its
neighbours, and a wide prior over the whole range. Candidates are drawn from
the density of the best; the one with the largest ratio of the two densities is
proposed. The first ``STARTUP`` proposals are the seeded draws of
``tuning.draw_params``, so a short search is a random one.

Proposals come in batches: all of a batch are made from the trials finished
before it, and evaluated together. What runs on the driver is arithmetic on at most
one row per trial; evaluating a batch is up to the caller's Spark jobs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

import numpy as np

from attrix.operators.tuning import LogUniform, QUniform

# ---------------------------------------------------------------------------
# The published defaults of the method.
STARTUP = 20          # random draws before the densities are used
GAMMA = 0.25          # best trials: GAMMA * sqrt(finished), rounded up ...
BEST_MOST = 25        # ... and at most so many
CANDIDATES = 24       # draws from the density of the best, per parameter
FULL_WEIGHT = 25      # latest values with weight one; older ones fade out
# ---------------------------------------------------------------------------

_erf = np.vectorize(math.erf, otypes=[float])


def _cdf(x, mu, sigma):
    return 0.5 * (1.0 + _erf((np.asarray(x, float) - mu) / (sigma * math.sqrt(2.0))))


class Parzen:
    """A mixture of normals cut off at ``low`` and ``high``, from values in order of age."""

    def __init__(self, values: Sequence[float], low: float, high: float):
        values, width = np.asarray(values, float), high - low
        n = len(values)
        age = np.ones(n)
        if n > FULL_WEIGHT:
            age[:n - FULL_WEIGHT] = np.linspace(1.0 / n, 1.0, n - FULL_WEIGHT)
        mu = np.append(values, (low + high) / 2.0)
        weight = np.append(age, 1.0)
        order = np.argsort(mu, kind="stable")
        self.mu, self.weight = mu[order], weight[order] / weight.sum()
        gaps = np.diff(np.concatenate(([low], self.mu, [high])))
        sigma = np.clip(np.maximum(gaps[:-1], gaps[1:]), width / min(100.0, n + 2.0), width)
        sigma[order == n] = width  # the prior
        self.sigma, self.low, self.high = sigma, low, high
        self.inside = self.weight * (_cdf(high, self.mu, sigma) - _cdf(low, self.mu, sigma))

    def draw(self, rng: np.random.Generator, n: int) -> np.ndarray:
        out = np.empty(n)
        for i in range(n):
            while True:
                k = rng.choice(len(self.mu), p=self.weight)
                x = rng.normal(self.mu[k], self.sigma[k])
                if self.low <= x <= self.high:
                    out[i] = x
                    break
        return out

    def log_density(self, x: np.ndarray) -> np.ndarray:
        z = (np.asarray(x, float)[:, None] - self.mu) / self.sigma
        p = (self.weight / (self.sigma * math.sqrt(2 * math.pi)) * np.exp(-0.5 * z * z)).sum(1)
        return np.log(p / self.inside.sum() + 1e-300)

    def log_mass(self, x: np.ndarray, step: float) -> np.ndarray:
        """Of the step around each ``x``, for parameters on a grid."""
        lo = np.clip(np.asarray(x, float) - step / 2, self.low, self.high)[:, None]
        hi = np.clip(np.asarray(x, float) + step / 2, self.low, self.high)[:, None]
        p = (self.weight * (_cdf(hi, self.mu, self.sigma) - _cdf(lo, self.mu, self.sigma))).sum(1)
        return np.log(p / self.inside.sum() + 1e-300)


def best_and_rest(losses: Sequence[float]) -> tuple[list[int], list[int]]:
    """Indices of the best trials and of the others, both by age; a loss that is no number is the worst."""
    key = [math.inf if x is None or math.isnan(x) else x for x in losses]
    order = sorted(range(len(key)), key=lambda i: (key[i], i))
    n = min(math.ceil(GAMMA * math.sqrt(len(key))), BEST_MOST)
    return sorted(order[:n]), sorted(order[n:])


def propose_value(dimension, best: Sequence[float], rest: Sequence[float], rng: np.random.Generator) -> float:
    """The candidate with the largest density among the best against the rest."""
    if isinstance(dimension, LogUniform):
        fit = [Parzen([math.log(v) for v in part], dimension.low, dimension.high) for part in (best, rest)]
        x = fit[0].draw(rng, CANDIDATES)
        return float(math.exp(x[np.argmax(fit[0].log_density(x) - fit[1].log_density(x))]))
    if isinstance(dimension, QUniform):
        fit = [Parzen(part, dimension.low, dimension.high) for part in (best, rest)]
        x = np.round(fit[0].draw(rng, CANDIDATES) / dimension.q) * dimension.q
        return float(x[np.argmax(fit[0].log_mass(x, dimension.q) - fit[1].log_mass(x, dimension.q))])
    raise TypeError(f"no density for {dimension!r}")


def propose(space: Mapping[str, object], trials: Sequence[Mapping[str, float]], losses: Sequence[float],
            rng: np.random.Generator) -> dict[str, float]:
    """Parameters of the next trial, each parameter on its own."""
    best, rest = best_and_rest(losses)
    return {name: propose_value(dim, [trials[i][name] for i in best], [trials[i][name] for i in rest], rng)
            for name, dim in space.items()}


Evaluate = Callable[[Sequence[dict[str, float]]], Sequence[float]]


def search(evaluate: Evaluate, space: Mapping[str, object], max_evals: int, parallelism: int,
           seed: int, startup: int = STARTUP) -> list[tuple[dict[str, float], float]]:
    """``max_evals`` trials and their losses, in order.

    ``evaluate`` takes a batch of at most ``parallelism`` parameter sets and returns
    a loss for each. The result depends on the seed and the losses only.
    """
    draws = np.random.default_rng(seed)
    done: list[tuple[dict[str, float], float]] = []
    while len(done) < max_evals:
        batch = []
        for i in range(len(done), min(max_evals, len(done) + parallelism)):
            if i < startup:
                batch.append({k: d.draw(draws) for k, d in space.items()})
            elif len(done) < 2:
                raise ValueError("a proposal needs finished trials: startup must be larger than the first batch")
            else:
                batch.append(propose(space, [p for p, _ in done], [x for _, x in done], np.random.default_rng((seed, i))))
        done += list(zip(batch, [float(x) for x in evaluate(batch)], strict=True))
    return done
