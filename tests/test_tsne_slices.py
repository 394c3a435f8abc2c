"""Attraction by slices of the edges: the sums of one pass over all, bit by bit."""

import numpy as np

from attrix.operators import tsne as T


def test_attraction_by_slices(monkeypatch):
    monkeypatch.setattr(T, "SLICE", 7)
    rng = np.random.default_rng(2)
    places = rng.normal(size=(40, 2))
    src, dst, p = np.sort(rng.integers(0, 30, 300)), rng.integers(0, 40, 300), rng.random(300)
    slices = T._edge_slices(src)
    assert slices[0][0] == 0 and slices[-1][1] == 300 and all(a[1] == b[0] for a, b in zip(slices, slices[1:])) and len(slices) > 20
    gap = places[src] - places[dst]
    pull = (p / (1.0 + (gap ** 2).sum(1)))[:, None] * gap * 12.0
    want = np.stack([np.bincount(src, pull[:, j], 30) for j in (0, 1)], 1)
    assert np.array_equal(T.pull_of(places, 30, src, dst, p, 12.0, slices), want)
    assert T._edge_slices(np.empty(0, int)) == []
