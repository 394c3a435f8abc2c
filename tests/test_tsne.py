"""t-SNE: graph, affinities and repulsion against plain forms; maps of planted clusters in one block and in several."""

import numpy as np
import pytest

from attrix.operators import tsne as T

DIMS = 12
NAMES = [f"f{j}" for j in range(DIMS)]


def trustworthiness(x, y, k=10):
    n = len(x)
    far = ((x[:, None] - x[None]) ** 2).sum(2)
    near = ((y[:, None] - y[None]) ** 2).sum(2)
    np.fill_diagonal(far, -1)
    np.fill_diagonal(near, np.inf)
    rank = far.argsort(1, kind="stable").argsort(1)
    lost = sum(np.maximum(rank[i, near[i].argsort()[:k]] - k, 0).sum() for i in range(n))
    return 1 - 2 * lost / (n * k * (2 * n - 3 * k - 1))


@pytest.fixture(scope="module")
def planted():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(10, DIMS)) * 4
    group = rng.integers(0, 10, 600)
    return centres[group] + rng.normal(size=(600, DIMS)), group


@pytest.fixture(scope="module")
def rows(spark, planted):
    return spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(planted[0])], ["key", *NAMES])


def test_repulsion_equals_pair_sums():
    rng = np.random.default_rng(0)
    at = rng.normal(size=(300, 2)) * 12
    gap = at[:, None] - at[None]
    w = 1 / (1 + (gap ** 2).sum(2))
    push, z = T.repulsion(at[:200], at[200:], np.ones(100))
    want = (w[..., None] ** 2 * gap).sum(1)[:200]
    assert z == pytest.approx(w.sum() - 300, rel=0.05)
    assert np.abs(push - want).max() < 0.1 * np.abs(want).max()


def test_affinities_have_the_wanted_perplexity():
    d2 = np.random.default_rng(1).gamma(3, size=(50, 90)) * np.array([1e-6, 1.0, 1e6, 10, 0.1] * 10)[:, None]
    p = T.calibrated(d2, 30)
    assert np.allclose(p.sum(1), 1)
    assert np.allclose(np.exp(-(p * np.log(p)).sum(1)), 30, rtol=1e-6)
    short = T.calibrated(np.array([[1.0, np.nan, np.nan], [0.0, 0.0, 0.0]]), 30)
    assert np.allclose(short, [[1, 0, 0], [1 / 3] * 3])


def test_graph_against_all_pairs(spark, rows, planted):
    from pyspark.sql import functions as F

    x, _ = planted
    points = rows.select(F.col("key").alias("id"), F.array(*NAMES).alias("v"))
    leaves = T.leaves_of(points, len(x), DIMS, 42, leaf=80).persist()
    sizes = leaves.groupBy("tree", "node").count()
    assert sizes.agg(F.max("count")).first()[0] <= 100
    assert leaves.count() == T.TREES * len(x)
    got = {r["id"]: [e["other"] for e in r["near"]] for r in T.neighbours(leaves, 15).collect()}
    d2 = ((x[:, None] - x[None]) ** 2).sum(2)
    np.fill_diagonal(d2, np.inf)
    order = d2.argsort(1)[:, :15]
    assert np.mean([len(set(got[i]) & set(order[i])) / 15 for i in range(len(x))]) > 0.9
    whole = {r["id"]: [e["other"] for e in r["near"]] for r in T.neighbours(T.leaves_of(points, len(x), DIMS, 42, 1, 1000), 15).collect()}
    assert all(whole[i] == order[i].tolist() for i in range(len(x)))
    p = T.affinities(T.neighbours(leaves, 15), len(x), 5.0).collect()
    share = {(r["id"], r["other"]): r["p"] for r in p}
    assert sum(share.values()) == pytest.approx(1)
    assert all(share[b, a] == pytest.approx(v) for (a, b), v in share.items())


@pytest.mark.parametrize("block_points,leaf", [(20_000, 256), (200, 75)])
def test_planted_clusters(rows, planted, block_points, leaf):
    x, group = planted
    got = {r["key"]: (r["x"], r["y"]) for r in T.tsne(rows, "key", NAMES, block_points=block_points, leaf=leaf).collect()}
    y = np.array([got[i] for i in range(len(x))])
    centred = x - x.mean(0)
    pca = centred @ np.linalg.svd(centred, full_matrices=False)[2][:2].T
    kept = trustworthiness(x, y)
    assert np.isfinite(y).all() and kept > 0.9 and kept >= trustworthiness(x, pca)
    near = ((y[:, None] - y[None]) ** 2).sum(2)
    np.fill_diagonal(near, np.inf)
    assert (group[near.argmin(1)] == group).mean() > 0.95


def test_edges(spark):
    schema = "key string, f0 double, f1 double, x string"
    assert T.tsne(spark.createDataFrame([], schema), "key", ["f0", "f1"]).collect() == []
    one = T.tsne(spark.createDataFrame([("a", 1.0, None, "z"), ("b", 1.0, 0.0, "z"), (None, 2.0, 2.0, "z")], schema), "key", ["f0", "f1"])
    assert sorted(map(tuple, one.collect())) == [("a", 0.0, 0.0), ("b", 0.0, 0.0)]
    few = spark.createDataFrame([("a", 1.0, 0.0, "z"), ("b", 5.0, 0.0, "z"), ("c", 1.0, 0.0, "z"), ("c", 1.0, 0.0, "z"), ("d", 9.0, 1.0, "z")], schema)
    got = {r["key"]: (r["x"], r["y"]) for r in T.tsne(few, "key", ["f0", "f1"], steps=60, early=20).collect()}
    assert set(got) == set("abcd") and got["a"] == got["c"] and np.isfinite(list(got.values())).all()
    line = T.tsne(few, "key", ["f0"], steps=40, early=20).collect()
    assert len(line) == 4
