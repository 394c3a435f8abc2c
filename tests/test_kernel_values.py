"""Least-squares attributions against Shapley values by all coalitions."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from attrix.operators import kernel_shap as K

FEATURES = [f"f{j}" for j in range(8)]


def model(v):
    return v[0] * v[1] + math.sin(v[2]) * v[3] + 2 * v[4] + abs(v[5] - v[6]) + v[7] * v[0] * v[5]


def predict(rows):
    c = [F.col(f) for f in FEATURES]
    return rows.withColumn("__f", c[0] * c[1] + F.sin(c[2]) * c[3] + 2 * c[4] + F.abs(c[5] - c[6]) + c[7] * c[0] * c[5])


def shapley(x, background):
    p = len(x)

    def value(s):
        return np.mean([model([x[j] if j in s else b[j] for j in range(p)]) for b in background])
    known = {s: value(s) for n in range(p + 1) for s in itertools.combinations(range(p), n)}
    phi = []
    for j in range(p):
        rest = [i for i in range(p) if i != j]
        phi.append(sum(math.factorial(n) * math.factorial(p - n - 1) / math.factorial(p)
                       * (known[tuple(sorted((*s, j)))] - known[s])
                       for n in range(p) for s in itertools.combinations(rest, n)))
    return phi


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(6)
    rows = [(i, *map(float, rng.normal(size=8))) for i in range(25)]
    schema = "id long, " + ", ".join(f"{f} double" for f in FEATURES)
    return rows[:5], rows[5:], spark.createDataFrame(rows[:5], schema), spark.createDataFrame(rows[5:], schema)


def values(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["id"], {})[r["feature"]] = r
    return out


def test_all_sets_give_exact_values(data):
    x, bg, explained, background = data
    got = values(K.kernel_values(predict, explained, background, "id", FEATURES, budget=300, partners=50))
    for r in x:
        want = shapley(r[1:], [b[1:] for b in bg])
        assert [got[r[0]][f]["phi"] for f in FEATURES] == pytest.approx(want, abs=1e-6)


def test_sampled_sets_add_up_and_come_near(data):
    x, bg, explained, background = data
    got = values(K.kernel_values(predict, explained, background, "id", FEATURES, budget=120, partners=50))
    far = []
    for r in x:
        rows = got[r[0]]
        assert sum(v["phi"] for v in rows.values()) == pytest.approx(rows["f0"]["prediction"] - rows["f0"]["base_value"], abs=1e-9)
        assert rows["f0"]["prediction"] == pytest.approx(model(r[1:]))
        want = shapley(r[1:], [b[1:] for b in bg])
        far += [abs(rows[f]["phi"] - w) for f, w in zip(FEATURES, want)]
    assert np.mean(far) < 0.15


def test_partners_are_different_background_rows(data):
    _, bg, explained, background = data
    few = values(K.kernel_values(predict, explained, background, "id", FEATURES, budget=40, partners=4))
    bases = [model(b[1:]) for b in bg]
    sums = {round(sum(c), 6) for c in itertools.combinations(bases, 4)}
    assert all(round(4 * r["f0"]["base_value"], 6) in sums for r in few.values())


def test_sets_and_their_limits():
    sets, weights = K.coalitions(5, 100)
    assert len(sets) == 30 and len({tuple(s) for s in sets}) == 30
    assert weights == pytest.approx([K.kernel_weight(5, int(s.sum())) for s in sets])
    sets, weights = K.coalitions(21, 100)
    assert 42 < len(sets) <= 100 and {tuple(1 - s) for s in sets} == {tuple(s) for s in sets}
    whole = sum(K.kernel_weight(21, s) * math.comb(21, s) for s in range(1, 21))
    assert weights.sum() == pytest.approx(whole)
    with pytest.raises(ValueError):
        K.coefficients(*K.coalitions(21, 10), 21)


def test_one_feature_and_no_background(spark):
    df = spark.createDataFrame([(1, 3.0), (2, 5.0)], "id long, a double")
    plain = values(K.kernel_values(lambda r: r.withColumn("__f", F.col("a") * 2), df, df, "id", ["a"], partners=9))
    assert [plain[i]["a"]["phi"] for i in (1, 2)] == pytest.approx([-2.0, 2.0])
    with pytest.raises(ValueError):
        K.kernel_values(lambda r: r, df, df.limit(0), "id", ["a"])


def test_evaluations_are_spread_over_tasks(data, monkeypatch):
    """A few KB of rows lead to thousands of evaluations: tasks go by these, whatever the bytes say; the values stay."""
    from attrix.operators import explain as X

    _, _, explained, background = data
    seen = []

    def counted(rows):
        seen.append(rows.rdd.getNumPartitions())
        return predict(rows)

    one = values(K.kernel_values(counted, explained, background, "id", FEATURES, budget=40, partners=20))
    monkeypatch.setattr(X, "TASK_EVALUATIONS", 200)
    many = values(K.kernel_values(counted, explained, background, "id", FEATURES, budget=40, partners=20))
    assert seen[0] == 1 and seen[1] >= 15  # 5 rows, 20 partners, about 40 sets
    assert all(many[i][f]["phi"] == pytest.approx(one[i][f]["phi"], abs=1e-9) for i in one for f in FEATURES)
