"""Attributions by least squares against every background row."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from attrix.operators import boosting as B
from attrix.operators import explain as X
from attrix.operators import kernel_shap as K
from attrix.operators.model import build_model, fit

BOOLEAN, NUMERIC, CATEGORICAL = ["b"], ["u", "v"], ["c", "d"]
FEATS = [*BOOLEAN, *NUMERIC, *CATEGORICAL]
PARAMS = {"max_depth": 4, "learning_rate": 0.3, "min_child_weight": 1, "n_estimators": 20}


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(9)
    out = []
    for i in range(400):
        u, v, c, d = float(rng.integers(0, 30)), float(rng.normal()), str(rng.choice(["x", "y", "z"])), str(rng.choice(["p", "q"]))
        b = bool(rng.random() < 0.4)
        y = int(rng.random() < 1 / (1 + np.exp(-(0.2 * u - 3 + v * (c == "x") + 2 * b * (d == "p")))))
        out.append((i, None if i % 17 == 0 else b, None if i % 13 == 0 else u, v, None if i % 11 == 0 else c, d, y))
    return spark.createDataFrame(out, "customerID long, b boolean, u double, v double, c string, d string, Churn int").cache()


@pytest.fixture(scope="module")
def model(rows):
    return fit(build_model(PARAMS, boolean=BOOLEAN, numeric=NUMERIC, categorical=CATEGORICAL), rows)


def values(df):
    return {(r["customerID"], r["feature"]): r for r in df.collect()}


def by_rows(model):
    """The model as a function: each explained row meets each background row in a row of its own."""
    return lambda rows: model.transform(rows).withColumn("__f", X.positive_probability("probability"))


@pytest.mark.parametrize("budget", [12, 100])
def test_every_background_row_counts(model, rows, budget, monkeypatch):
    explained = rows.where("customerID % 50 = 1").unionByName(rows.where("customerID = 51"))  # one comes twice
    background = rows.where("customerID % 7 = 0").unionByName(rows.where("customerID = 14"))
    args = (explained, background, "customerID", FEATS, budget)
    mean = model.transform(background).agg(F.avg(X.positive_probability("probability"))).first()[0]
    want = values(K.kernel_values(by_rows(model), *args))
    monkeypatch.setattr(K, "SIDE", 7)  # several blocks of each set
    got = values(K.kernel_values(model, *args))
    assert got.keys() == want.keys() and len(got) == 8 * len(FEATS)
    for k, w in want.items():
        assert w["base_value"] == pytest.approx(mean * (2 if k[0] == 51 else 1), abs=1e-9)
        for c in ("phi", "base_value", "prediction"):
            assert got[k][c] == pytest.approx(w[c], abs=1e-9)


def test_trees_make_no_mixed_row(model, rows, monkeypatch):
    def refuse(*_):
        raise AssertionError("mixed rows went through the whole model")

    monkeypatch.setattr(B.HistogramTreesModel, "_transform", refuse)
    phi = K.kernel_values(model, rows.where("customerID < 5"), rows.where("customerID > 300"), "customerID", FEATS)
    assert phi.count() == 5 * len(FEATS)
    assert K.kernel_values(model, rows.where("customerID < 0"), rows, "customerID", FEATS).count() == 0


def test_crossed_margins_are_those_of_mixed_rows():
    rng = np.random.default_rng(3)
    cuts = [np.sort(rng.normal(size=k)) for k in (1, 1, 40, 9, 1, 1)]
    trees = []
    for n in rng.integers(0, 15, 40):
        tree, open_ = B.Tree(), [0]
        for _ in range(n):
            slot = int(rng.integers(6))
            open_ += tree.split(open_.pop(rng.integers(len(open_))), slot, int(rng.integers(len(cuts[slot]))))
        tree.value = rng.normal(size=len(tree.value)).tolist()
        trees.append(tree)
    grown = B.Grown(cuts, trees)
    x, other = rng.normal(size=(30, 6)), rng.normal(size=(20, 6))
    for mine in (np.array(m, bool) for m in ((1, 0, 1, 0, 1, 0), (0, 0, 0, 1, 1, 1), (1,) * 6, (0,) * 6)):
        mixed = np.where(mine, x[:, None], other[None])
        got = grown.crossed_margins(B.bin_rows(x, cuts), B.bin_rows(other, cuts), mine)
        assert got == pytest.approx(grown.margin(mixed.reshape(-1, 6)).reshape(30, 20), abs=1e-12)
