"""Steps of a sample that walk the trees together: the same values as mixed rows, and no mixed row is made."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from attrix.operators import boosting as B
from attrix.operators import explain as X
from attrix.operators.model import build_model, fit
from attrix.operators.preprocess import slot_features

BOOLEAN, NUMERIC, CATEGORICAL = ["b"], ["u", "v"], ["c", "d"]
FEATS = [*BOOLEAN, *NUMERIC, *CATEGORICAL]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    out = []
    for i in range(600):
        u, v, c, d = float(rng.integers(0, 30)), float(rng.normal()), str(rng.choice(["x", "y", "z"])), str(rng.choice(["p", "q"]))
        b = bool(rng.random() < 0.4)
        y = int(rng.random() < 1 / (1 + np.exp(-(0.2 * u - 3 + v * (c == "x") + 2 * b * (d == "p")))))
        out.append((i, None if i % 17 == 0 else b, None if i % 13 == 0 else u, v, None if i % 11 == 0 else c, "" if i % 19 == 0 else d, y))
    return spark.createDataFrame(out, "customerID long, b boolean, u double, v double, c string, d string, Churn int").cache()


@pytest.fixture(scope="module")
def model(rows):
    params = {"max_depth": 5, "learning_rate": 0.2, "min_child_weight": 1, "n_estimators": 25}
    return fit(build_model(params, boolean=BOOLEAN, numeric=NUMERIC, categorical=CATEGORICAL), rows)


class Opaque:
    """A model of which only ``transform`` is known."""

    def __init__(self, model):
        self.transform = model.transform


def test_slots_have_their_features(model, rows):
    owners = slot_features(model.stages[:-1])
    assert owners == ["b"] * 2 + ["u", "v"] + ["c"] * 4 + ["d"] * 3
    assert len(owners) == len(model.transform(rows).first()["features"])
    assert slot_features(model.stages[1:-1]) is None and slot_features(model.stages) is None


@pytest.mark.parametrize("features", [FEATS, [*reversed(FEATS), "spare"]])
def test_values_are_those_of_mixed_rows(model, rows, features):
    rows = rows.withColumn("spare", F.col("u") + 1)
    explained = rows.where("customerID % 40 = 1").unionByName(rows.where("customerID = 41"))  # one comes twice
    background = rows.where("customerID % 7 = 0")
    args = (explained, background, "customerID", features, 6)
    got, want = ({(r["customerID"], r["feature"]): r for r in X.shapley_values(m, *args, with_scores=True).collect()}
                 for m in (model, Opaque(model)))
    assert got.keys() == want.keys() and len(got) == 15 * len(features)
    for k, w in want.items():
        for c in ("phi", "base_value", "prediction", "expected_value"):
            assert got[k][c] == pytest.approx(w[c], abs=1e-12)
    short = X.shapley_values(model, *args)
    assert short.columns == ["customerID", "feature", "phi"] and short.count() == len(got)


def test_no_mixed_row_is_made(model, rows, monkeypatch):
    def refuse(*_):
        raise AssertionError("mixed rows went through the whole model")

    monkeypatch.setattr(B.HistogramTreesModel, "_transform", refuse)
    phi = X.shapley_values(model, rows.where("customerID < 5"), rows.where("customerID > 500"), "customerID", FEATS, 4)
    assert phi.count() == 5 * len(FEATS)


def test_other_models_and_tables_go_by_rows(model, rows):
    owners = lambda m, e=rows, b=rows, f=FEATS: X._slot_owners(m, e, b, f)
    assert owners(model) == [0, 0, 1, 2, 3, 3, 3, 3, 4, 4, 4]
    assert owners(Opaque(model)) is None
    assert owners(PipelineModel(stages=model.stages[:-1])) is None
    assert owners(model, e=rows.withColumn("u", F.col("u").cast("float"))) is None
    assert owners(model, f=FEATS[1:]) is None


def test_chain_margins_equal_margins_bit_by_bit():
    rng = np.random.default_rng(8)
    n, owner = 70, np.array([0, 0, 1, 2, 3, 3, 3])
    cuts = [np.sort(rng.normal(size=k)) for k in (1, 1, 40, 9, 1, 1, 1)]
    trees = []
    for _ in range(12):
        tree, open_ = B.Tree(), [0]
        for _ in range(14):
            node = open_.pop(rng.integers(len(open_)))
            slot = int(rng.integers(7))
            open_ += tree.split(node, slot, int(rng.integers(len(cuts[slot]))))
        tree.value = rng.normal(size=len(tree.value)).tolist()
        trees.append(tree)
    trees.append(B.Tree(value=[0.3]))  # a leaf alone
    grown = B.Grown(cuts, trees)
    x, other = rng.normal(size=(n, 7)), rng.normal(size=(n, 7))
    place = np.argsort(rng.random((n, 4)), axis=1)
    mixed = np.where(place[:, owner][:, None, :] < np.arange(5)[None, :, None], x[:, None], other[:, None])
    got = grown.chain_margins(B.bin_rows(x, cuts), B.bin_rows(other, cuts), place, owner)
    assert np.array_equal(got, grown.margin(mixed.reshape(-1, 7)).reshape(n, 5))
