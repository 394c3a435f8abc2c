"""Explanations of every customer."""

import numpy as np
import pytest

from attrix.operators.model import build_model, fit
from attrix.plans import queries_model as Q
from attrix.plans.lifecycle import FEATURES

PARAMS = {"max_depth": 4, "learning_rate": 0.3, "min_child_weight": 1, "n_estimators": 20}


def test_every_customer_is_in_a_cluster(spark, monkeypatch):
    rng = np.random.default_rng(4)
    n = 300
    cells = {"customerID": np.arange(n), "tenure": rng.integers(0, 60, n), "Contract": rng.choice([1, 12, 24], n),
             "MonthlyCharges": rng.uniform(20, 120, n), "TotalCharges": rng.uniform(20, 900, n)}
    cells |= {f: rng.choice(["Yes", "No"], n) for f in Q.CATEGORICAL_FEATURES}
    cells |= {f: rng.random(n) < 0.5 for f in Q.BOOLEAN_FEATURES}
    cells |= {f: rng.integers(0, 7, n).astype(float) for f in FEATURES if f not in cells}
    cells["Churn"] = ((cells["MonthlyCharges"] > 60) & (cells["tenure"] < 30)).astype(int)
    people = spark.createDataFrame([tuple(v[i].item() for v in cells.values()) for i in range(n)], list(cells)).cache()
    fitted = fit(build_model(PARAMS), people)
    monkeypatch.setattr(Q, "_ts", lambda *_: people)
    monkeypatch.setattr(Q, "_fitted", lambda _: fitted)
    out = Q.q_explanation_clusters(spark, "").collect()
    assert len(out) == 4 and sum(r["n_rows"] for r in out) == n
    assert sum(r["n_rows"] * r["avg_tenure"] for r in out) == pytest.approx(cells["tenure"].sum())
