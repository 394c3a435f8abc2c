"""Model behaviour on a fixture with a planted rule, artifacts, Shapley
additivity, tuning helpers."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from attrix.operators import explain as X
from attrix.operators.model import build_model, evaluate, fit, score
from attrix.operators.preprocess import BOOLEAN_FEATURES, CATEGORICAL_FEATURES, NUMERIC_FEATURES
from attrix.operators.tuning import (
    SEARCH_SPACE,
    best_trial,
    draw_params,
    promotion_gate,
    trials_from_rows,
)
from attrix.session import scratch_path
from attrix.sources import artifacts

FEATS = BOOLEAN_FEATURES + NUMERIC_FEATURES + CATEGORICAL_FEATURES
PARAMS = {"max_depth": 3, "learning_rate": 0.3, "min_child_weight": 1, "n_estimators": 10}


@pytest.fixture(scope="module")
def planted(spark):
    """2,000 rows; churn when contract is monthly and tenure is short."""
    rng = np.random.default_rng(0)
    n = 2000
    pdf = pd.DataFrame({
        "customerID": np.arange(n).astype("int64"),
        "tenure": rng.integers(0, 60, n).astype("int32"),
        "Contract": rng.choice([1, 12, 24], n).astype("int32"),
        "MonthlyCharges": rng.uniform(20, 120, n),
        "NumOptionalServices": rng.integers(0, 7, n).astype("int32"),
        "SeniorCitizen": rng.random(n) < 0.2,
        "gender": rng.choice(["Male", "Female"], n),
    })
    pdf["TotalCharges"] = pdf.MonthlyCharges * pdf.tenure
    pdf["AvgPriceIncrease"] = 0.0
    for c in ["Dependents", "PaperlessBilling", "Partner", "PhoneService"]:
        pdf[c] = rng.random(n) < 0.5
    for c in CATEGORICAL_FEATURES:
        if c not in pdf:
            pdf[c] = rng.choice(["Yes", "No"], n)
    pdf["Churn"] = ((pdf.Contract == 1) & (pdf.tenure < 12)).astype("int32")
    return spark.createDataFrame(pdf).cache()


@pytest.fixture(scope="module")
def model(planted):
    return fit(build_model(PARAMS), planted)


def test_learns_planted_rule(model, planted):
    m = evaluate(score(model, planted, keep=["Churn"])).first()
    rate = planted.agg(F.avg("Churn")).first()[0]
    base = -(rate * np.log(rate) + (1 - rate) * np.log(1 - rate))
    assert m["log_loss"] < base * 0.5
    assert m["accuracy"] > 0.95


def test_unseen_category_scores(model, planted):
    odd = planted.limit(5).withColumn("PaymentMethod", F.lit("Carrier pigeon")) \
        .withColumn("gender", F.lit(None).cast("string"))
    out = score(model, odd, keep=["customerID"]).collect()
    assert len(out) == 5 and all(0.0 <= r.p_churn <= 1.0 for r in out)


def test_save_load_same_scores(spark, model, planted):
    from pyspark.ml import PipelineModel

    path = scratch_path(spark, "m")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    a = score(model, planted, keep=["customerID"]).withColumnRenamed("p_churn", "a")
    b = score(loaded, planted, keep=["customerID"]).withColumnRenamed("p_churn", "b")
    assert a.join(b, "customerID").filter(F.col("a") != F.col("b")).count() == 0


def test_artifact_signature_and_example(spark, model, planted):
    from attrix.operators.lookup import FeatureLookup, create_training_set

    base = planted.select("customerID", "Churn")
    feats = planted.drop("Churn")
    ts = create_training_set(base, FeatureLookup(table="feats", lookup_key="customerID", df=feats),
                             label="Churn", exclude_columns="customerID")
    path = scratch_path(spark, "artifact")
    artifacts.log_model(model, path, ts, planted, "customerID", {"training_accuracy_score": 0.9})
    meta = artifacts.load_meta(spark, path)
    assert meta["metrics"]["training_accuracy_score"] == 0.9
    ex = spark.read.parquet(f"{path}/example")
    assert ex.count() == 100 and "Churn" not in ex.columns
    assert [r.customerID for r in ex.orderBy("customerID").collect()] == list(range(100))
    scored = artifacts.score_batch(spark, path, base.drop("Churn"), {"feats": feats})
    assert scored.count() == planted.count()
    with pytest.raises(ValueError):
        artifacts.check_signature(planted.drop("tenure"), meta["signature"])


def test_shapley_additivity(model, planted):
    ex = planted.filter(F.col("customerID") < 8)
    bg = planted.filter(F.col("customerID") >= 1000).limit(50)
    phi = X.shapley_values(model, ex, bg, "customerID", FEATS, samples=6, with_scores=True)
    rows = phi.groupBy("customerID").agg(F.sum("phi").alias("s"), F.first("base_value").alias("b"),
                                         F.first("prediction").alias("p"),
                                         F.count(F.lit(1)).alias("k")).collect()
    assert len(rows) == 8
    for r in rows:
        assert r.k == len(FEATS)
        assert abs(r.s - (r.p - r.b)) < 1e-9
    imp = X.global_importance(phi.select("customerID", "feature", "phi")).collect()
    assert {r.feature for r in imp[:3]} & {"tenure", "Contract"}


def test_group_difference_by_hand(spark):
    long = spark.createDataFrame([(1, "f", 1.0), (2, "f", 3.0), (3, "f", 10.0)],
                                 "k int, feature string, phi double")
    groups = spark.createDataFrame([(1, True), (2, True), (3, False)], "k int, g boolean")
    r = X.group_difference(long, "k", groups, "g").first()
    assert r.difference == pytest.approx(2.0 - 10.0)


def test_search_space_and_gate(spark):
    draws = draw_params(SEARCH_SPACE, 8, 42)
    assert len(draws) == 8 and draws == draw_params(SEARCH_SPACE, 8, 42)
    for d in draws:
        assert 3 <= d["max_depth"] <= 10 and d["max_depth"] == int(d["max_depth"])
        assert np.exp(-5) <= d["learning_rate"] <= np.exp(-1)
        assert 50 <= d["n_estimators"] <= 500 and d["n_estimators"] % 10 == 0
    t = trials_from_rows(spark, [(0, 3.0, 0.1, 1.0, 50.0, 0.5, 0.81), (1, 3.0, 0.1, 1.0, 50.0, 0.4, 0.79),
                                 (2, 3.0, 0.1, 1.0, 50.0, 0.4, 0.85)])
    assert best_trial(t).first().trial_id == 1
    gated = promotion_gate(t.withColumn("model", F.col("trial_id").cast("string")))
    g = {r.model: r.passed for r in gated.collect()}
    assert g == {"0": True, "1": False, "2": True}


def test_registered_queries_use_the_full_ranges(spark, monkeypatch):
    from attrix.plans import queries_model as Q

    fits, searches = [], []
    rows = spark.range(4).selectExpr("id AS customerID", "CAST(id % 2 AS INT) AS Churn")
    monkeypatch.setattr(Q, "_ts", lambda *_: rows)
    monkeypatch.setattr(Q, "build_model", lambda params: fits.append(dict(params)))
    monkeypatch.setattr(Q, "fit", lambda *_: object())
    monkeypatch.setattr(Q, "score", lambda *_, **__: rows)
    monkeypatch.setattr(Q, "random_search", lambda train, val, label, space, n, *_: searches.append((space, n)))
    Q.q_positive_probability(spark, "")
    Q.q_positive_probability(spark, "")
    assert len(fits) == 1  # the second query takes the fitted model
    assert 3 <= fits[0]["max_depth"] <= 10 and 50 <= fits[0]["n_estimators"] <= 500
    assert np.exp(-5) <= fits[0]["learning_rate"] <= np.exp(-1)
    Q.q_hyperparameter_trials(spark, "")
    assert searches == [(SEARCH_SPACE, 8)]


def test_lifecycle_search_refit_save_gate(spark, planted):
    from attrix.operators.lookup import FeatureLookup, create_training_set
    from attrix.operators.tuning import LogUniform, QUniform
    from attrix.plans.lifecycle import gate, search_and_fit

    space = {"max_depth": QUniform(2, 3, 1), "learning_rate": LogUniform(-2, -1),
             "min_child_weight": LogUniform(0, 1), "n_estimators": QUniform(3, 6, 3)}
    base = planted.select("customerID", "Churn")
    ts = create_training_set(base, FeatureLookup(table="feats", lookup_key="customerID",
                                                 df=planted.drop("Churn")),
                             label="Churn", exclude_columns="customerID")
    path = scratch_path(spark, "lifecycle")
    res = search_and_fit(planted, space, max_evals=3, parallelism=3, artifact_path=path,
                         training_set_spec=ts)
    assert res.trials.count() == 3
    assert set(res.params) == {"max_depth", "learning_rate", "min_child_weight", "n_estimators"}
    g = gate(spark, path).first()
    assert g.metric == "accuracy" and g.threshold == 0.8
    assert g.passed == (res.train_metrics["training_accuracy_score"] >= 0.8)


def test_explain_refuses_empty_background(spark, model):
    from attrix.plans.lifecycle import explain as explain_flow

    tiny = spark.createDataFrame([(1, 0), (2, 1)], "customerID long, Churn int")
    with pytest.raises(ValueError):
        explain_flow(model, tiny)
