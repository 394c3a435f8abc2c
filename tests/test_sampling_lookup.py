"""Split, sample and lookup properties, checked against brute force."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from attrix.functions.hashing import seeded_hash32
from attrix.operators import sampling
from attrix.operators.lookup import FeatureLookup, create_training_set
from attrix.plans.frames import frames
from tests.conftest import SF_CHECK, SF_SMALL


@pytest.fixture(scope="module")
def ts(spark):
    return frames(spark, SF_CHECK).training_set().cache()


def brute_split(df, key, label, frac, seed):
    h = seeded_hash32(key, seed)
    w = Window.partitionBy(label).orderBy(h, F.col(key))
    n = F.count(F.lit(1)).over(Window.partitionBy(label))
    return df.withColumn("split", F.when(F.row_number().over(w) <= F.floor(n * frac), "train")
                         .otherwise("validation"))


@pytest.mark.parametrize("frac,seed", [(0.9, 810302555), (0.25, 42), (0.5, 7)])
def test_stratified_split_equals_brute_force(ts, frac, seed):
    a = sampling.stratified_split(ts, "customerID", "Churn", frac, seed).select("customerID", "split")
    b = brute_split(ts, "customerID", "Churn", frac, seed).select("customerID", "split")
    assert a.count() == ts.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_split_without_broadcast_is_the_same(spark, ts):
    a = sampling.stratified_split(ts, "customerID", "Churn", 0.9, 3).select("customerID", "split").collect()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        b = sampling.stratified_split(ts, "customerID", "Churn", 0.9, 3).select("customerID", "split").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    assert sorted(a) == sorted(b)


def test_split_sizes_and_disjoint(ts):
    tr, va = sampling.split_frames(ts, "customerID", "Churn", 0.9, 1)
    assert tr.join(va, "customerID").count() == 0
    for lbl in (0, 1):
        n = ts.filter(F.col("Churn") == lbl).count()
        assert tr.filter(F.col("Churn") == lbl).count() == int(n * 0.9)


def test_hash_sample_ignores_partitioning(ts):
    a = sampling.hash_sample(ts, "customerID", 0.05, 42).select("customerID")
    b = sampling.hash_sample(ts.repartition(7), "customerID", 0.05, 42).select("customerID")
    assert sorted(r[0] for r in a.collect()) == sorted(r[0] for r in b.collect())
    assert 0 < a.count() < ts.count() * 0.1


def test_lookup_keeps_base_rows_and_fills_unmatched(spark):
    f = frames(spark, SF_SMALL)
    base = f.demographic
    feats = f.service_features.filter(F.col("tenure") > 0)   # only active users
    out = create_training_set(base, FeatureLookup(lookup_key="customerID", df=feats),
                              exclude_columns="customerID").load_df()
    assert out.count() == base.count()
    assert "customerID" not in out.columns
    assert out.filter(F.col("tenure").isNull()).count() == base.count() - feats.count()


def test_overlapping_feature_names_refused(spark):
    f = frames(spark, SF_SMALL)
    ts = create_training_set(f.demographic,
                             [FeatureLookup(lookup_key="customerID", df=f.service_features),
                              FeatureLookup(lookup_key="customerID", df=f.service_features)])
    with pytest.raises(ValueError):
        ts.load_df()


def test_lookup_plan_has_no_cross_join(spark):
    f = frames(spark, SF_SMALL)
    plan = f.training_set()._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_exact_quantiles_small_accuracy(spark):
    """With a coarse sketch the band is wide; the answer must stay exact."""
    import numpy as np

    from attrix.operators.profile import exact_quantiles

    rng = np.random.default_rng(1)
    vals = rng.integers(0, 50, 3000).astype(float).tolist() + [None] * 7
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = exact_quantiles(df, ["x"], [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0], accuracy=100)
    xs = sorted(v for v in vals if v is not None)
    for p in [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]:
        r = max(1, int(np.ceil(p * len(xs))))
        assert got[("x", p)] == xs[r - 1]


def test_salted_lookup_equals_plain_join_with_hot_key(spark):
    from attrix.operators.lookup import lookup_features, lookup_features_salted

    # key 0 holds a third of the base rows
    base = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97).alias("k"),
        F.col("id").alias("row"))
    feats = spark.range(0, 90).select(F.col("id").alias("k"), (F.col("id") * 10).alias("f"))
    plain = lookup_features(base, feats, "k")
    salted = lookup_features_salted(base, feats, "k", hot_share=0.05, salts=8)
    assert salted.count() == base.count()
    assert plain.exceptAll(salted.select(*plain.columns)).count() == 0
    assert salted.filter("k = 0 AND f = 0").count() == base.filter("k = 0").count() >= 1000
    plan = salted._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan   # hot feature rows are repeated per salt
