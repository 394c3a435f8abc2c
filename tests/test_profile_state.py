"""States of table versions: merged ones stand for the whole table."""

import math

from pyspark.sql import functions as F

from attrix.operators import profile_state as S
from attrix.session import scratch_path


def _table(spark, n=20000):
    return spark.range(n).select(
        (F.col("id") % 5).cast("int").alias("part"), F.col("id"), (F.hash("id") % 1000 / 8).cast("double").alias("x"),
        F.when(F.col("id") % 4 == 0, F.concat(F.lit("s"), F.col("id") % 70)).alias("s"), (F.col("id") % 3 == 0).alias("b"),
        F.lit(None).cast("int").alias("none"))


def _by_name(df):
    return {r["column_name"]: r for r in df.collect()}


def test_merged_states_stand_for_the_table(spark):
    df = _table(spark)
    cols = ["id", "x", "s", "b", "none"]
    whole = _by_name(S.profile_of(S.profile_states(df, cols)))
    parts = S.profile_states(df, cols, by=["part"])
    assert parts.count() == 5 * len(cols)
    twice = S.merge_states(S.merge_states(parts.where("part < 2")).unionByName(S.merge_states(parts.where("part >= 2"))))
    for got in (_by_name(S.profile_of(S.merge_states(parts))), _by_name(S.profile_of(twice))):
        for c in cols:
            for f in ("n_rows", "n_nulls", "min_value", "max_value"):
                assert got[c][f] == whole[c][f], (c, f)
        for c, exact in (("id", 20000), ("s", df.select("s").distinct().count() - 1), ("b", 2), ("none", 0)):
            assert abs(got[c]["n_distinct"] - exact) <= max(1, exact * S.DISTINCT_BOUND)
        xs = sorted(r["x"] for r in df.select("x").collect())
        for p, q in zip((0.25, 0.5, 0.75), got["x"]["quantiles"]):
            below, upto = sum(v < q for v in xs), sum(v <= q for v in xs)
            assert below <= (p + S.RANK_BOUND) * len(xs) and upto >= (p - S.RANK_BOUND) * len(xs)
        assert math.isclose(got["x"]["mean_value"], sum(xs) / len(xs)) and got["none"]["quantiles"] is None
        assert got["s"]["min_value"] is None and got["none"]["mean_value"] is None


def test_a_version_written_again_counts_once(spark):
    df, root = _table(spark, 1000), scratch_path(spark, "states")
    for v in (0, 1, 1, 2):
        S.save_states(S.profile_states(df.where(F.col("part") == v), ["id"]), root, v)
    assert _by_name(S.merge_states(S.load_states(spark, root)))["id"]["n_rows"] == 600
    assert _by_name(S.merge_states(S.load_states(spark, root, [2])))["id"]["n_rows"] == 200


def test_states_of_nothing_and_of_nan(spark):
    empty = _by_name(S.profile_of(S.profile_states(_table(spark).limit(0), ["id", "s"])))
    assert all(r["n_rows"] == 0 and r["n_distinct"] == 0 and r["quantiles"] is None for r in empty.values())
    assert S.profile_states(_table(spark).limit(0), ["id"], by=["part"]).count() == 0
    odd = spark.createDataFrame([(math.nan,), (0.0,), (-0.0,), (None,)], "x double")
    r = _by_name(S.profile_of(S.profile_states(odd)))["x"]
    assert (r["n_rows"], r["n_nulls"], r["n_distinct"]) == (4, 1, 2) and math.isnan(r["max_value"]) and r["quantiles"] == [0.0] * 3
