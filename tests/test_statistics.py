"""Statistics against DuckDB on values that fixed-point sums cannot hold, and
split, sample, lookup and write properties."""

import math

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from attrix.functions.rounding import decimals, significant, significant_sql
from attrix.operators import profile, sampling
from attrix.operators.lookup import lookup_features, lookup_features_salted
from attrix.operators.preprocess import feature_pipeline, standardise_columns
from attrix.sources import csv as CSV
from attrix.sources import features as FT
from attrix.sources import tables as TB
from attrix.session import scratch_path


@pytest.fixture(scope="module")
def wide(spark):
    return spark.range(1000).select(
        (F.col("id") * 1e-9).alias("tiny"), (F.col("id") * 1e10 - 5e12).alias("huge"),
        (F.lit(9_000_000_000_000_000_000) + F.col("id")).alias("big_id"),
        F.when(F.col("id") == 3, F.lit(float("nan"))).otherwise(F.col("id") * 1.0).alias("with_nan"),
        F.when(F.col("id") % 10 != 0, F.col("id") % 7).alias("tied"), F.lit(4.5).alias("same"),
        F.concat(F.lit("s"), F.col("id") % 9).alias("text"), F.lit(None).cast("double").alias("none"))


def test_summary_agrees_with_duckdb(spark, wide):
    got = {(r["column_name"], r["statistic"]): (r["value"], r["text"]) for r in profile.summary_stats(wide).collect()}
    pdf = wide.toPandas()
    con = duckdb.connect()
    con.register("pdf", pdf)
    # a pandas NaN arrives as null, so that column is put together here
    con.execute("CREATE TABLE t AS SELECT * REPLACE (CASE WHEN with_nan IS NULL THEN 'NaN'::DOUBLE ELSE with_nan END AS with_nan) FROM pdf")
    for c in ("tiny", "huge", "big_id", "with_nan", "tied", "same"):
        n, mean, dev, lo, q1, q2, q3, hi = con.execute(
            f"SELECT count({c}), avg(CAST({c} AS DOUBLE)), {'NULL' if c == 'with_nan' else f'stddev_samp(CAST({c} AS DOUBLE))'}, "
            f"min({c}), quantile_disc({c}, 0.25), quantile_disc({c}, 0.5), quantile_disc({c}, 0.75), max({c}) FROM t").fetchall()[0]
        for st, want in (("count", n), ("mean", mean), ("min", lo), ("25%", q1), ("50%", q2), ("75%", q3), ("max", hi)):
            v = got[c, st][0]
            assert (math.isnan(v) and math.isnan(want)) or math.isclose(v, want, rel_tol=1e-9), (c, st)
        if c not in ("with_nan", "big_id"):  # the ids' spread is below the resolution of a double at 9e18
            assert math.isclose(got[c, "stddev"][0], dev, rel_tol=1e-9, abs_tol=1e-30), c
    assert got["text", "count"] == (1000.0, None) and got["text", "min"] == (None, "s0") and got["text", "max"] == (None, "s8")
    assert got["none", "count"] == (0.0, None) and got["none", "50%"] == (None, None)


def test_quantiles_match_sorted_ranks(spark):
    import random
    rnd = random.Random(1)
    for values in ([rnd.random() for _ in range(5000)], [rnd.choice([0, 0, 0, 1, 2]) * 1.0 for _ in range(5000)], [7.0],
                   [rnd.randint(0, 400) * 1.0 for _ in range(5000)]):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        for accuracy in (50, 10_000):
            got = profile.exact_quantiles(df, ["v"], accuracy=accuracy)
            for p in profile.QUARTILES:
                assert got["v", p] == sorted(values)[math.ceil(p * len(values)) - 1]


def test_no_window_sees_ungrouped_rows(spark):
    import inspect
    src = inspect.getsource(profile.exact_quantiles)
    assert "row_number" not in src and src.index("groupBy") < src.index(".over(run)")


def test_standardise_small_scale(spark, wide):
    out = standardise_columns(wide.select("tiny", "huge", "same"), ["tiny", "huge", "same"])
    r = out.agg(F.avg("tiny"), F.stddev_pop("tiny"), F.stddev_pop("huge"), F.max("same")).first()
    assert abs(r[0]) < 1e-9 and abs(r[1] - 1) < 1e-9 and abs(r[2] - 1) < 1e-9 and r[3] == 0.0


def test_rounding_same_in_both_engines(spark):
    values = [0.0, 1.0, 12.5, 1234567.895, 1e-9 / 3, -2e13 / 7, 999.9999999999, 0.1 + 0.2, 5e-324, 1e300]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(significant("v")).collect()]
    want = [r[0] for r in duckdb.sql("SELECT " + significant_sql("v") + " FROM (VALUES " + ", ".join(
        f"({v!r}::DOUBLE)" for v in values[:-2]) + ") t(v)").fetchall()]
    assert got[:-2] == want
    assert df.select(decimals("v", 3)).first()[0] == 0.0
    assert spark.range(1).select(significant(F.lit(None).cast("double"))).first()[0] is None


def test_split_keeps_null_labels_and_keys(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 10 != 0, F.col("id")).alias("k"),
                                  F.when(F.col("id") % 9 != 0, F.col("id") % 2).alias("y"), F.col("id"))
    pinned = len(spark.sparkContext._jsc.getPersistentRDDs())
    out = sampling.stratified_split(df, "k", "y", 0.9, 7)
    assert out.columns == [*df.columns, "split"] and out.count() == 1000
    for r in out.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("split") == "train", 1)).alias("t")).collect():
        assert r["t"] == math.floor(r["n"] * 0.9)
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == pinned


def test_small_fractions_are_kept(spark):
    df = spark.range(1_000_000)
    n = sampling.hash_sample(df, "id", 1e-5, 3).count()
    assert 2 <= n <= 25
    assert sampling.hash_sample(df.limit(10), "id", 1.0, 3).count() == 10
    with pytest.raises(ValueError):
        sampling.hash_sample(df, "id", 1.5, 3)


def test_salted_lookup_spreads_null_keys(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        base = spark.range(20000).select(F.when(F.col("id") % 2 == 0, F.col("id") % 50).alias("k"), "id")
        feats = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("f"))
        out = lookup_features_salted(base, feats, "k", hot_share=0.5)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert max(sizes) < 5 * sum(sizes) / 16
        plain = lookup_features(base, feats, "k").select(*out.columns)
        assert out.exceptAll(plain).count() == 0 and out.count() == 20000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_csv_keeps_blanks_and_checks_header(spark):
    path = scratch_path(spark, "csv")
    CSV.write_csv(spark.createDataFrame([(" ", " a "), ("x", "y")], "a string, b string").coalesce(1), path)
    assert [tuple(r) for r in CSV.read_csv(spark, path, schema="a string, b string").collect()] == [(" ", " a "), ("x", "y")]
    with pytest.raises(Exception):
        CSV.read_csv(spark, path, schema="b string, a string").collect()


def test_feature_write_after_half_finished_write(spark):
    name = "half_" + scratch_path(spark, "x").rsplit("-", 1)[1]
    df = spark.createDataFrame([(1, "a")], "k long, v string")
    FT.create_feature_table(spark, name, "k", df=df, description="it's keyed", buckets=2)
    before = FT.read_features(spark, name).collect()
    root = FT._props(spark, name)[FT.PROP_ROOT]
    df.write.parquet(f"{root}/v00002")  # files of a write whose swap was lost
    with pytest.raises(FT.FeatureTableError):
        FT.write_features(spark, name, spark.createDataFrame([(2, "x"), (2, "y")], "k long, v string"))
    assert FT.read_features(spark, name).collect() == before
    FT.write_features(spark, name, spark.createDataFrame([(1, "b"), (2, "c")], "k long, v string"))
    assert sorted(map(tuple, FT.read_features(spark, name).collect())) == [(1, "b"), (2, "c")]
    FT.write_features(spark, name, spark.createDataFrame([(3, "d")], "k long, v string"), mode="overwrite")
    assert [tuple(r) for r in FT.read_features(spark, name).collect()] == [(3, "d")]


def test_self_overwrite_is_refused(spark):
    path = scratch_path(spark, "self")
    spark.range(5).write.parquet(path)
    with pytest.raises(ValueError):
        TB.write_table(spark.read.parquet(path).where("id > 1"), path, mode="overwrite")
    assert spark.read.parquet(path).count() == 5


def test_pipeline_takes_empty_category_and_scales_by_population(spark):
    df = spark.createDataFrame([(True, float(i), "" if i == 2 else None if i == 3 else "ab"[i % 2]) for i in range(8)],
                               "b boolean, n double, c string")
    model = feature_pipeline(boolean=["b"], numeric=["n"], categorical=["c"]).fit(df)
    rows = [r["features"].toArray() for r in model.transform(df).select("features").collect()]
    assert len(rows[0]) == 2 + 1 + 3
    pdf = pd.DataFrame(rows)
    assert all(abs(v - 1) < 1e-9 or v == 0 for v in pdf.var(ddof=0)) and (pdf.var(ddof=0) > 0).sum() == 4
    path = scratch_path(spark, "scaler")
    model.write().save(path)
    from pyspark.ml import PipelineModel
    again = [r["features"].toArray().tolist() for r in PipelineModel.load(path).transform(df).select("features").collect()]
    assert again == [r.tolist() for r in rows]


def test_old_versions_expire(spark):
    name = "expire_" + scratch_path(spark, "x").rsplit("-", 1)[1]
    FT.create_feature_table(spark, name, "k", df=spark.createDataFrame([(1, "a")], "k long, v string"))
    for v in "bcd":
        FT.write_features(spark, name, spark.createDataFrame([(1, v)], "k long, v string"))
    assert FT.expire_versions(spark, name) > 0
    spark.catalog.refreshTable(name)
    assert [tuple(r) for r in FT.read_features(spark, name).collect()] == [(1, "d")]
    assert FT.expire_versions(spark, name) == 0
