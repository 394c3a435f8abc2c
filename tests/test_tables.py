"""Catalog tables, CSV, keyed feature tables: write modes, key checks, merge."""

import uuid

import pytest

from attrix.session import scratch_path
from attrix.sources import csv as CSV
from attrix.sources import features as FT
from attrix.sources import tables as TB


def _n(p):
    return f"{p}_{uuid.uuid4().hex[:8]}"


def test_database_and_catalog(spark):
    db = _n("churndb")
    TB.create_database(spark, db, scratch_path(spark, db))
    TB.use_database(spark, db)
    try:
        cat, cur = TB.current_catalog_and_database(spark)
        assert cur == db and cat
        df = spark.range(3).withColumnRenamed("id", "customerID")
        TB.write_table(df, f"{db}.demographic", path=scratch_path(spark, "t"))
        assert "demographic" in TB.list_tables(spark, db)
        TB.drop_table(spark, f"{db}.demographic")
        assert "demographic" not in TB.list_tables(spark, db)
    finally:
        TB.use_database(spark, "default")


def test_write_errorifexists_then_overwrite(spark):
    name = _n("t")
    path = scratch_path(spark, name)
    TB.write_table(spark.range(5), name, path=path)
    with pytest.raises(Exception):
        TB.write_table(spark.range(5), name, path=path)
    TB.write_table(spark.range(7), name, mode="overwrite", path=path)
    assert spark.read.table(name).count() == 7


def test_overwrite_of_own_input_is_refused(spark):
    name = _n("t")
    TB.write_table(spark.range(5), name, path=scratch_path(spark, name))
    src = spark.read.table(name)
    with pytest.raises(ValueError):
        TB.write_table(src.filter("id > 1"), name, mode="overwrite")
    assert spark.read.table(name).count() == 5
    path = scratch_path(spark, "p")
    TB.write_table(spark.range(4), path)
    with pytest.raises(ValueError):
        TB.write_table(spark.read.parquet(path).filter("id > 1"), path, mode="overwrite")
    assert spark.read.parquet(path).count() == 4


def test_csv_keeps_microseconds(spark):
    import datetime as dt

    ts = dt.datetime(2024, 1, 1, 0, 0, 7, 179575)
    df = spark.createDataFrame([(1, ts)], "id bigint, ts timestamp_ntz")
    path = scratch_path(spark, "csv")
    CSV.write_csv(df, path)
    back = CSV.read_csv(spark, path, schema="id bigint, ts timestamp_ntz").collect()
    assert back[0]["ts"] == ts


def _features(spark, rows):
    return spark.createDataFrame(rows, "customerID string, tenure int, MonthlyCharges double")


def test_feature_table_create_merge_overwrite(spark):
    name = _n("service_features")
    old = _features(spark, [("a", 1, 10.0), ("b", 2, 20.0)])
    FT.create_feature_table(spark, name, "customerID", schema=old.schema, description="d")
    with pytest.raises(FT.FeatureTableError):
        FT.create_feature_table(spark, name, "customerID", schema=old.schema)
    FT.write_features(spark, name, old, "merge")
    # merge that changes one row and adds one
    new = _features(spark, [("b", 3, 25.0), ("c", 1, 5.0)])
    FT.write_features(spark, name, new, "merge")
    got = {r.customerID: (r.tenure, r.MonthlyCharges) for r in FT.read_features(spark, name).collect()}
    assert got == {"a": (1, 10.0), "b": (3, 25.0), "c": (1, 5.0)}
    # merge is idempotent
    FT.write_features(spark, name, new, "merge")
    assert FT.read_features(spark, name).count() == 3
    # partial columns keep the others
    partial = spark.createDataFrame([("a", 99.0)], "customerID string, MonthlyCharges double")
    FT.write_features(spark, name, partial, "merge")
    got = {r.customerID: (r.tenure, r.MonthlyCharges) for r in FT.read_features(spark, name).collect()}
    assert got["a"] == (1, 99.0)
    FT.write_features(spark, name, old, "overwrite")
    assert FT.read_features(spark, name).count() == 2
    assert FT.primary_keys(spark, name) == ["customerID"]


def test_feature_key_checks(spark):
    name = _n("sf")
    schema = _features(spark, [("a", 1, 1.0)]).schema
    FT.create_feature_table(spark, name, "customerID", schema=schema)
    with pytest.raises(FT.FeatureTableError):
        FT.write_features(spark, name, _features(spark, [("a", 1, 1.0), ("a", 2, 2.0)]))
    with pytest.raises(FT.FeatureTableError):
        FT.write_features(spark, name, _features(spark, [(None, 1, 1.0)]))
    viol = FT.key_violations(_features(spark, [("a", 1, 1.0), ("a", 2, 2.0), (None, 1, 1.0),
                                               ("b", 1, 1.0)]), "customerID")
    got = {(r.customerID, r.n_rows) for r in viol.collect()}
    assert got == {("a", 2), (None, 1)}


def test_feature_type_mismatch_refused(spark):
    name = _n("sf")
    schema = _features(spark, [("a", 1, 1.0)]).schema
    FT.create_feature_table(spark, name, "customerID", schema=schema)
    bad = spark.createDataFrame([("a", "x", 1.0)], "customerID string, tenure string, MonthlyCharges double")
    with pytest.raises(FT.FeatureTableError):
        FT.write_features(spark, name, bad)


def test_csv_inference_types_blank_total_as_string(spark):
    path = scratch_path(spark, "csv_infer")
    rows = [("a1", 0, 1, 29.85, "29.85"), ("a2", 1, 0, 20.0, " ")]
    df = spark.createDataFrame(rows, "customerID string, SeniorCitizen int, tenure int, "
                                     "MonthlyCharges double, TotalCharges string")
    (df.write.option("header", True).option("ignoreLeadingWhiteSpace", False)
       .option("ignoreTrailingWhiteSpace", False).csv(path))
    inferred = dict(CSV.read_csv(spark, path, infer=True).dtypes)
    assert inferred["SeniorCitizen"] == "int" and inferred["MonthlyCharges"] == "double"
    assert inferred["TotalCharges"] == "string"


def test_bucketed_tables_join_without_shuffle(spark):
    from attrix.plans.lifecycle import setup_tables, training_set
    from tests.conftest import SF_SMALL

    db = _n("bucketdb")
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:   # merges into the bucketed table then read it with a bucketed scan
        names = setup_tables(spark, SF_SMALL, db, buckets=8)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    assert TB.bucket_spec(spark, names.demographic) == (8, ["customerID"])
    assert TB.bucket_spec(spark, names.service_features) == (8, ["customerID"])
    # a second merge keeps the bucketing
    sf = FT.read_features(spark, names.service_features)
    FT.write_features(spark, names.service_features, sf.filter("tenure > 0"), "merge")
    assert TB.bucket_spec(spark, names.service_features) == (8, ["customerID"])
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = training_set(spark, names).load_df()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert df.count() == spark.read.table(names.demographic).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
