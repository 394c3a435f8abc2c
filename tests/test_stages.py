"""Model versions and stages: numbering, archiving, refusals, and nothing rewritten."""

import pytest
from pyspark.sql import functions as F

from attrix.session import scratch_path
from attrix.sources import stages as ST


@pytest.fixture
def path(spark):
    return scratch_path(spark, "stages")


def register(spark, path, *rows):
    ST.register_versions(spark, path, spark.createDataFrame(list(rows), "model string, artifact string"))


def move(spark, path, model, version, stage, **kw):
    ST.transition(spark, path, spark.createDataFrame([(model, version)], "model string, version int"), stage, **kw)


def now(spark, path):
    return {(r["model"], r["version"]): r["stage"] for r in ST.current(spark, path).collect()}


def test_versions_stages_and_archiving(spark, path):
    assert ST.current(spark, path).count() == 0 and ST.latest_versions(spark, path).count() == 0
    register(spark, path, ("churn", "a"), ("churn", "b"), ("other", "x"))
    assert now(spark, path) == {("churn", 1): "None", ("churn", 2): "None", ("other", 1): "None"}
    move(spark, path, "churn", 1, ST.PRODUCTION)
    register(spark, path, ("churn", "c"))
    move(spark, path, "churn", 3, ST.STAGING)
    move(spark, path, "churn", 3, ST.PRODUCTION)
    assert now(spark, path) == {("churn", 1): "Archived", ("churn", 2): "None", ("churn", 3): "Production", ("other", 1): "None"}
    latest = {(r["model"], r["stage"]): (r["version"], r["artifact"]) for r in ST.latest_versions(spark, path).collect()}
    assert latest == {("churn", "Archived"): (1, "a"), ("churn", "None"): (2, "b"), ("churn", "Production"): (3, "c"), ("other", "None"): (1, "x")}
    move(spark, path, "churn", 2, ST.PRODUCTION, archive_existing=False)
    assert now(spark, path)[("churn", 3)] == "Production"
    assert [r["version"] for r in ST.latest_versions(spark, path, [ST.PRODUCTION]).collect()] == [3]
    # moving a version to the stage it has leaves it there
    move(spark, path, "other", 1, ST.STAGING)
    move(spark, path, "other", 1, ST.STAGING)
    assert now(spark, path)[("other", 1)] == "Staging"


def test_refusals_write_nothing(spark, path):
    register(spark, path, ("churn", "a"), ("churn", "b"))
    before = ST.events(spark, path).count()
    with pytest.raises(ST.StageError):
        move(spark, path, "churn", 9, ST.STAGING)
    with pytest.raises(ST.StageError):
        move(spark, path, "churn", 1, "Live")
    both = spark.createDataFrame([("churn", 1), ("churn", 2)], "model string, version int")
    with pytest.raises(ST.StageError):
        ST.transition(spark, path, both, ST.STAGING)
    assert ST.events(spark, path).count() == before


def test_history_stays(spark, path):
    register(spark, path, ("churn", "a"))
    for stage in (ST.STAGING, ST.PRODUCTION, ST.ARCHIVED):
        move(spark, path, "churn", 1, stage)
    told = [r["stage"] for r in ST.events(spark, path).orderBy("number").collect()]
    assert told == ["None", "Staging", "Production", "Archived"]
    assert ST.events(spark, path).select(F.count_distinct("event")).first()[0] == 4
