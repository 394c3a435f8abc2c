"""Model versions and their stages, as an append-only table.

Every registration and every change of stage adds one row to a Parquet folder; nothing is
rewritten. The current stage of a version is that of its latest event. Moving a version to a
stage can archive the versions that hold it, in the same write.

Events are ordered by number, then by id; the number is one more than the largest one read, so
events written at the same time share a number and still have one order. Numbers and stages of all
versions are aggregations over the events, and nothing but a version's number reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attrix.sources.tables import table_exists

# The stages of the reference's registry.
NONE, STAGING, PRODUCTION, ARCHIVED = "None", "Staging", "Production", "Archived"
STAGES = (NONE, STAGING, PRODUCTION, ARCHIVED)

_SCHEMA = "number long, event string, model string, version int, stage string, artifact string"


class StageError(ValueError):
    pass


def events(spark: SparkSession, path: str) -> DataFrame:
    if not table_exists(spark, path):
        return spark.createDataFrame([], _SCHEMA)
    return spark.read.schema(_SCHEMA).parquet(path)


def _append(spark: SparkSession, path: str, rows: DataFrame) -> None:
    first = (events(spark, path).agg(F.max("number")).first()[0] or 0) + 1
    rows.select(F.lit(first).cast("long").alias("number"), F.expr("uuid()").alias("event"), "model", F.col("version").cast("int").alias("version"),
                "stage", "artifact").write.mode("append").parquet(path)


def register_versions(spark: SparkSession, path: str, models: DataFrame) -> None:
    """Add one version per row of ``models`` (model, artifact), the next number of its model, without a stage.

    Several rows of one model get numbers in the order of their artifacts.
    """
    have = events(spark, path).groupBy("model").agg(F.max("version").alias("last"))
    line = Window.partitionBy("model").orderBy("artifact")
    new = (models.select("model", "artifact").withColumn("k", F.row_number().over(line)).join(have, "model", "left")
           .select("model", (F.coalesce("last", F.lit(0)) + F.col("k")).alias("version"), F.lit(NONE).alias("stage"), "artifact"))
    _append(spark, path, new)


def current(spark: SparkSession, path: str) -> DataFrame:
    """(model, version, stage, artifact) of every version."""
    latest = F.max(F.struct("number", "event", "stage", "artifact")).alias("e")
    return events(spark, path).groupBy("model", "version").agg(latest).select("model", "version", "e.stage", "e.artifact")


def latest_versions(spark: SparkSession, path: str, stages: Sequence[str] = STAGES) -> DataFrame:
    """Per model and stage the highest version that holds the stage."""
    top = F.max(F.struct("version", "artifact")).alias("v")
    return (current(spark, path).where(F.col("stage").isin(*stages)).groupBy("model", "stage").agg(top)
            .select("model", "stage", "v.version", "v.artifact"))


def transition(spark: SparkSession, path: str, versions: DataFrame, stage: str, archive_existing: bool = True) -> None:
    """Move each (model, version) of ``versions`` to ``stage``; other versions of these models that hold it are archived.

    Raises, and writes nothing, if one of them is not registered or a model has several of them.
    """
    if stage not in STAGES:
        raise StageError(f"unknown stage {stage!r}")
    now = current(spark, path)
    wanted = versions.select("model", F.col("version").cast("int").alias("version"))
    if wanted.join(now, ["model", "version"], "left_anti").limit(1).count():
        raise StageError("a version is not registered")
    if wanted.groupBy("model").count().where("count > 1").limit(1).count():
        raise StageError("a model has several versions to move")
    moved = wanted.join(now, ["model", "version"]).select("model", "version", F.lit(stage).alias("stage"), "artifact")
    if archive_existing and stage in (STAGING, PRODUCTION):
        held = now.where(F.col("stage") == stage).join(wanted.withColumnRenamed("version", "to"), "model").where(F.col("version") != F.col("to"))
        moved = moved.unionByName(held.select("model", "version", F.lit(ARCHIVED).alias("stage"), "artifact"))
    _append(spark, path, moved)
