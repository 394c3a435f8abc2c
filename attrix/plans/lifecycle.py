"""End-to-end flows of the reference, as functions over a Spark session.

1. ``setup_tables``     raw rows -> demographic table + keyed service
                        feature table (created, then merged) + joined table
2. ``search_and_fit``   stratified split -> random search -> refit on all
                        rows with the best parameters -> saved artifact
3. ``gate``             promotion decision from the stored training metric
4. ``explain``          hashed 5 % sample -> stratified background/example
                        split -> sampled Shapley values -> importance,
                        group difference, clusters

Tables live in a catalog database; their files go under the shared scratch
folder (``spark.checkpoint.dir``) unless a location is given.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrix.operators import explain as X
from attrix.operators import sampling
from attrix.operators.lookup import FeatureLookup, create_training_set
from attrix.operators.model import build_model, evaluate, fit, score
from attrix.operators.preprocess import BOOLEAN_FEATURES, CATEGORICAL_FEATURES, NUMERIC_FEATURES
from attrix.operators.tuning import (
    ACCURACY_GATE,
    MAX_EVALS,
    PARALLELISM,
    SEARCH_SEED,
    SEARCH_SPACE,
    adaptive_search,
    best_params,
    promotion_gate,
)
from attrix.plans.frames import KEY, LABEL, frames
from attrix.session import cut_lineage, scratch_path
from attrix.sources import artifacts, features as FT, tables

FEATURES = BOOLEAN_FEATURES + NUMERIC_FEATURES + CATEGORICAL_FEATURES

# Seeds and fractions of the reference's flow.
SPLIT_SEED = 810302555
SAMPLE_SEED = 42
TRAIN_FRACTION = 0.9
EXPLAIN_SAMPLE_FRACTION = 0.05
BACKGROUND_FRACTION = 0.25


@dataclass
class Tables:
    db: str
    demographic: str
    service_features: str
    demographic_service: str


def setup_tables(spark: SparkSession, sf_dir: str, db: str, location: str | None = None,
                 buckets: int | None = None) -> Tables:
    """Write the demographic table, the keyed service-feature table and the
    joined table. With ``buckets``, the demographic and feature tables are
    bucketed alike on the key, so the lookup join reads both sides without
    a shuffle."""
    root = location or scratch_path(spark, f"db_{db}")
    tables.create_database(spark, db, root)
    names = Tables(db, f"{db}.demographic", f"{db}.service_features", f"{db}.demographic_service")
    for t in (names.demographic, names.demographic_service):
        tables.drop_table(spark, t)
    f = frames(spark, sf_dir)
    tables.write_table(f.demographic, names.demographic, mode="overwrite",
                       path=f"{root}/demographic",
                       bucket_by=(buckets, [KEY]) if buckets else None)
    if not spark.catalog.tableExists(names.service_features):
        FT.create_feature_table(spark, names.service_features, KEY,
                                schema=f.service_features.schema,
                                description="Telco customer services",
                                path=f"{root}/service_features", buckets=buckets)
    FT.write_features(spark, names.service_features, f.service_features, mode="merge")
    ts = training_set(spark, names, label=None)
    tables.write_table(ts.load_df(), names.demographic_service, mode="overwrite",
                       path=f"{root}/demographic_service")
    return names


def training_set(spark: SparkSession, names: Tables, label: str | None = LABEL):
    return create_training_set(spark.read.table(names.demographic),
                               [FeatureLookup(table=names.service_features, lookup_key=KEY)],
                               label=label, exclude_columns=KEY)


@dataclass
class FitResult:
    model: PipelineModel
    trials: DataFrame
    params: dict
    train_metrics: dict
    path: str | None


def search_and_fit(df: DataFrame, space=SEARCH_SPACE, max_evals: int = MAX_EVALS,
                   parallelism: int = PARALLELISM, seed: int = SEARCH_SEED,
                   artifact_path: str | None = None, training_set_spec=None, trials: DataFrame | None = None) -> FitResult:
    """Split, search, refit on all rows, evaluate in-sample, save. ``trials`` of a finished search are taken as they are."""
    if trials is None:
        train, val = sampling.split_frames(df, KEY, LABEL, TRAIN_FRACTION, SPLIT_SEED)
        trials = adaptive_search(train, val, LABEL, space, max_evals, parallelism, seed)
    params = best_params(trials)
    model = fit(build_model(params, label=LABEL), df, LABEL)
    metrics = training_metrics(model, df)
    if artifact_path and training_set_spec is not None:
        artifacts.log_model(model, artifact_path, training_set_spec, df, KEY, metrics)
    return FitResult(model, trials, params, metrics, artifact_path)


def gate(spark: SparkSession, artifact_path: str, threshold: float = ACCURACY_GATE) -> DataFrame:
    meta = artifacts.load_meta(spark, artifact_path)
    metrics = spark.createDataFrame(
        [(artifact_path, meta["metrics"].get("training_accuracy_score"))],
        "model string, accuracy double")
    return promotion_gate(metrics, "accuracy", threshold)


def training_metrics(model: PipelineModel, df: DataFrame, label: str = LABEL) -> dict[str, float]:
    """In-sample log loss and accuracy, under the names the gate reads."""
    m = evaluate(score(model, df, keep=[label]), label).first()
    return {"training_log_loss": float(m["log_loss"]), "training_accuracy_score": float(m["accuracy"])}


def explanation_split(df: DataFrame, fraction: float = EXPLAIN_SAMPLE_FRACTION) -> tuple[DataFrame, DataFrame]:
    """5 % hashed sample, then 25 % of it (stratified) as background.

    The split sample is checkpointed (shared checkpoint folder): it is read
    by several joins of the Shapley job, and a short lineage keeps both
    planning and recovery cheap.
    """
    sample = sampling.hash_sample(df, KEY, fraction, SAMPLE_SEED)
    split = cut_lineage(
        sampling.stratified_split(sample, KEY, LABEL, BACKGROUND_FRACTION, SAMPLE_SEED))
    background = split.filter(F.col("split") == "train").drop("split")
    example = split.filter(F.col("split") == "validation").drop("split")
    return background, example


def explanation_of_all(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The stratified 25 % of all rows as background, and every row, those too, to be explained."""
    split = cut_lineage(sampling.stratified_split(df, KEY, LABEL, BACKGROUND_FRACTION, SAMPLE_SEED))
    return split.filter(F.col("split") == "train").drop("split"), split.drop("split")


def explain(model: PipelineModel, df: DataFrame, samples: int | None = None):
    background, example = explanation_split(df)
    # The split sample is checkpointed, so these checks read a small file.
    if background.limit(1).count() == 0 or example.limit(1).count() == 0:
        raise ValueError("the explanation sample is too small to give both background and "
                         "explained rows; use more data or a larger sample fraction")
    phi = X.shapley_values(model, example, background, KEY, FEATURES, samples=samples,
                           seed=SAMPLE_SEED)
    return phi, example
