"""The churn model: feature pipeline + gradient-boosted trees (MLlib).

``build_model(params)`` is the reference's ``build_model``: the column-wise
preprocessing of ``attrix.operators.preprocess`` followed by a boosted-tree
classifier. Training and scoring are distributed MLlib jobs; evaluation is a
pair of aggregates over the scored rows.

The trees are those of ``attrix.operators.boosting``: second-order gain, histograms,
``min_child_weight`` as a hessian sum, ``learning_rate``, ``max_depth`` and
``n_estimators`` as they are. ``gbt_from_params`` gives MLlib's trees instead
(first-order, ``min_child_weight`` rounded to ``minInstancesPerNode``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import Classifier, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrix.functions.metrics import accuracy, log_loss, positive_probability
from attrix.operators.boosting import HistogramTrees
from attrix.operators.preprocess import (
    BOOLEAN_FEATURES,
    CATEGORICAL_FEATURES,
    NUMERIC_FEATURES,
    build_feature_pipeline,
)
from attrix.session import scratch_path

# Fixed value: the reference's model seed.
MODEL_SEED = 810302555


def _int(name: str, x, least: int, most: int | None = None) -> int:
    n = int(round(float(x)))
    if n < least or (most is not None and n > most):
        raise ValueError(f"{name}={x} is out of range")
    return n


def gbt_from_params(params: Mapping[str, float], label: str = "Churn",
                    seed: int = MODEL_SEED) -> GBTClassifier:
    return GBTClassifier(
        featuresCol="features", labelCol=label,
        maxIter=_int("n_estimators", params["n_estimators"], 1),
        stepSize=float(params["learning_rate"]),
        maxDepth=_int("max_depth", params["max_depth"], 1, 30),
        minInstancesPerNode=_int("min_child_weight", params["min_child_weight"], 1),
        seed=seed)


def build_model(params: Mapping[str, float], label: str = "Churn",
                boolean: Sequence[str] = BOOLEAN_FEATURES,
                numeric: Sequence[str] = NUMERIC_FEATURES,
                categorical: Sequence[str] = CATEGORICAL_FEATURES,
                classifier=None) -> Pipeline:
    stages = build_feature_pipeline(boolean, numeric, categorical)
    clf = classifier if classifier is not None else HistogramTrees(params, label)
    return Pipeline(stages=[*stages, clf])


def baseline_classifiers(label: str = "Churn", seed: int = MODEL_SEED) -> dict:
    """The model families compared in a first baseline run."""
    return {
        "logistic_regression": LogisticRegression(featuresCol="features", labelCol=label,
                                                  maxIter=50),
        "random_forest": RandomForestClassifier(featuresCol="features", labelCol=label,
                                                numTrees=20, maxDepth=5, seed=seed),
        "gradient_boosted_trees": GBTClassifier(featuresCol="features", labelCol=label,
                                                maxIter=20, maxDepth=5, seed=seed),
    }


#: bytes of assembled vectors that one task of a tree level reads
TASK_BYTES = 16 << 20


def prepared(prep: PipelineModel, rows: DataFrame, label: str = "Churn") -> DataFrame:
    """(features, label) of ``rows``, written once and read in as many partitions as their bytes need.

    Every level of every tree is a job over these rows: a short lineage keeps its
    tasks small, and partitions by size keep it from being all scheduling. The
    vectors stay in memory (spilling to disk) until ``unpersist``.
    """
    spark = rows.sparkSession
    vectors = prep.transform(rows.withColumn(label, F.col(label).cast("double"))).select("features", label)
    path = scratch_path(spark, "vectors")
    vectors.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    back = spark.read.schema(vectors.schema).parquet(path)
    n, size = back.agg(F.count(F.lit(1)), F.max(F.size(vector_to_array("features")))).first()
    parts = max(1, -(-n * (size or 1) * 8 // TASK_BYTES))
    return back.repartition(parts).persist(StorageLevel.MEMORY_AND_DISK)


def fit(pipeline: Pipeline, train: DataFrame, label: str = "Churn") -> PipelineModel:
    """Fit the feature stages, then the classifier on ``prepared`` vectors.

    The feature stages each take a pass over the rows (modes, means,
    vocabularies, moments), so these are persisted; the classifier's many
    passes read the assembled vectors only. Without a classifier as last stage
    only the feature stages are fitted.
    """
    stages = pipeline.getStages()
    data = train.withColumn(label, F.col(label).cast("double")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if not isinstance(stages[-1], (Classifier, HistogramTrees)):
            return pipeline.fit(data)
        prep = Pipeline(stages=stages[:-1]).fit(data)
        vectors = prepared(prep, data, label)
    finally:
        data.unpersist()
    try:
        return PipelineModel(stages=[*prep.stages, stages[-1].fit(vectors)])
    finally:
        vectors.unpersist()


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """Scored rows: the kept columns + ``p_churn`` + ``prediction``."""
    out = model.transform(df)
    cols = list(keep) if keep is not None else [c for c in df.columns]
    return out.select(*cols, positive_probability("probability").alias("p_churn"),
                      F.col("prediction").cast("int").alias("prediction"))


def evaluate(scored: DataFrame, label: str = "Churn") -> DataFrame:
    """One row: n_rows, log_loss, accuracy."""
    return scored.agg(F.count(F.lit(1)).alias("n_rows"),
                      log_loss(label, "p_churn").alias("log_loss"),
                      accuracy(label, "prediction").alias("accuracy"))

