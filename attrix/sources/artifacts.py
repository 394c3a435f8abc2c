"""Model artifacts: a fitted pipeline saved with the feature lookups it needs.

Layout under the artifact path:
  model/      ``PipelineModel.write().save``
  meta/       one-row JSON: lookups (table, key, features), label, excluded
              columns, input signature (schema JSON), training metrics
  example/    Parquet: the first 100 training rows by key (input example)

Scoring by key (``score_batch``) reads ``meta``, joins the features in with
the same lookups as at training time, checks the columns against the saved
signature, and transforms. The caller passes only keys (plus any base
columns the lookups do not provide).
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrix.operators.lookup import FeatureLookup, TrainingSet, create_training_set
from attrix.operators.model import score

EXAMPLE_ROWS = 100


def input_example(df: DataFrame, key: str | Sequence[str], n: int = EXAMPLE_ROWS) -> DataFrame:
    """First ``n`` rows by key: a distributed top-n (sort + limit)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.orderBy(*keys).limit(n)


def signature(df: DataFrame, exclude: Sequence[str] = ()) -> str:
    skip = set(exclude)
    return T.StructType([f for f in df.schema.fields if f.name not in skip]).json()


def check_signature(df: DataFrame, sig_json: str) -> None:
    expected = T.StructType.fromJson(json.loads(sig_json))
    have = dict(df.dtypes)
    problems = []
    for f in expected.fields:
        if f.name not in have:
            problems.append(f"missing {f.name}")
        elif have[f.name] != f.dataType.simpleString():
            problems.append(f"{f.name} is {have[f.name]}, model expects {f.dataType.simpleString()}")
    if problems:
        raise ValueError("input does not match the model signature: " + "; ".join(problems))


def model_meta(training_set: TrainingSet, training_df: DataFrame, key: str | Sequence[str],
               metrics: Mapping[str, float] | None = None) -> dict:
    keys = [key] if isinstance(key, str) else list(key)
    label = training_set.label
    return {
        "training_set": training_set.spec(),
        "key": keys,
        "label": label,
        "signature": signature(training_df, [*keys, *([label] if label else [])]),
        "metrics": dict(metrics or {}),
    }


def log_model(model: PipelineModel, path: str, training_set: TrainingSet, training_df: DataFrame,
              key: str | Sequence[str], metrics: Mapping[str, float] | None = None) -> str:
    """Save model + lookup metadata + signature + input example under ``path``."""
    spark = training_df.sparkSession
    keys = [key] if isinstance(key, str) else list(key)
    label = training_set.label
    model.write().overwrite().save(f"{path}/model")
    meta = model_meta(training_set, training_df, keys, metrics)
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1) \
        .write.mode("overwrite").json(f"{path}/meta")
    ex = training_df.drop(label) if label else training_df
    input_example(ex, keys).write.mode("overwrite").parquet(f"{path}/example")
    return path


def load_meta(spark: SparkSession, path: str) -> dict:
    row = spark.read.json(f"{path}/meta").first()
    return json.loads(row["meta"])


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    return PipelineModel.load(f"{path}/model"), load_meta(spark, path)


def lookup_for_scoring(meta: Mapping, base: DataFrame,
                       feature_tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The join half of scoring: the saved lookups applied to ``base`` (keys
    kept), checked against the saved signature."""
    lookups = []
    for lk in meta["training_set"]["lookups"]:
        df = (feature_tables or {}).get(lk["table"])
        lookups.append(FeatureLookup(table=lk["table"], lookup_key=lk["lookup_key"],
                                     feature_names=lk["feature_names"], df=df))
    ts = create_training_set(base, lookups, label=None,
                             exclude_columns=meta["training_set"]["exclude_columns"])
    rows = ts.load_df(keep_keys=True)
    check_signature(rows, meta["signature"])
    return rows


def score_batch(spark: SparkSession, path: str, base: DataFrame,
                feature_tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Score rows given by key: the saved lookups are joined in first.

    ``feature_tables`` maps a lookup's table name to a DataFrame, for lookups
    whose table is not in the catalog (tests, derived frames).
    """
    model, meta = load_model(spark, path)
    rows = lookup_for_scoring(meta, base, feature_tables)
    return score(model, rows, keep=[c for c in meta["key"]] + [
        c for c in base.columns if c not in meta["key"]]).withColumn(
            "model_path", F.lit(path))
