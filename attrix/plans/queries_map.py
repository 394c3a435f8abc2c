"""Registered queries: the map of explanations and the groups on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrix.functions.rounding import decimals, decimals_sql
from attrix.operators import explain as X
from attrix.plans.catalog import register
from attrix.plans.frames import KEY, LABEL
from attrix.plans.lifecycle import FEATURES
from attrix.plans.oracle import with_features
from attrix.plans.queries_attribution import _SPLIT_SQL, SCORECARD, _scorecard_values
from attrix.plans.queries_model import _explained


@register("explanation_map")
def q_explanation_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, cluster, pc1, pc2): the explained customers on a t-SNE map of the model's attributions, with their groups."""
    phi, example = _explained(spark, sf_dir)
    assigned, _ = X.explanation_clusters(phi.select(KEY, "feature", "phi"), KEY, FEATURES,
                                         example.select(KEY, "tenure", "Contract", LABEL), projection="tsne")
    return assigned


@register("explanation_map_check", with_features(f"""
SELECT male, partner, CAST(count(*) AS BIGINT) AS n_rows, {decimals_sql('avg(CAST(tenure AS DOUBLE))', 6)} AS avg_tenure,
  true AS finite, CAST(4 AS BIGINT) AS n_clusters
FROM (SELECT customerID, tenure, gender = 'Male' AS male, Partner AS partner FROM demographic_service) d
WHERE customerID IN (SELECT customerID FROM ({_SPLIT_SQL} SELECT customerID FROM s WHERE explained) e) GROUP BY male, partner"""))
def q_explanation_map_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The map of a scorecard's attributions has exactly the explained customers, each with a finite place and one of four groups."""
    phi, example = _scorecard_values(spark, sf_dir)
    assigned, _ = X.explanation_clusters(phi.select(KEY, "feature", "phi"), KEY, list(SCORECARD), example.select(KEY, "tenure"),
                                         projection="tsne")
    n_clusters = assigned.select("cluster").distinct().count()
    finite = F.every(F.abs(F.col("pc1")) + F.abs(F.col("pc2")) < F.lit(float("inf")))
    people = example.select(KEY, "tenure", (F.col("gender") == "Male").alias("male"), F.col("Partner").alias("partner"))
    return (assigned.join(people, KEY).groupBy("male", "partner")
            .agg(F.count(F.lit(1)).alias("n_rows"), decimals(F.avg("tenure"), 6).alias("avg_tenure"), finite.alias("finite"))
            .withColumn("n_clusters", F.lit(n_clusters).cast("bigint")))
