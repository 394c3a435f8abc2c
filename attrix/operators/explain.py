"""Model explanations as Spark jobs: sampled Shapley values, global
importance, group differences, clusters of explanations.

Shapley values by permutation sampling
--------------------------------------
For each explained row x and sample s = 0..S-1:
  * a background row b_s is chosen by hash (see below);
  * a feature permutation pi_s is drawn by sorting hash(key, s, j);
  * p+1 hybrid rows are made: at step k the first k features of pi_s come
    from x, the rest from b_s (``explode(sequence(0, p))``);
  * all hybrid rows are scored by the pipeline in one ``transform``;
  * step k adds feature pi_s[k-1], credited f(step k) - f(step k-1): each
    scored row gives +f to the feature it brings in and -f to the next one,
    so the credits are a grouped sum by (row, feature), map-side combined
    (no window and no sort over the hybrid rows).
phi_j(x) is the mean credit of feature j over the S samples. Per sample the
credits add up to f(x) - f(b_s), so sum_j phi_j = f(x) - mean_s f(b_s)
exactly. Cost is rows x S x (p+1) model evaluations: S is the evaluation
budget per row (the reference's ``nsamples``), not a cap on data.

Where the model is our trees on the column-wise feature pipeline, a slot of a
hybrid row's vector is that of x or of b_s. Then both are turned into vectors
and bins once, and a task walks the p + 1 steps of a sample through each tree
together (``boosting.Grown.chain_margins``): the same f at every step, without
a row, a vector and a full walk for each.

Choosing background partners without a cross join: background rows are
hashed into buckets and numbered inside each bucket (a window per bucket);
running counts over the at most ``buckets`` buckets turn that into numbers
0..N-1 over the whole background. Each (row, sample) hashes to one number, so
every background row is drawn with the same chance, and an equi-join on it
fetches exactly one row. Every row gets S partners, never all pairs.

``base_value`` is the mean over a row's own partners (the attributions add up
to the prediction minus it); ``expected_value`` is the model's mean over the
whole background.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attrix.functions.metrics import positive_probability
from attrix.operators.boosting import HistogramTreesModel, bins_of, chain_credits
from attrix.operators.preprocess import slot_features
from attrix.operators.tsne import tsne
from attrix.session import ship

BACKGROUND_BUCKETS = 1024
# Five times the reference's budget: a permutation sample spends p + 1 of them.
EVALUATIONS_PER_ROW = 500


#: model evaluations of one task
TASK_EVALUATIONS = 1 << 17


def spread(rows: DataFrame, evaluations: int, *by: str) -> DataFrame:
    """``rows`` in as many tasks as the ``evaluations`` they lead to need.

    A few bytes lead to many evaluations, so partitions by size would leave them to a task or two.
    """
    return rows.repartition(max(1, math.ceil(evaluations / TASK_EVALUATIONS)), *by)


def samples_for_budget(n_features: int, evaluations: int = EVALUATIONS_PER_ROW) -> int:
    """Permutation samples so that samples * (p + 1) ~ the evaluation budget."""
    return max(1, math.ceil(evaluations / (n_features + 1)))


def _h(*cols) -> "F.Column":
    return F.xxhash64(*cols)


def number_background(background: DataFrame, key: str, features: Sequence[str], seed: int,
                      buckets: int = BACKGROUND_BUCKETS) -> tuple[DataFrame, int]:
    """Background rows with ``__number`` 0..N-1 in a hashed order, features as ``__bg<j>``; and N.

    Rows are numbered inside hash buckets; running counts over the at most
    ``buckets`` buckets turn that into numbers over the whole background.
    """
    seed_c = F.lit(int(seed))
    bg = background.select(F.col(key).alias("__bkey"), *[F.col(f).alias(f"__bg{j}") for j, f in
                                                         enumerate(features)])
    bg = bg.withColumn("__bb", F.pmod(_h(seed_c, F.lit("bucket"), F.col("__bkey")), F.lit(buckets)))
    bg = bg.withColumn("__bi", F.row_number().over(
        Window.partitionBy("__bb").orderBy("__bkey")) - 1)
    sizes = bg.groupBy("__bb").agg(F.count(F.lit(1)).alias("__bn"))
    before = Window.orderBy("__bb").rowsBetween(Window.unboundedPreceding, -1)  # at most `buckets` rows
    starts = sizes.select("__bb", F.coalesce(F.sum("__bn").over(before), F.lit(0)).alias("__start"))
    bg = (bg.join(F.broadcast(starts), "__bb").withColumn("__number", (F.col("__start") + F.col("__bi")).cast("bigint"))
            .drop("__bb", "__bi", "__start"))
    return bg, sizes.agg(F.sum("__bn")).first()[0]


def _slot_owners(model: PipelineModel, explain: DataFrame, background: DataFrame, features: Sequence[str]) -> list[int] | None:
    """The place among ``features`` of each slot's feature, if the model's trees read column-wise features of both tables alike."""
    if not isinstance(model, PipelineModel) or not isinstance(model.stages[-1], HistogramTreesModel):
        return None
    slots, trees = slot_features(model.stages[:-1]), model.stages[-1]
    if slots is None or not set(slots) <= set(features) or model.stages[-2].getOutputCol() != trees.getFeaturesCol():
        return None
    if any(explain.schema[f].dataType != background.schema[f].dataType for f in features):
        return None
    return [list(features).index(f) for f in slots]


def binned(model: PipelineModel, rows: DataFrame, key: str, features: Sequence[str], name: str) -> DataFrame:
    """(key, bins of the row's vector as ``name``) for a model whose last stage is our trees."""
    trees = model.stages[-1]
    return (PipelineModel(stages=model.stages[:-1]).transform(rows.select(key, *[f for f in features if f != key]))
            .select(key, bins_of(trees.grown(), trees.getFeaturesCol()).alias(name)))


def shapley_values(model: PipelineModel, explain: DataFrame, background: DataFrame, key: str,
                   features: Sequence[str], samples: int | None = None, seed: int = 42,
                   buckets: int = BACKGROUND_BUCKETS, with_scores: bool = False) -> DataFrame:
    """Long table (key, feature, phi) of sampled Shapley values of the
    model's positive-class probability."""
    if background.isEmpty():
        raise ValueError("the background has no rows: use more data or a larger sample fraction")
    feats = list(features)
    p = len(feats)
    S = samples or samples_for_budget(p)
    seed_c = F.lit(int(seed))

    # features come in the order of these, equal ones as they stand
    turn = [_h(seed_c, F.lit("perm"), F.col(key), F.col("__s"), F.lit(j)) for j in range(p)]

    def partnered(rows: DataFrame, bg: DataFrame, total: int) -> DataFrame:
        """Explained rows x samples, each with a partner's number."""
        ex = rows.withColumn("__s", F.explode(F.sequence(F.lit(0), F.lit(S - 1))))
        ex = ex.withColumn("__number", F.pmod(_h(seed_c, F.lit("row"), F.col(key), F.col("__s")), total))
        return spread(ex.join(bg, "__number"), explain.count() * S * (p + 1), key, "__s")

    def expected() -> "F.Column":
        return F.lit(model.transform(background.select(*feats))
                     .agg(F.avg(positive_probability("probability")).alias("expected")).first()["expected"])

    if owner := _slot_owners(model, explain, background, feats):
        ship(explain.sparkSession)
        bg, total = number_background(binned(model, background, key, feats, "__bins"), key, ["__bins"], seed, buckets)
        ex = partnered(binned(model, explain, key, feats, "__x"), bg, total).withColumn("__turn", F.array(*turn))
        credits = ex.select(key, chain_credits(model.stages[-1].grown(), owner, p, "__x", "__bg0", "__turn").alias("__c"))
        sums = credits.groupBy(key).agg(*[(F.sum(F.col("__c")[j]) / F.lit(float(S))).alias(f"__p{j}") for j in range(p + 2)])
        each = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"__p{j}").alias("phi")) for j, f in enumerate(feats)]))
        long = sums.select(key, each.alias("__e"), F.col(f"__p{p}").alias("base_value"), F.col(f"__p{p + 1}").alias("prediction"))
        if not with_scores:
            return long.select(key, "__e.feature", "__e.phi")
        return long.select(key, "__e.feature", "__e.phi", expected().alias("expected_value"), "base_value", "prediction")

    bg, total = number_background(background, key, feats, seed, buckets)
    ex = partnered(explain.select(F.col(key), *[F.col(f).alias(f"__x{j}") for j, f in enumerate(feats)]), bg, total)
    order = F.array_sort(F.array(*[F.struct(h.alias("h"), F.lit(j).alias("j")) for j, h in enumerate(turn)]))
    ex = ex.withColumn("__perm", F.transform(order, lambda e: e["j"]))
    # each feature's place in the permutation, once and not in all p + 1 mixed rows
    ex = ex.withColumn("__pos", F.array(*[F.array_position(F.col("__perm"), F.lit(j)) - 1 for j in range(p)]))
    ex = ex.withColumn("__k", F.explode(F.sequence(F.lit(0), F.lit(p))))

    hybrid = {}
    for j, f in enumerate(feats):
        hybrid[f] = F.when(F.col("__pos")[j] < F.col("__k"), F.col(f"__x{j}")).otherwise(F.col(f"__bg{j}"))
    rows = ex.select(F.col(key), "__k", "__perm", *[v.alias(f) for f, v in hybrid.items()])
    scored = model.transform(rows).select(
        key, "__k", "__perm", positive_probability("probability").alias("__f"))
    # Step k adds feature perm[k-1]: its credit is f(k) - f(k-1). So each
    # scored row gives +f to perm[k-1] (k >= 1) and -f to perm[k] (k < p);
    # phi is then a plain grouped sum (map-side combined), with no window
    # and no sort over the hybrid rows. Steps 0 and p also feed the base
    # value and the prediction, under reserved names.
    k = F.col("__k")
    f = F.col("__f")
    names = F.array(*[F.lit(n) for n in feats])

    def name_at(pos):
        return F.element_at(names, F.element_at(F.col("__perm"), pos) + 1)

    credits = F.array(
        F.when(k >= 1, F.struct(name_at(k.cast("int")).alias("feature"), f.alias("v"))),
        F.when(k < p, F.struct(name_at((k + 1).cast("int")).alias("feature"), (-f).alias("v"))),
        F.when(k == 0, F.struct(F.lit("__base").alias("feature"), f.alias("v"))),
        F.when(k == p, F.struct(F.lit("__pred").alias("feature"), f.alias("v"))))
    sums = (scored.select(key, F.explode(F.filter(credits, lambda c: c.isNotNull())).alias("c"))
                  .groupBy(key, F.col("c.feature").alias("feature"))
                  .agg((F.sum("c.v") / F.lit(float(S))).alias("phi")))
    if not with_scores:
        return sums.filter(~F.col("feature").isin("__base", "__pred"))
    # Base value and prediction ride along via a window over the (small)
    # aggregated sums, so the scoring is not run a second time for a join.
    per_row = Window.partitionBy(key)
    return (sums.withColumns({
                "expected_value": expected(),
                "base_value": F.max(F.when(F.col("feature") == "__base", F.col("phi"))).over(per_row),
                "prediction": F.max(F.when(F.col("feature") == "__pred", F.col("phi"))).over(per_row)})
                .filter(~F.col("feature").isin("__base", "__pred")))


def global_importance(phi: DataFrame) -> DataFrame:
    """Mean absolute attribution per feature, largest first."""
    return (phi.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs_phi"),
                                       F.count(F.lit(1)).alias("n_rows"))
               .orderBy(F.col("mean_abs_phi").desc(), F.col("feature")))


def group_difference(long: DataFrame, key: str, groups: DataFrame, group_col: str,
                     value_col: str = "phi", feature_col: str = "feature") -> DataFrame:
    """Per feature: mean value in the group minus mean outside it.

    ``long`` is (key, feature, value); ``groups`` is (key, boolean group).
    Rows whose group flag is null count in neither mean.
    """
    j = long.join(groups.select(key, group_col), key)
    g = F.col(group_col)
    v = F.col(value_col)
    return j.groupBy(feature_col).agg(
        F.count(F.when(g, F.lit(1))).alias("n_in_group"),
        F.count(F.when(~g, F.lit(1))).alias("n_out_group"),
        (F.avg(F.when(g, v)) - F.avg(F.when(~g, v))).alias("difference"))


def wide_attributions(phi: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """One row per key, one column per feature (pivot on a known value list,
    so no extra job to find the distinct features)."""
    return phi.groupBy(key).pivot("feature", list(features)).agg(F.first("phi"))


def explanation_clusters(phi: DataFrame, key: str, features: Sequence[str], profile: DataFrame,
                         k: int = 4, seed: int = 42, projection: str = "pca") -> tuple[DataFrame, DataFrame]:
    """Customers grouped by their explanations: standardised attributions ->
    two dimensions -> standardised -> k-means. ``projection`` is ``pca`` or ``tsne``
    (``attrix.operators.tsne``). Returns (assignments, per-cluster profile
    means). Raises if fewer than ``k`` groups come out.

    Both steps are standardised, so neither one strong feature nor a few rows
    with large attributions set the groups' scale.
    """
    # The pivoted attributions feed PCA, k-means and the profile join; they
    # are written once to the checkpoint folder instead of re-running the
    # Shapley job for each pass.
    from attrix.session import cut_lineage

    wide = cut_lineage(wide_attributions(phi, key, features).na.fill(0.0))
    vec = VectorAssembler(inputCols=list(features), outputCol="__v").transform(wide)
    vec = StandardScaler(inputCol="__v", outputCol="__sv", withMean=True, withStd=True).fit(vec).transform(vec)
    if projection == "tsne":
        scaled = vec.select(key, *[_arr("__sv")[j].alias(f"__s{j}") for j in range(len(features))])
        places = cut_lineage(tsne(scaled, key, [f"__s{j}" for j in range(len(features))], seed=seed))
        emb = VectorAssembler(inputCols=["x", "y"], outputCol="__raw_pc").transform(places)
    elif projection == "pca":
        emb = PCA(k=2, inputCol="__sv", outputCol="__raw_pc").fit(vec).transform(vec)
    else:
        raise ValueError(f"projection {projection!r} is neither pca nor tsne")
    emb = StandardScaler(inputCol="__raw_pc", outputCol="__pc", withMean=True, withStd=True).fit(emb).transform(emb)
    km = KMeans(k=k, seed=seed, featuresCol="__pc", predictionCol="cluster", initSteps=5).fit(emb)
    sizes = km.summary.clusterSizes
    if len(sizes) < k or min(sizes) == 0:
        raise ValueError(f"{len(wide.columns) - 1} attributions give {len([n for n in sizes if n])} groups, {k} were asked for")
    assigned = km.transform(emb).select(
        key, "cluster",
        F.element_at(_arr("__pc"), 1).alias("pc1"), F.element_at(_arr("__pc"), 2).alias("pc2"))
    prof_cols = [c for c in profile.columns if c != key]
    summary = (assigned.join(profile, key, "left").groupBy("cluster")
               .agg(F.count(F.lit(1)).alias("n_rows"),
                    *[F.avg(F.col(c).cast("double")).alias(f"avg_{c}") for c in prof_cols]))
    return assigned, summary


def _arr(c: str):
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(F.col(c))
