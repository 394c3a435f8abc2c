"""Shapley values by coalition-weighted least squares.

For an explained row ``x`` and a set ``S`` of features, ``v(S)`` is the model's mean
over rows that take the features of ``S`` from ``x`` and the others from background rows. The
attributions are the additive function of the set that fits ``v`` best under
the Shapley kernel's weights and adds up to ``v(all) - v(none)`` exactly.

The sets are the same for all rows, so the normal equations have one matrix; its
inverse is small arithmetic on the driver (features x sets), and a row's attributions are
fixed linear combinations of its ``v(S)``: one grouped sum per explained row, combined map-side.
All sets are used when they fit the budget, and the result is exact then; else the smallest and largest
ones come first, and seeded draws in complementary pairs share the weight of the rest.

Each explained row meets all background rows, or ``partners`` of them if that is given, by an equi-join
on numbers, the same ones for every set. Cost is rows x partners x (sets + 2) model evaluations.

Where the model is our trees on the column-wise feature pipeline, a set sees only the bins of its features in ``x``, and
those of the others in a background row. So per set the different parts of explained rows meet the different parts of
all background rows, with their counts, block by block: a tree's leaves are met by the rows that may come to
them, and a product over the leaves gives the margins of a block (``boosting.Grown.crossed_margins``). The values
are those of all mixed rows. Where all parts are different the cost is still rows x background rows x sets.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrix.functions.metrics import positive_probability
from attrix.operators import explain as X
from attrix.operators.boosting import crossed_sums, parts_of
from attrix.operators.explain import number_background, spread
from attrix.session import cut_lineage, ship

#: the reference's budget of evaluations per row: one per set
SETS = 100
#: different parts of a set's rows that meet in one product
SIDE = 1 << 10


def kernel_weight(p: int, size: int) -> float:
    """Weight of one set of ``size`` of ``p`` features."""
    return (p - 1) / (math.comb(p, size) * size * (p - size))


def coalitions(p: int, budget: int = SETS, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """(sets as rows of 0 and 1, weights): all proper sets if they fit, else whole sizes and draws."""
    if p < 2:
        return np.empty((0, p)), np.empty(0)
    rows: list[tuple[int, ...]] = []
    weights: list[float] = []
    sizes = list(range(1, p // 2 + 1))
    while sizes:
        s = sizes[0]
        both = {s, p - s}
        if len(rows) + math.comb(p, s) * len(both) > budget:
            break
        for size in sorted(both):
            for chosen in itertools.combinations(range(p), size):
                rows.append(tuple(int(j in chosen) for j in range(p)))
                weights.append(kernel_weight(p, size))
        sizes.pop(0)
    left = budget - len(rows)
    if sizes and left > 1:
        share = np.array([kernel_weight(p, s) * math.comb(p, s) * (1 if 2 * s == p else 2) for s in sizes])
        rng = np.random.default_rng(seed)
        drawn: dict[tuple[int, ...], int] = {}
        for _ in range(left // 2):
            size = int(rng.choice(sizes, p=share / share.sum()))
            chosen = set(rng.choice(p, size, replace=False).tolist())
            mask = tuple(int(j in chosen) for j in range(p))
            for m in (mask, tuple(1 - z for z in mask)):
                drawn[m] = drawn.get(m, 0) + 1
        total = sum(drawn.values())
        for m in sorted(drawn):
            rows.append(m)
            weights.append(share.sum() * drawn[m] / total)
    return np.array(rows, dtype=float), np.array(weights)


def coefficients(sets: np.ndarray, weights: np.ndarray, p: int) -> np.ndarray:
    """features x (sets, all, none): an attribution is this row times the values of the sets."""
    if p == 1:
        return np.array([[1.0, -1.0]])
    normal = sets.T @ (weights[:, None] * sets)
    if np.linalg.matrix_rank(normal) < p:
        raise ValueError(f"{len(sets)} sets do not determine {p} attributions: a budget of {2 * p} does")
    inverse = np.linalg.inv(normal)
    ones = inverse.sum(1) / inverse.sum()           # the multiplier of the constraint
    fit = inverse @ (sets.T * weights)
    fit = fit - np.outer(ones, fit.sum(0))
    return np.column_stack([fit, ones, -fit.sum(1) - ones])


Predict = Callable[[DataFrame], DataFrame]


def kernel_values(predict: Predict | PipelineModel, explain: DataFrame, background: DataFrame, key: str, features: Sequence[str],
                  budget: int = SETS, partners: int | None = None, seed: int = 42) -> DataFrame:
    """(key, feature, phi, base_value, prediction) per explained row and feature.

    ``predict`` adds the column ``__f`` to rows with the feature columns, or is a model with a positive probability. ``base_value``
    is the mean over the row's partners, all background rows unless a number is given; attributions add up to ``prediction - base_value``.
    """
    if background.isEmpty():
        raise ValueError("the background has no rows: use more data or a larger sample fraction")
    feats, p = list(features), len(features)
    sets, weights = coalitions(p, budget, seed)
    table = coefficients(sets, weights, p)
    masks = np.vstack([sets, np.ones((1, p)), np.zeros((1, p))]) if len(sets) else np.array([[1.0] * p, [0.0] * p])
    n_sets = len(masks)

    if partners is None and (owner := X._slot_owners(predict, explain, background, feats)):
        scored, k = _part_values(predict, owner, masks, explain, background, key, feats)
    else:
        scored, k = _row_values(predict, masks, explain, background, key, feats, partners, seed)
    share = F.col("__f") / F.lit(float(k))

    def weighted(values) -> Column:
        return F.sum(F.element_at(F.array(*[F.lit(float(v)) for v in values]), F.col("__set")) * share)

    sums = scored.groupBy(key).agg(*[weighted(table[j]).alias(f"__p{j}") for j in range(p)],
                                   F.sum(F.when(F.col("__set") == n_sets, share)).alias("base_value"),
                                   F.sum(F.when(F.col("__set") == n_sets - 1, share)).alias("prediction"))
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"__p{j}").alias("phi")) for j, f in enumerate(feats)]))
    return sums.select(key, each.alias("e"), "base_value", "prediction").select(key, "e.feature", "e.phi", "base_value", "prediction")


def _row_values(predict: Predict | PipelineModel, masks: np.ndarray, explain: DataFrame, background: DataFrame, key: str,
                feats: Sequence[str], partners: int | None, seed: int) -> tuple[DataFrame, int]:
    """(key, __set, __f) per explained row, partner and set; the partners of a row."""
    model, n_sets = predict, len(masks)
    if isinstance(model, PipelineModel):
        predict = lambda rows: model.transform(rows).withColumn("__f", positive_probability("probability"))
    numbered, total = number_background(background, key, feats, seed)
    k = total if partners is None else min(partners, total)
    rows = explain.select(F.col(key), *[F.col(f).alias(f"__x{j}") for j, f in enumerate(feats)])
    # consecutive numbers from a hashed start: k different background rows
    rows = rows.withColumn("__number", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(k - 1).cast("bigint"))))
    rows = rows.withColumn("__number", F.pmod(F.xxhash64(F.lit(seed), F.lit("row"), F.col(key)) + F.col("__number"), F.lit(total)))
    rows = (spread(rows.join(numbered, "__number"), explain.count() * k * n_sets, key, "__number")
            .withColumn("__set", F.explode(F.sequence(F.lit(1), F.lit(n_sets)))))

    def mixed(j: int) -> Column:
        inside = F.lit("".join("01"[int(z)] for z in masks[:, j]))
        return F.when(F.substring(inside, F.col("__set"), F.lit(1)) == "1", F.col(f"__x{j}")).otherwise(F.col(f"__bg{j}"))

    return predict(rows.select(key, "__set", *[mixed(j).alias(f) for j, f in enumerate(feats)])).select(key, "__set", "__f"), k


def _part_values(model: PipelineModel, owner: Sequence[int], masks: np.ndarray, explain: DataFrame, background: DataFrame,
                 key: str, feats: Sequence[str]) -> tuple[DataFrame, int]:
    """(key, __set, __f) per explained row and set, ``__f`` the sum over all background rows; the number of these."""
    ship(explain.sparkSession)
    grown, slots = model.stages[-1].grown(), masks[:, list(owner)]

    def parts(rows: DataFrame, own: np.ndarray, name: str) -> DataFrame:
        each = cut_lineage(X.binned(model, rows, key, feats, "__bins"))
        return each.select(key, F.posexplode(parts_of("__bins", own)).alias("__set", name)).withColumn("__set", F.col("__set") + 1)

    rows = parts(explain, slots, "__x")
    mine = cut_lineage(rows.select("__set", "__x").distinct())
    theirs = cut_lineage(parts(background, 1 - slots, "__b").groupBy("__set", "__b").agg(F.count(F.lit(1)).alias("__n")))
    counts = {r["__set"]: r for r in mine.groupBy("__set").agg(F.count(F.lit(1)).alias("x"))
              .join(theirs.groupBy("__set").agg(F.count(F.lit(1)).alias("b"), F.sum("__n").alias("total")), "__set").collect()}
    if not counts:  # nothing to explain
        return rows.select(key, "__set", F.lit(0.0).alias("__f")), 1

    def blocks(side: str) -> tuple[Column, list[int]]:
        each = [math.ceil(counts[s + 1][side] / SIDE) for s in range(len(masks))]
        return F.element_at(F.array(*[F.lit(n) for n in each]), F.col("__set")), each

    (of_x, n_x), (of_b, n_b) = blocks("x"), blocks("b")
    xs = (mine.groupBy("__set", F.pmod(F.xxhash64("__x"), of_x).alias("__xblock")).agg(F.collect_list("__x").alias("__xs"))
          .withColumn("__bblock", F.explode(F.sequence(F.lit(0).cast("bigint"), (of_b - 1).cast("bigint")))))
    bs = (theirs.groupBy("__set", F.pmod(F.xxhash64("__b"), of_b).alias("__bblock")).agg(F.collect_list(F.struct("__b", "__n")).alias("__bs")))
    evaluations = sum(r["x"] * r["b"] for r in counts.values())
    met = xs.join(bs, ["__set", "__bblock"])
    tasks = min(sum(x * b for x, b in zip(n_x, n_b)), math.ceil(evaluations / X.TASK_EVALUATIONS))
    sums = (met.repartition(tasks, "__set", "__xblock", "__bblock")
            .select("__set", "__xs", crossed_sums(grown, slots, "__set", "__xs", F.col("__bs")["__b"], F.col("__bs")["__n"]).alias("__sums"))
            .select("__set", F.explode(F.arrays_zip("__xs", "__sums")).alias("e"))
            .groupBy("__set", F.col("e.__xs").alias("__x")).agg(F.sum("e.__sums").alias("__f")))
    return rows.join(sums, ["__set", "__x"]).select(key, "__set", "__f"), next(iter(counts.values()))["total"]
