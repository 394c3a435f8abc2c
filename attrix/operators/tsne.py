"""t-SNE: a map of vectors in the plane that keeps neighbours together, without comparing all pairs.

1. *Points.* Equal vectors are one point; all their keys get its place.
2. *Neighbour graph.* ``TREES`` random-projection trees: per level a random direction, every node is
   split at its median (one grouped aggregation per level for all trees), until a leaf holds about
   ``LEAF`` points. Points of a leaf are compared; a point keeps the ``3 * perplexity`` nearest it met in any tree.
3. *Affinities.* A bisection per point gives its distances the wanted perplexity; both directions are added.
4. *Steps.* Points lie in blocks of about ``BLOCK_POINTS`` neighbours (upper nodes of the first
   tree). A pass is a Spark job: a task moves the points of its block ``LOCAL`` gradient steps,
   with the places of foreign neighbours and the mass of all other points as they were when
   the pass began. The others come as a grid of at most ``CELLS`` x ``CELLS`` sums, so what each task and
   the driver hold for the repulsion does not depend on the number of points. Repulsion is a convolution on the grid.

Passes write their state to the shared scratch folder: a lost executor repeats one pass.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrix.session import cut_lineage, scratch_path, ship

TREES = 8
LEAF = 256
BLOCK_POINTS = 20_000
LOCAL = 25
CELLS = 512
CELL_WIDTH = 0.25
#: edges of a block that are added up at a time
SLICE = 1 << 15
PERPLEXITY = 30.0
START_SPREAD = 0.1
MAX_STEP = 5.0

# The method's usual schedule.
EXAGGERATION = 12.0
EARLY_STEPS, STEPS = 250, 500
MOMENTUM = (0.5, 0.8)

_STATE = "block int, id {t}, x double, y double, vx double, vy double, gx double, gy double"


# -- neighbour graph -----------------------------------------------------------

def leaves_of(points: DataFrame, n: int, dims: int, seed: int, trees: int = TREES, leaf: int = LEAF) -> DataFrame:
    """(tree, node, id, v): every point in its leaf of every tree; a node's number is its path from a leading 1."""
    levels = max(0, math.ceil(math.log2(max(1, n / leaf))))
    out = points.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).withColumn("node", F.lit(1).cast("bigint"))
    if not levels:
        return out
    directions = np.random.default_rng(seed).normal(size=(trees, levels, dims))

    @F.pandas_udf("array<double>")
    def project(tree: pd.Series, v: pd.Series) -> pd.Series:
        if not len(v):
            return pd.Series([], dtype=object)
        return pd.Series(list(np.einsum("nld,nd->nl", directions[tree.to_numpy()], np.stack(v.to_list()))))

    out = cut_lineage(out.withColumn("at", project("tree", "v")))
    for level in range(levels):
        here = F.col("at")[level]
        middle = out.groupBy("tree", "node").agg(F.percentile_approx(here, 0.5, 1_000).alias("middle"))
        out = cut_lineage(out.join(middle, ["tree", "node"])
                          .withColumn("node", F.col("node") * 2 + (here > F.col("middle")).cast("bigint")).drop("middle"))
    return out.drop("at")


def nearest(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, other row, squared distance) of the k nearest others of every row; slices keep memory bounded."""
    k = min(k, len(x) - 1)
    if k < 1:
        return np.empty(0, int), np.empty(0, int), np.empty(0)
    rows, others, found = [], [], []
    for lo in range(0, len(x), 512):
        part = x[lo:lo + 512]
        d2 = ((part[:, None, :] - x[None, :, :]) ** 2).sum(2) if x.shape[1] * len(x) < 1 << 14 else \
            np.maximum((part ** 2).sum(1)[:, None] + (x ** 2).sum(1)[None, :] - 2 * part @ x.T, 0.0)
        d2[np.arange(len(part)), lo + np.arange(len(part))] = np.inf
        at = np.argpartition(d2, k - 1, axis=1)[:, :k]
        rows.append(np.repeat(lo + np.arange(len(part)), k))
        others.append(at.ravel())
        found.append(np.take_along_axis(d2, at, 1).ravel())
    return np.concatenate(rows), np.concatenate(others), np.concatenate(found)


def neighbours(leaves: DataFrame, k: int) -> DataFrame:
    """(id, near): the k nearest others met in any tree, as (d2, other), nearest first."""
    id_type = dict(leaves.dtypes)["id"]

    def run(group: pd.DataFrame) -> pd.DataFrame:
        a, b, d2 = nearest(np.stack(group["v"].to_list()), k)
        ids = group["id"].to_numpy()
        return pd.DataFrame({"id": ids[a], "other": ids[b], "d2": d2})

    pairs = leaves.groupBy("tree", "node").applyInPandas(run, f"id {id_type}, other {id_type}, d2 double")
    pairs = pairs.groupBy("id", "other").agg(F.min("d2").alias("d2"))
    # at most trees * k entries per point
    return pairs.groupBy("id").agg(F.slice(F.array_sort(F.collect_list(F.struct("d2", "other"))), 1, k).alias("near"))


def calibrated(d2: np.ndarray, perplexity: float) -> np.ndarray:
    """Affinities of each row's neighbours (nan: none) whose entropy is that of ``perplexity`` equal ones."""
    held = ~np.isnan(d2)
    goal = np.log(np.maximum(1.0, np.minimum(perplexity, held.sum(1) / 3)))
    near = np.where(held, d2 - np.nanmin(d2, 1, keepdims=True), np.inf)
    scale = np.where(held, near, 0.0).sum(1) / held.sum(1)
    near = near / np.where(scale > 0, scale, 1.0)[:, None]
    low, high = np.full(len(d2), -40.0), np.full(len(d2), 40.0)
    for _ in range(60):
        mid = (low + high) / 2
        p = np.exp(-near * np.exp(mid)[:, None])
        p /= p.sum(1, keepdims=True)
        entropy = -np.where(p > 0, p * np.log(np.where(p > 0, p, 1.0)), 0.0).sum(1)
        low, high = np.where(entropy > goal, mid, low), np.where(entropy > goal, high, mid)
    return p


def affinities(near: DataFrame, n: int, perplexity: float) -> DataFrame:
    """(id, other, p): symmetric, adding up to one."""
    @F.pandas_udf("array<double>")
    def shares(d2: pd.Series) -> pd.Series:
        if not len(d2):
            return pd.Series([], dtype=object)
        wide = np.full((len(d2), max(map(len, d2))), np.nan)
        for i, v in enumerate(d2):
            wide[i, :len(v)] = v
        p = calibrated(wide, perplexity)
        return pd.Series([p[i, :len(v)] for i, v in enumerate(d2)])

    each = (near.withColumn("p", shares(F.transform("near", lambda e: e["d2"])))
            .select("id", F.posexplode("near").alias("k", "e"), "p"))
    one = each.select("id", F.col("e.other").alias("other"), F.col("p")[F.col("k")].alias("p"))
    both = one.unionByName(one.select(F.col("other").alias("id"), F.col("id").alias("other"), "p"))
    return both.groupBy("id", "other").agg((F.sum("p") / (2.0 * n)).alias("p"))


# -- steps -----------------------------------------------------------------------

def _corners(at: np.ndarray, low: np.ndarray, width: float, side: int) -> tuple[np.ndarray, np.ndarray]:
    """The four grid cells around every point and their bilinear weights."""
    u = np.clip((at - low) / width, 0, side - 1 - 1e-9)
    i = u.astype(np.int64)
    f = u - i
    cell = np.stack([(i[:, 0] + a) * side + i[:, 1] + b for a in (0, 1) for b in (0, 1)], 1)
    weight = np.stack([(f[:, 0] if a else 1 - f[:, 0]) * (f[:, 1] if b else 1 - f[:, 1]) for a in (0, 1) for b in (0, 1)], 1)
    return cell, weight


def grid_of(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, float, int]:
    """(corner, cell width, cells a side): cells of CELL_WIDTH, halved for a small map, doubled where CELLS would not do.

    Widths are powers of two of CELL_WIDTH and sides go by 32, so that few kernels are ever needed.
    """
    span = max(float((high - low).max()), 1e-6) * 1.05
    width = CELL_WIDTH
    while span / width < 64:
        width /= 2
    while span / width > CELLS - 2:
        width *= 2
    side = 32 * math.ceil((span / width + 2) / 32)
    return (low + high) / 2 - width * (side - 1) / 2, width, side


@lru_cache(maxsize=4)
def _kernels(side: int, width: float) -> tuple[np.ndarray, ...]:
    """Transforms of w and of w^2 times the difference along either axis."""
    place = np.arange(2 * side)
    gap = np.where(place < side, place, place - 2 * side) * width
    w = 1.0 / (1.0 + gap[:, None] ** 2 + gap[None, :] ** 2)
    return tuple(np.fft.rfft2(k) for k in (w, w ** 2 * gap[:, None], w ** 2 * gap[None, :]))


def repulsion(at: np.ndarray, others: np.ndarray, mass: np.ndarray) -> tuple[np.ndarray, float]:
    """Sum over all points of w^2 (difference) at each point of ``at``, and the normaliser (sum of w over pairs).

    The map is ``at`` (mass one each) and ``others`` with ``mass``; w = 1 / (1 + squared distance).
    """
    everything = np.concatenate([at, others])
    low, width, side = grid_of(everything.min(0), everything.max(0))
    cell, weight = _corners(everything, low, width, side)
    load = np.bincount(cell.ravel(), (weight * np.concatenate([np.ones(len(at)), mass])[:, None]).ravel(), side * side)
    moved = np.fft.rfft2(load.reshape(side, side), (2 * side, 2 * side))
    near, down, across = (np.fft.irfft2(moved * k, (2 * side, 2 * side))[:side, :side].ravel() for k in _kernels(side, width))
    own, share = cell[:len(at)], weight[:len(at)]
    force = [(field[own] * share).sum(1) for field in (down, across)]
    total = float(load @ near)
    return np.stack(force, 1), max(total - len(at) - float(mass.sum()), 1e-12)


def _edge_slices(src: np.ndarray) -> list[tuple[int, int]]:
    """Slices of about ``SLICE`` of the edges, which lie by ``src``; all edges of a point lie in one."""
    ends = [0]
    while ends[-1] < len(src):
        at = min(ends[-1] + SLICE, len(src))
        ends.append(int(np.searchsorted(src, src[at - 1], side="right")))
    return list(zip(ends[:-1], ends[1:]))


def pull_of(places: np.ndarray, n: int, src: np.ndarray, dst: np.ndarray, p: np.ndarray, scale: float,
            slices: Sequence[tuple[int, int]]) -> np.ndarray:
    """The attraction of the first ``n`` places; edges go through in slices that stay in the cache."""
    x, y = np.ascontiguousarray(places[:, 0]), np.ascontiguousarray(places[:, 1])
    out = np.zeros((n, 2))
    for lo, hi in slices:
        a, b = src[lo:hi], dst[lo:hi]
        gap_x, gap_y = x.take(a) - x.take(b), y.take(a) - y.take(b)
        weight = p[lo:hi] / (1.0 + (gap_x * gap_x + gap_y * gap_y))
        low, high = int(a[0]), int(a[-1]) + 1
        for j, gap in enumerate((gap_x, gap_y)):
            out[low:high, j] = np.bincount(a - low, weight * gap * scale, high - low)
    return out


def move(own: np.ndarray, speed: np.ndarray, gain: np.ndarray, fixed: np.ndarray, others: np.ndarray, mass: np.ndarray,
         src: np.ndarray, dst: np.ndarray, p: np.ndarray, first: int, steps: int, rate: float,
         early: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``steps`` gradient steps of a block's points; ``src`` (ascending) and ``dst`` are places in own + fixed."""
    cuts = _edge_slices(src)
    for step in range(first, first + steps):
        attract = pull_of(np.concatenate([own, fixed]), len(own), src, dst, p, EXAGGERATION if step < early else 1.0, cuts)
        push, z = repulsion(own, others, mass)
        slope = 4.0 * (attract - push / z)
        gain = np.maximum(np.where(np.sign(slope) != np.sign(speed), gain + 0.2, gain * 0.8), 0.01)
        speed = MOMENTUM[step >= early] * speed - rate * gain * slope
        length = np.sqrt((speed ** 2).sum(1, keepdims=True))
        speed = speed * np.minimum(1.0, MAX_STEP / np.maximum(length, 1e-12))
        own = own + speed
    return own, speed, gain


def _start(points: DataFrame, dims: int) -> DataFrame:
    """(id, x, y): the first two principal components, scaled, with a little noise that the id decides."""
    noise = [F.pmod(F.xxhash64(F.lit(j), F.col("id")), F.lit(10_007)) / 10_007.0 - 0.5 for j in (0, 1)]
    if dims < 2:
        cells = points.select("id", F.col("v")[0].alias("x"), F.lit(0.0).alias("y"))
    else:
        wide = points.select("id", *[F.col("v")[j].alias(f"v{j}") for j in range(dims)])
        vec = VectorAssembler(inputCols=[f"v{j}" for j in range(dims)], outputCol="__v").transform(wide)
        pc = PCA(k=2, inputCol="__v", outputCol="__pc").fit(vec).transform(vec).select("id", vector_to_array("__pc").alias("c"))
        cells = pc.select("id", F.col("c")[0].alias("x"), F.col("c")[1].alias("y"))
    m = cells.agg(F.avg("x").alias("ax"), F.avg("y").alias("ay"), F.stddev_pop("x").alias("s")).first()
    scale = START_SPREAD / (m["s"] or 1.0)
    return cells.select("id", *[((F.col(c) - F.lit(m["a" + c])) * F.lit(scale) + noise[j] * F.lit(START_SPREAD / 100)).alias(c)
                                for j, c in enumerate("xy")])


def tsne(rows: DataFrame, key: str, features: Sequence[str], perplexity: float = PERPLEXITY, seed: int = 42,
         steps: int = STEPS, early: int = EARLY_STEPS, block_points: int = BLOCK_POINTS, trees: int = TREES,
         leaf: int = LEAF) -> DataFrame:
    """(key, x, y): the map of ``rows`` by their numeric ``features``; scale these beforehand.

    Nulls in features count as 0; rows with a null key are left out. Repeated rows and
    equal vectors share a place. A single point lies at the origin; an empty table gives an empty map.
    ``perplexity`` is lowered to a third of the other points where there are few. Other columns are ignored.
    """
    spark, key_type = rows.sparkSession, rows.schema[key].dataType.simpleString()
    ship(spark)
    v = F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features])
    keyed = cut_lineage(rows.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), v.alias("v")))
    points = cut_lineage(keyed.groupBy("v").agg(F.min("key").alias("id")).select("id", "v"))
    n, dims = points.count(), len(features)

    def placed(places: DataFrame) -> DataFrame:
        owner = keyed.join(points, "v").select("key", "id").distinct()
        return owner.join(places, "id").select(F.col("key").alias(key), "x", "y")

    if n < 2:
        return placed(points.select("id", F.lit(0.0).alias("x"), F.lit(0.0).alias("y")))
    perplexity = max(1.0, min(perplexity, (n - 1) / 3))
    k = min(n - 1, math.ceil(3 * perplexity))
    leaves = leaves_of(points, n, dims, seed, trees, leaf)
    near = neighbours(leaves, k)
    edges = cut_lineage(affinities(near, n, perplexity))
    levels = max(0, math.ceil(math.log2(max(1, n / leaf))))
    upper = min(levels, max(0, math.ceil(math.log2(max(1, n / block_points)))))
    blocks = leaves.where("tree = 0").select("id", F.shiftright("node", levels - upper).cast("int").alias("block"))
    parts = 1 << upper

    state = (blocks.join(_start(points, dims), "id")
             .select("block", "id", "x", "y", *[F.lit(0.0).alias(c) for c in ("vx", "vy")], *[F.lit(1.0).alias(c) for c in ("gx", "gy")]))
    schema = _STATE.format(t=key_type)
    path = scratch_path(spark, "tsne")
    state.write.parquet(f"{path}/0")
    by_block = edges.join(blocks, "id").repartition(parts, "block").persist(StorageLevel.MEMORY_AND_DISK)
    far = (by_block.select("block", F.col("other").alias("id")).distinct()
           .join(blocks.select("id", F.col("block").alias("home")), "id").where("block <> home").select("block", "id"))
    far = cut_lineage(far)
    rate = max(n / EXAGGERATION / 4, 50.0)
    try:
        for number, first in enumerate(range(0, steps, LOCAL)):
            now = spark.read.schema(schema).parquet(f"{path}/{number}")
            step = _step(now, first, min(LOCAL, steps - first), rate, early, schema)
            halo = far.join(now.select("id", "x", "y"), "id").select(
                "block", "id", "x", "y", *[F.lit(None).cast("double").alias(c) for c in ("vx", "vy", "gx", "gy")])
            moving = now.unionByName(halo)
            (by_block.groupBy("block").cogroup(moving.groupBy("block")).applyInPandas(step, schema)
             .write.parquet(f"{path}/{number + 1}"))
    finally:
        by_block.unpersist()
    return placed(spark.read.schema(schema).parquet(f"{path}/{-(-steps // LOCAL)}").select("id", "x", "y"))


def _masses(now: DataFrame) -> tuple[np.ndarray, float, int, np.ndarray]:
    """The grid of a pass and the mass in every cell: at most CELLS x CELLS sums, whatever the number of points."""
    b = now.agg(F.min("x"), F.min("y"), F.max("x"), F.max("y")).first()
    low, width, side = grid_of(np.array(b[:2]), np.array(b[2:]))

    def place(c: str, j: int):
        return F.least(F.greatest((F.col(c) - F.lit(float(low[j]))) / F.lit(width), F.lit(0.0)), F.lit(side - 1 - 1e-9))
    u = now.select(place("x", 0).alias("u"), place("y", 1).alias("w"))
    i, j = F.floor("u"), F.floor("w")
    f, g = F.col("u") - i, F.col("w") - j
    corners = F.explode(F.array(*[F.struct(((i + a) * side + j + b).alias("cell"),
                                           ((f if a else 1 - f) * (g if b else 1 - g)).alias("m")) for a in (0, 1) for b in (0, 1)]))
    mass = np.zeros(side * side)
    for cell, m in u.select(corners.alias("c")).groupBy("c.cell").agg(F.sum("c.m")).collect():
        mass[cell] = m
    return low, width, side, mass


def _step(now: DataFrame, first: int, steps: int, rate: float, early: int, schema: str):
    low, width, side, mass = _masses(now)
    shared = now.sparkSession.sparkContext.broadcast((low, width, side, mass))  # at most CELLS * CELLS sums

    def run(edges: pd.DataFrame, moving: pd.DataFrame) -> pd.DataFrame:
        low, width, side, mass = shared.value
        mine = moving["vx"].notna().to_numpy()
        own, rest = moving[mine].sort_values("id"), moving[~mine]
        at = own[["x", "y"]].to_numpy()
        cell, weight = _corners(at, low, width, side)
        left = np.maximum(mass - np.bincount(cell.ravel(), weight.ravel(), side * side), 0.0)
        left[left < 1e-9] = 0.0
        used = np.flatnonzero(left)
        others = low + np.stack([used // side, used % side], 1) * width
        edges = edges.sort_values(["id", "other"])
        index = pd.Index(np.concatenate([own["id"].to_numpy(), rest["id"].to_numpy()]))
        at, speed, gain = move(at, own[["vx", "vy"]].to_numpy(), own[["gx", "gy"]].to_numpy(), rest[["x", "y"]].to_numpy(), others,
                               left[used], index.get_indexer(edges["id"]), index.get_indexer(edges["other"]),
                               edges["p"].to_numpy(), first, steps, rate, early)
        return pd.DataFrame({"block": own["block"].to_numpy(), "id": own["id"].to_numpy(), "x": at[:, 0], "y": at[:, 1],
                             "vx": speed[:, 0], "vy": speed[:, 1], "gx": gain[:, 0], "gy": gain[:, 1]})
    return run
