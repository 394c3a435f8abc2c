"""Operator 4: embedding near-duplicates by random projection passes.

Vectors are compared within a label (and dimension) only; two link when their
cosine, in double precision, is at least the threshold.

1. *Classes.* Equal vectors of a label are one class with a count, by a
   map-side combined grouping; nothing below sees a copy twice.
2. *Passes.* Each pass gives a class a code of sign bits of random projections
   (fixed seed per pass) and orders a label's classes by it, bit by bit. Every
   class is compared with its ``WINDOW`` neighbours in that order; the order is
   global, and blocks of it take the last ``WINDOW`` places before them along.
3. *Long runs.* Classes with the same leading bits lie together. Runs of more than
   a window are compared whole, in cells of ``CELL`` classes, so a pair that
   agrees in the leading bits of a pass is always found. It does so with a
   probability that depends on nothing but its angle; for any number of bits the
   number of passes at which a pair at the threshold is missed with probability
   ``MISS`` at most is known, however the label's vectors lie. What depends on
   them is the cost: the bits, and with them the passes, are chosen per label from the
   agreement of its codes in the first pass. Labels of all sizes go this way.
4. *Components.* Verified pairs of all passes, made distinct, become components.
5. *Completion.* Within a component of two classes or more every pair is
   compared, in blocks of ``CELL`` classes, and only counts per class come out;
   so a missed pair costs no links unless nothing else holds its component
   together. The work of this step grows with the square of a component, which
   the number of links does as well.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrix.llm.common import connected_components, positions, stored

THRESHOLD = 0.98
MISS = 1e-4
CELL = 512
#: neighbours that a class is compared with in each pass, and classes of a block of the order
WINDOW, BLOCK = 32, 512
#: numbers of leading bits that a label can take; all bits are sorted by
LEVELS = tuple(range(8, 33, 2))
#: cost of carrying a class into a cell, in comparisons
CARRY = 512


def passes_for(bits: int, threshold: float = THRESHOLD, miss: float = MISS) -> int:
    """Passes needed for runs of ``bits`` equal leading bits.

    Two vectors at angle ``a`` agree in one sign bit with probability
    ``1 - a / pi``, so they share a run with at least its power ``bits``.
    """
    meet = (1 - math.acos(min(1.0, max(-1.0, threshold))) / math.pi) ** bits
    return 1 if meet == 1 else max(1, math.ceil(math.log(miss) / math.log1p(-meet)))


#: rows that can be compared at all
_COMPARABLE = ("id IS NOT NULL AND label IS NOT NULL AND size(vec) > 0 AND exists(vec, x -> x <> 0) "
               "AND NOT exists(vec, x -> x IS NULL OR isnan(x) OR abs(x) = double('inf'))")


def _raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        raw = [(v.values.to_numpy(zero_copy_only=False) + 0.0).astype("<f8").tobytes()  # -0.0 equals 0.0
               for v in b.column("vec").cast(pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), pa.array(raw, pa.binary())],
                                         names=["id", "label", "raw"])


_CODED = "label string, dim int, pass int, code long, node long"


def _codes(seed: int):
    """Of (label, raw, node, passes): one row per class and pass with its code, first bit highest."""
    weight = 1 << np.arange(LEVELS[-1], dtype=np.int64)[::-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            raws, node, label, passes = (b.column(c).to_pylist() for c in ("raw", "node", "label", "passes"))
            for dim, n in sorted({(len(r), y) for r, y in zip(raws, passes)}):
                at = [i for i, r in enumerate(raws) if (len(r), passes[i]) == (dim, n)]
                x = np.frombuffer(b"".join(raws[i] for i in at), dtype="<f8").reshape(len(at), -1)
                x = x / np.abs(x).max(1, keepdims=True)
                for p in range(n):
                    if (dim, p) not in planes:
                        planes[dim, p] = np.random.default_rng((seed, dim, p)).standard_normal((x.shape[1], LEVELS[-1]))
                    yield pa.RecordBatch.from_pydict({
                        "label": pa.array([label[i] for i in at], pa.string()), "dim": pa.array([dim] * len(at), pa.int32()),
                        "pass": pa.array([p] * len(at), pa.int32()), "code": pa.array((x @ planes[dim, p] > 0) @ weight),
                        "node": pa.array([node[i] for i in at], pa.int64())})
    return run


def _unit(raws: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(raws), dtype="<f8").reshape(len(raws), -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _forest(near: np.ndarray) -> list[tuple[int, int]]:
    """Edges of the symmetric matrix ``near`` that connect what all its edges connect."""
    seen, edges = np.zeros(len(near), dtype=bool), []
    for start in np.flatnonzero(near.any(1)).tolist():
        if seen[start]:
            continue
        seen[start], open_ = True, [start]
        while open_:
            k = open_.pop()
            new = np.flatnonzero(near[k] & ~seen).tolist()
            seen[new] = True
            edges += [(k, x) for x in new]
            open_ += new
    return edges


_CELL_KEY = ["label", "dim", "pass", "code", "i", "j"]


def _cells(threshold: float):
    """Of rows sorted by cell, no cell in two partitions: links that connect what the links of the cell connect."""
    def links(i: int, j: int, rows: list[tuple]) -> list[tuple[int, int]]:
        x, block = _unit([r[2] for r in rows]), np.array([r[0] for r in rows])
        if i == j:
            near = x @ x.T >= threshold
            np.fill_diagonal(near, False)
        else:
            left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
            near = np.zeros((len(rows), len(rows)), dtype=bool)
            near[np.ix_(left, right)] = x[left] @ x[right].T >= threshold
            near |= near.T
        return [(rows[a][1], rows[z][1]) for a, z in _forest(near)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found):
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()),
                                               pa.array([z for _, z in found], pa.int64())], names=["a", "b"])

        key, held = None, []
        for b in batches:
            found = []
            keys = zip(*(b.column(c).to_pylist() for c in _CELL_KEY))
            for now, row in zip(keys, zip(*(b.column(c).to_pylist() for c in ("block", "cls", "raw")))):
                if now != key:
                    if len(held) > 1:
                        found += links(*key[4:], held)
                    key, held = now, []
                held.append(row)
            yield out(found)
        if len(held) > 1:
            yield out(links(*key[4:], held))
    return run


def _windows(threshold: float):
    """Of rows sorted by (block, pos), no block in two partitions: links between neighbours of one pass,
    enough of them to connect what all these links connect."""
    def links(rows: list[tuple]) -> list[tuple[int, int]]:
        x = _unit([r[1] for r in rows])
        near = x @ x.T >= threshold
        at = np.arange(len(rows))
        near &= np.abs(at[:, None] - at) <= WINDOW
        np.fill_diagonal(near, False)
        return [(rows[a][0], rows[z][0]) for a, z in _forest(near)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found):
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()),
                                               pa.array([z for _, z in found], pa.int64())], names=["a", "b"])

        key, held = None, []
        for b in batches:
            found = []
            keys = zip(*(b.column(c).to_pylist() for c in ("block", "label", "dim", "pass")))
            for now, row in zip(keys, zip(*(b.column(c).to_pylist() for c in ("cls", "raw")))):
                if now != key:
                    if len(held) > 1:
                        found += links(held)
                    key, held = now, []
                held.append(row)
            yield out(found)
        if len(held) > 1:
            yield out(links(held))
    return run


def _shift(bits) -> Column:
    """The code without all but its ``bits`` leading bits."""
    return F.expr(f"shiftright(code, {LEVELS[-1]} - {bits})")


def _levels(classes: DataFrame, threshold: float, miss: float, seed: int) -> DataFrame:
    """(label, dim, bits, passes) of every label: the cheapest level by the runs of its first pass."""
    one = classes.select("label", "raw", "node", F.lit(1).alias("passes")).mapInArrow(_codes(seed), _CODED)
    levels = F.explode(F.array(*[F.struct(F.lit(k).alias("bits"), F.lit(passes_for(k, threshold, miss)).alias("passes"))
                                 for k in LEVELS]))
    m = F.col("m").cast("double")
    whole = F.when(m > WINDOW, F.lit(CARRY) * m * F.ceil(m / CELL) + m * (m - 1) / 2).otherwise(0.0)
    return stored(one.withColumn("level", levels).select("label", "dim", "level.bits", "level.passes", "code")
                  .groupBy("label", "dim", "bits", "passes", _shift("bits").alias("run"))
                  .agg(F.count(F.lit(1)).alias("m"))
                  .groupBy("label", "dim", "bits", "passes")
                  .agg((F.col("passes") * F.sum(m * (CARRY + WINDOW) + whole)).alias("cost"))
                  .groupBy("label", "dim").agg(F.min(F.struct("cost", "bits", "passes")).alias("best"))
                  .select("label", "dim", "best.bits", "best.passes"), "embedding-levels")


def _links(classes: DataFrame, threshold: float, miss: float, seed: int) -> DataFrame:
    """(a, b): links between classes, enough of them to connect every component."""
    levels = _levels(classes, threshold, miss, seed)
    chosen = (classes.select("label", "raw", "node", F.length("raw").alias("dim")).join(levels, ["label", "dim"])
              .select("label", "raw", "node", "passes"))
    order = ["label", "dim", "pass", "code", "node"]
    placed = positions(chosen.mapInArrow(_codes(seed), _CODED), order, "embedding-order")
    raws = classes.select("label", "node", "cls", "raw")
    tasks = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    block = F.expr(f"pos div {BLOCK}")
    along = F.expr(f"pos % {BLOCK} >= {BLOCK - WINDOW}").cast("int")
    near = (placed.select("label", "dim", "pass", "node", "pos", F.explode(F.sequence(block, block + along)).alias("block"))
            .join(raws, ["label", "node"]).repartition(tasks, "block").sortWithinPartitions("block", "pos")
            .mapInArrow(_windows(threshold), "a long, b long"))

    run = ["label", "dim", "pass", "run"]
    leading = placed.join(levels, ["label", "dim"]).select("label", "dim", "pass", "node", _shift("bits").alias("run"))
    long = stored(leading.groupBy(*run).agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > WINDOW)
                  .select(*run, F.ceil(F.col("m") / CELL).cast("int").alias("blocks")), "embedding-runs")
    members = (leading.join(long, run).join(raws, ["label", "node"]).withColumnRenamed("run", "code")
               .withColumn("block", F.pmod(F.xxhash64("raw"), F.col("blocks")).cast("int")))
    cells = (members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
             .select(*_CELL_KEY, "block", "cls", "raw"))
    whole = (cells.repartition(tasks, *_CELL_KEY).sortWithinPartitions(*_CELL_KEY)
             .mapInArrow(_cells(threshold), "a long, b long"))
    return near.unionByName(whole).distinct()


def _complete(threshold: float):
    def run(key, table):
        node, n, block = (table.column(c).to_pylist() for c in ("node", "n", "block"))
        i, j = (k.as_py() for k in key[-2:])
        raws = table.column("raw").to_pylist()
        left = [k for k, x in enumerate(block) if x == i]
        right = [k for k, x in enumerate(block) if x == j]
        near = _unit([raws[k] for k in left]) @ _unit([raws[k] for k in right]).T >= threshold
        count = np.array(n, dtype=np.int64)
        if i == j:
            np.fill_diagonal(near, False)
        out = {node[k]: int(count[right][near[x]].sum()) for x, k in enumerate(left)}
        if i != j:
            for x, k in enumerate(right):
                out[node[k]] = int(count[left][near[:, x]].sum())
        return pa.table({"node": pa.array(list(out), pa.int64()), "links": pa.array(list(out.values()), pa.int64())})
    return run


def embedding_components(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                         label_col: str = "label", threshold: float = THRESHOLD, miss: float = MISS,
                         seed: int = 20240607) -> DataFrame:
    """(id, n_links, component_id, kept) for every row of ``vectors``.

    * null id, null label, null or empty vector, zero vector, null or non-finite component:
      0 links, its own component, kept unless the id is null;
    * vectors of one label but different length are not compared;
    * repeated rows and copies link with one another like any equal vectors;
      the class id, and so the component, is the smallest id among the members;
    * rows with one id and different vectors are one node of the components,
      each with the links of its own vector;
    * an empty table gives an empty result; other columns are ignored.
    """
    src = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                         F.col(vector_col).cast("array<double>").alias("vec"))
    good = stored(src.where(_COMPARABLE).mapInArrow(_raw, "id long, label string, raw binary"), "embedding-valid")
    classes = stored(good.groupBy("label", "raw").agg(F.min("id").alias("cls"), F.count(F.lit(1)).alias("n"))
                     .withColumn("node", F.xxhash64("label", "raw")), "embedding-classes")
    pairs = stored(_links(classes, threshold, miss, seed), "embedding-pairs")
    comps = connected_components(pairs, "a", "b").withColumnsRenamed({"node": "cls"})

    # ids may repeat, so a component can hold several labels and lengths
    part = ["component", "label", "dim"]
    inside = classes.select("cls", "node", "n", "raw", "label", F.length("raw").alias("dim")).join(comps, "cls")
    sizes = inside.groupBy(*part).agg(F.ceil(F.count(F.lit(1)) / CELL).cast("int").alias("blocks"))
    placed = inside.join(sizes, part).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    cells = (placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")))
    links = (cells.groupBy(*part, "i", "j").applyInArrow(_complete(threshold), "node long, links long")
             .groupBy("node").agg(F.sum("links").alias("links")))
    known = (classes.join(comps, "cls", "left").join(links, "node", "left")
             .select("label", "raw", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                     F.coalesce("component", "cls").alias("component_id")))
    linked = good.join(known, ["label", "raw"]).select("id", "n_links", "component_id")
    alone = src.where(f"NOT coalesce({_COMPARABLE}, false)").select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id",
                      F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
