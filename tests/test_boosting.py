"""Histogram boosting against an exact binned tree, alone against together, saved and loaded."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors

from attrix.operators import boosting as B
from attrix.session import scratch_path


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(12)
    x = np.column_stack([rng.integers(0, 5, 400), rng.normal(size=400).round(2), rng.integers(0, 2, 400), np.full(400, 3.0),
                         rng.integers(0, 40, 400)]).astype(float)
    z = 1.2 * (x[:, 0] > 2) - 0.8 * x[:, 1] + 1.5 * x[:, 2] * (x[:, 4] > 20) - 1
    y = (rng.random(400) < 1 / (1 + np.exp(-z))).astype(float)
    return x, y


@pytest.fixture(scope="module")
def vectors(spark, table):
    x, y = table
    return spark.createDataFrame([(Vectors.dense(r), float(v)) for r, v in zip(x, y)], ["features", "Churn"]).repartition(3).persist()


def plain(x, y, cuts, p):
    """Trees as nested tuples, and the rows' margins, by trying every split of every node."""
    bins = np.column_stack([(x[:, [j]] > c).sum(1) if len(c) else np.zeros(len(x), int) for j, c in enumerate(cuts)])
    margin, trees = np.zeros(len(x)), []
    for _ in range(p["n_estimators"]):
        chance = 1 / (1 + np.exp(-margin))
        g, h = chance - y, chance * (1 - chance)
        step = np.zeros(len(x))

        def score(rows):
            return g[rows].sum() ** 2 / (h[rows].sum() + B.LAMBDA)

        def build(rows, depth):
            best = None
            if depth < p["max_depth"]:
                for j in range(x.shape[1]):
                    for c in range(len(cuts[j])):
                        left, right = rows[bins[rows, j] <= c], rows[bins[rows, j] > c]
                        if min(h[left].sum(), h[right].sum()) < p["min_child_weight"]:
                            continue
                        gain = score(left) + score(right) - score(rows)
                        if best is None or gain > best[0] + 1e-9 * max(1, abs(gain)):
                            best = (gain, j, c, left, right)
            if best is None or best[0] <= B.LEAST_GAIN:
                step[rows] = -p["learning_rate"] * g[rows].sum() / (h[rows].sum() + B.LAMBDA)
                return round(step[rows[0]], 9)
            return best[1], best[2], build(best[3], depth + 1), build(best[4], depth + 1)
        trees.append(build(np.arange(len(x)), 0))
        margin += step
    return trees, margin


def nested(tree, node=0):
    if tree.feature[node] < 0:
        return round(tree.value[node], 9)
    return tree.feature[node], tree.cut[node], nested(tree, tree.left[node]), nested(tree, tree.left[node] + 1)


PARAMS = [{"max_depth": 3, "learning_rate": 0.3, "min_child_weight": 2.0, "n_estimators": 12},
          {"max_depth": 5, "learning_rate": 0.1, "min_child_weight": 7.4, "n_estimators": 7},
          {"max_depth": 1, "learning_rate": 0.5, "min_child_weight": 0.0, "n_estimators": 3},
          {"max_depth": 4, "learning_rate": 0.2, "min_child_weight": 1000.0, "n_estimators": 2}]


def test_trees_equal_an_exact_binned_tree(vectors, table):
    """Four parameter sets grown together, over several blocks, with renewals of the margins between."""
    x, y = table
    grown = B.grow(vectors, PARAMS, bins=16)
    for p, m in zip(PARAMS, grown):
        trees, margin = plain(x, y, m.cuts, p)
        assert [nested(t) for t in m.trees] == trees
        assert m.margin(x) == pytest.approx(margin, abs=1e-8)
    assert all(len(t.feature) == 1 for t in grown[3].trees)  # no child can hold that much


def test_one_block_gives_the_trees_of_many(vectors, table):
    """Rows in one block are grown by trial, each in its task; the trees are the same."""
    x, _ = table
    one, many = B.grow(vectors.coalesce(1), PARAMS, bins=16), B.grow(vectors, PARAMS, bins=16)
    for a, b in zip(one, many):
        assert [nested(t) for t in a.trees] == [nested(t) for t in b.trees]
        assert a.margin(x) == pytest.approx(b.margin(x), abs=1e-9)


def test_shared_bytes_have_the_sums_of_the_slots(table):
    """Slots of few bins share a column; the sums per slot and bin are those of the rows, whichever nodes are open."""
    x, y = table
    cuts = [np.unique(c)[:-1] for c in x.T]
    bins, packing = B.bin_rows(x, cuts), B.Packing.of([len(np.unique(c)) for c in x.T])
    assert len(packing.spans) < len(cuts) and packing.spans.max() <= B.CODES
    assert (packing.bins(packing.codes(bins)) == bins.T).all()
    tree = B.Tree()
    a, b = tree.split(0, 4, 20)
    c, _ = tree.split(a, 0, 2)
    codes, walk = packing.codes(bins), B.Walk.of(tree)
    assert (packing.leaves(walk, codes) == tree.leaves(bins)).all()
    margin = x[None, :, 1]
    sums = B.histograms(B.Block(codes, y, margin), {0: walk}, {0: [c, b]}, packing)[0]
    chance = 1 / (1 + np.exp(-margin[0]))
    for k, node in enumerate((c, b)):
        here = tree.leaves(bins) == node
        for s, start in enumerate(packing.starts):
            for v, i in ((chance - y, 0), (chance * (1 - chance), 1)):
                wanted = np.bincount(bins[here, s], v[here], packing.counts[s])
                assert sums[k, start:start + packing.counts[s], i] == pytest.approx(wanted, abs=1e-9)


def test_a_level_sends_the_driver_splits_and_no_sums(vectors, table):
    """Found in the tasks, from all partitions: some numbers per open node, however many bins and tasks there are."""
    x, y = table
    cuts = B.cut_points(vectors, bins=64)
    packing = B.Packing.of([len(c) + 1 for c in cuts])
    passes = B._Blocks(B.blocks_of(vectors, cuts, packing, "Churn", 1).persist(), packing)
    found = passes.level({0: B.Walk.of(B.Tree())}, {0: [0]}, {0: 2.0})[0]
    passes.free()
    whole = B.Block(packing.codes(B.bin_rows(x, cuts)), y, np.zeros((1, len(x))))
    wanted = B.best_splits(B.histograms(whole, {0: B.Walk.of(B.Tree())}, {0: [0]}, packing)[0], packing.starts, 2.0)
    for a, b in zip(found, wanted):
        assert np.asarray(a) == pytest.approx(np.asarray(b), abs=1e-9)
    assert sum(np.asarray(a).nbytes for a in found) <= 64


def test_child_weight_is_a_hessian_sum(vectors, table):
    x, y = table
    m = B.grow(vectors, [{"max_depth": 6, "learning_rate": 0.3, "min_child_weight": 5.0, "n_estimators": 1}], bins=16)[0]
    leaves = m.trees[0].leaves(B.bin_rows(x, m.cuts))
    # the first tree's hessian is a quarter a row
    assert min(np.bincount(leaves)[np.unique(leaves)]) >= 20 and len(np.unique(leaves)) > 4


def test_bins_hold_equal_shares_and_all_values(vectors, table):
    x, _ = table
    cuts = B.cut_points(vectors, bins=16)
    assert [len(c) for c in cuts] == [4, 15, 1, 0, 15]
    counts = np.bincount(B.bin_rows(x, cuts)[:, 1])
    assert counts.min() >= 15 and counts.max() <= 40
    assert B.bin_rows(np.array([[9e9] * 5]), cuts).tolist() == [[4, 15, 1, 0, 15]]


def test_stage_is_saved_and_loaded(spark, table):
    x, y = table
    names = ["a", "b", "c", "d", "e"]
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], ", ".join(f"{n} double" for n in names) + ", Churn double")
    model = Pipeline(stages=[VectorAssembler(inputCols=names, outputCol="features"), B.HistogramTrees(PARAMS[0])]).fit(df)
    path = scratch_path(spark, "boosted")
    model.write().save(path)
    a = [(r["probability"][1], r["prediction"]) for r in model.transform(df).collect()]
    b = [(r["probability"][1], r["prediction"]) for r in PipelineModel.load(path).transform(df).collect()]
    assert a == b and {p for _, p in a} == {0.0, 1.0}
    right = sum(float(v) == p for v, (_, p) in zip(y, a))
    assert right > max(y.sum(), len(y) - y.sum())


def test_refusals(spark, vectors):
    with pytest.raises(ValueError):
        B.grow(vectors, [{**PARAMS[0], "max_depth": 0}])
    with pytest.raises(ValueError):
        B.grow(vectors.limit(0), PARAMS[:1])


def test_tasks_side_by_side_grow_the_trees_of_a_job_per_level(vectors, table, monkeypatch):
    """The rows are dealt to four tasks, which meet over the folder, in several jobs, with begun models; one job per level gives the same."""
    x, _ = table
    monkeypatch.setattr(B, "TASK_ROWS", 100)
    monkeypatch.setattr(B, "ROUNDS", 5)
    monkeypatch.setattr(B, "SUMMED", 40)
    deep = [*PARAMS, {"max_depth": 7, "learning_rate": 0.2, "min_child_weight": 0.0, "n_estimators": 11}]
    tasks = []
    monkeypatch.setattr(B, "_together", lambda *a, run=B._together: tasks.append(a[4]) or run(*a))
    together = B.grow(vectors, deep, bins=16)
    begun = B.grow(vectors, [{**p, "n_estimators": min(4, p["n_estimators"])} for p in deep], bins=16)
    went_on = B.grow(vectors, deep, bins=16, begun=begun)
    assert tasks == [4, 4, 4]
    monkeypatch.setattr(B, "RESIDENT", 0)
    apart = B.grow(vectors, deep, bins=16)
    assert tasks == [4, 4, 4]
    for a, b, c in zip(together, apart, went_on):
        assert [nested(t) for t in a.trees] == [nested(t) for t in b.trees] == [nested(t) for t in c.trees]
        assert a.margin(x) == pytest.approx(b.margin(x), abs=1e-9)


def test_growing_takes_a_few_jobs_and_leaves_the_driver_little(spark, vectors, monkeypatch):
    """Jobs do not grow with the levels and rounds: 20 trees of depth 5 took 100 jobs of two stages each."""
    monkeypatch.setattr(B, "TASK_ROWS", 100)
    spark.sparkContext.setJobGroup("grow", "grow")
    try:
        B.grow(vectors, [{"max_depth": 5, "learning_rate": 0.1, "min_child_weight": 0.0, "n_estimators": 20}], bins=16)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("grow")) <= 8


def test_rows_of_the_same_bins_are_scored_once(vectors, table, monkeypatch):
    """Each row gets the margin of its own bins, equal rows by one walk."""
    x, _ = table
    grown = B.grow(vectors, PARAMS[:1], bins=16)[0]
    walked = []
    monkeypatch.setattr(B.Walk, "leaves", lambda self, bins, run=B.Walk.leaves: walked.append(len(bins)) or run(self, bins))
    twice = grown.margin(np.concatenate([x[:7]] * 50))
    assert walked and max(walked) <= 7
    assert twice.tolist() == grown.margin(x[:7]).tolist() * 50
