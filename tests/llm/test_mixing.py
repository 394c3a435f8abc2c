"""Source mixing: targets, knapsack and selection against plain forms."""

import itertools
import re

import numpy as np
import pytest

import __spark_entry__ as E
from attrix.llm import mixing
from tests.conftest import SF_CHECK

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, repeats=2):
    """{source: words} -> {source: target}, filled up source by source."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(repeats * sizes[s] for s in capped)
        got = {s: rest * weight[s] / sum(weight[t] for t in free) for s in free}
        above = {s for s in free if got[s] > repeats * sizes[s]}
        if not above:
            return {**got, **{s: repeats * sizes[s] for s in capped}}
        capped |= above


def check_mix(rows, docs):
    """docs: (doc_id, text, source) of every row."""
    words = [(i, len(WORDS.findall(t or "")), s) for i, t, s in docs]
    assert sorted(((r["doc_id"], r["size"], r["source"]) for r in rows), key=str) == sorted(words, key=str)
    per = {}
    for _, n, s in words:
        per[s] = per.get(s, 0) + n
    want = plain_targets(per)
    taken = dict.fromkeys(per, 0)
    for r in rows:
        assert r["taken"] in (0, r["size"], 2 * r["size"]) and r["source_size"] == per[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]], rel=1e-12, abs=1e-9)
        taken[r["source"]] += r["taken"]
    return want, taken


def test_mix_of_the_table(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    rows = E.queries()["op13_source_mixing"](spark, SF_CHECK).collect()
    want, taken = check_mix(rows, [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()])
    for s in want:
        assert abs(taken[s] - want[s]) <= 3, s
    again = mixing.mix(docs.repartition(7, "lang", "doc_id")).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    other = mixing.mix(docs, seed=1).collect()
    assert sorted(map(str, other)) != sorted(map(str, rows))


@pytest.mark.parametrize("seed", range(40))
def test_fit_is_the_nearest_subset_sum(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.choice(np.arange(1, 60) * int(rng.integers(1, 4)), int(rng.integers(1, 6)), replace=False).astype(np.int64)
    counts = rng.integers(1, 5, len(lengths))
    sums = {sum(c * n for c, n in zip(pick, lengths))
            for pick in itertools.product(*[range(c + 1) for c in counts])}
    for budget in rng.integers(0, int((lengths * counts).sum()) + 1, 10):
        take = mixing.fit_budget(lengths, counts, int(budget))
        assert ((0 <= take) & (take <= counts)).all()
        # the equal share of every length is fixed first, so the nearest sum is the one above it
        base = np.array([int(c) * int(budget) // int((lengths * counts).sum()) for c in counts])
        near = min(abs(s - budget) for s in {sum((b + c) * n for b, c, n in zip(base, pick, lengths))
                                             for pick in itertools.product(*[range(c - b + 1) for b, c in zip(base, counts)])})
        assert abs(int((take * lengths).sum()) - budget) == near >= min(abs(s - budget) for s in sums)


def test_fit_beyond_one_window():
    lengths = np.array([1, 7, 50_000, 1_000_003], np.int64)
    counts = np.array([3, 40, 60, 5], np.int64)
    for budget in (3, 66_000, 2_000_017, 4_400_281):
        take = mixing.fit_budget(lengths, counts, budget)
        assert (take <= counts).all() and abs(int((take * lengths).sum()) - budget) <= 25_000
    # only long ones: the nearer of none and one more
    assert mixing.fit_budget(np.array([900_000]), np.array([2]), 800_000).tolist() == [1]
    assert mixing.fit_budget(np.array([900_000]), np.array([2]), 300_000).tolist() == [0]


def test_edge_rows(spark):
    schema = "doc_id long, text string, source string, size long, sid string, n int, target string"
    rows = [(1, "a b c", "x"), (2, None, "x"), (3, "", "y"), (4, " \t ", None), (5, "word " * 70_000, "z"),
            (6, "a b", "é"), (6, "a b", "é"), (6, "c d", "é"), (None, "one two three", None), (None, "one two three", None)]
    rows += [(9, "same words here", "hot")] * 3000
    df = spark.createDataFrame([(*r, 1, "s", 2, "t") for r in rows], schema)
    out = mixing.mix(df).collect()
    assert len(out) == len(rows)
    want, taken = check_mix(out, rows)
    for s in want:
        # whole documents: off by no more than the half of one that fits
        assert abs(taken[s] - want[s]) <= max([1, *[r["size"] for r in out if r["source"] == s]]) / 2 + 1
    assert mixing.mix(df.limit(0)).count() == 0
    silent = mixing.mix(df.where("doc_id IN (2, 3, 4)")).collect()
    assert [(r["taken"], r["target"]) for r in silent] == [(0, 0.0)] * 3
