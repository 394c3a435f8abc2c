"""Quantiles in their own type, sketched again where a bracket stays large; favourites
and vocabularies without a task that sees a whole column."""

import math
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from attrix.operators import profile as P


def _ranked(values, p):
    return sorted(values)[math.ceil(p * len(values)) - 1]


def test_quantiles_keep_every_digit(spark):
    rnd = random.Random(3)
    ids = [2**53 + rnd.randrange(4000) for _ in range(3000)] + [-2**63, 2**63 - 1]
    cash = [Decimal(10**25 + rnd.randrange(900)) / 100 for _ in ids]
    df = spark.createDataFrame(list(zip(ids, cash)), "i bigint, d decimal(30,2)")
    for accuracy in (60, 8192):
        got = P.exact_quantiles(df, ["i", "d"], [0.0, 0.1, 0.5, 0.99, 1.0], accuracy)
        for p in (0.0, 0.1, 0.5, 0.99, 1.0):
            assert got["i", p] == (min(ids) if p == 0 else _ranked(ids, p)) and isinstance(got["i", p], int)
            assert got["d", p] == (min(cash) if p == 0 else _ranked(cash, p))
    shown = {(r["column_name"], r["statistic"]): r["text"] for r in P.summary_stats(df, texts=True).collect()}
    assert shown["i", "max"] == str(2**63 - 1) and shown["i", "50%"] == str(_ranked(ids, 0.5)) and shown["i", "mean"] is None


def test_brackets_are_sketched_again(spark, monkeypatch):
    monkeypatch.setattr(P, "BAND_ROWS", 20)
    rnd = random.Random(5)
    values = [rnd.gauss(0, 1) * 10 ** rnd.randrange(-200, 200) for _ in range(4000)] + [math.inf, -math.inf, 0.0, -0.0] + [1.5] * 900
    df = spark.createDataFrame([(v, math.nan if k % 3 else v) for k, v in enumerate(values)], "v double, n double")
    got = P.exact_quantiles(df, ["v", "n"], [0.01, 0.25, 0.5, 0.9], 200)
    kept = sorted(v for k, v in enumerate(values) if not k % 3)
    for p in (0.01, 0.25, 0.5, 0.9):
        assert got["v", p] == _ranked(values, p)
        r = math.ceil(p * len(values)) - 1
        assert got["n", p] == kept[r] if r < len(kept) else math.isnan(got["n", p])
    none = spark.createDataFrame([(None, math.nan)], "a double, b double")
    got = P.exact_quantiles(none, ["a", "b"], [0.5])
    assert got["a", 0.5] is None and math.isnan(got["b", 0.5])
    assert P.exact_quantiles(none.limit(0), ["a", "b"], [0.5]) == {("a", 0.5): None, ("b", 0.5): None}


@pytest.mark.parametrize("tracked", [16, 1 << 14])
def test_heavy_values_equal_full_counts(spark, tracked):
    rnd = random.Random(7)
    rows = [(rnd.choice("ab") if rnd.random() < 0.3 else f"v{rnd.randrange(5000)}", k, rnd.choice([None, None, True]),
             min(int(rnd.paretovariate(0.8)), 10**6)) for k in range(20000)]
    df = spark.createDataFrame(rows, "s string, id long, b boolean, z long")
    cols = ["s", "id", "b", "z"]
    got = sorted(map(tuple, P.heavy_values(df, cols, 4, tracked, most_tracked=1 << 10).select("column_name", "value", "n", "rank").collect()))
    want = []
    for j, c in enumerate(cols):
        text = Counter(str(r[j]).lower() if c == "b" else str(r[j]) for r in rows if r[j] is not None)
        best = sorted(text.items(), key=lambda t: (-t[1], t[0].encode()))[:4]
        want += [(c, v, n, k + 1) for k, (v, n) in enumerate(best)]
    assert got == sorted(want)
    empty = P.heavy_values(df.limit(0), cols, 4)
    assert empty.count() == 0


def test_distinct_counts_without_whole_row_copies(spark):
    df = spark.createDataFrame([(0.0, "a", None), (-0.0, "", None), (math.nan, None, None), (math.nan, "a", None)],
                               "x double, s string, n int")
    got = {r["column_name"]: (r["n_rows"], r["n_nulls"], r["n_distinct"]) for r in P.data_profile(df, exact_distinct=True).collect()}
    assert got == {"x": (4, 0, 2), "s": (4, 1, 2), "n": (4, 4, 0)}


def test_vocabulary_ranks_over_range_partitions(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(5000).select(F.concat(F.lit("k"), F.col("id")).alias("key"), (F.col("id") % 3).cast("string").alias("few"))
        out = P.category_vocabulary(df, ["key", "few"])
        rows = out.collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    for c, values in (("key", {f"k{i}" for i in range(5000)}), ("few", set("012"))):
        assert {r["value"]: r["index"] for r in rows if r["column_name"] == c} == {v: i for i, v in enumerate(sorted(values))}
    assert P.category_vocabulary(df.limit(0), ["key"]).count() == 0
