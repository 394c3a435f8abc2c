import random

import pytest

from attrix.llm import shingle_join as J
from attrix.llm.shingles import text_shingles, text_shingles_batch
from tests.conftest import SF_CHECK
from tests.llm import brute


def run(spark, rows, schema="doc_id long, text string"):
    df = spark.createDataFrame(rows, schema)
    return sorted(tuple(r) for r in J.shingle_components(df).collect())


def test_batch_equals_single():
    texts = ["A b\tc", None, "", "x y z w v u t", " q ", "é " * 3000]
    for a, b in zip(text_shingles_batch(texts), [text_shingles(t) for t in texts]):
        assert a.tolist() == b.tolist()
    for t in texts:
        assert len(text_shingles(t)) == len(brute.shingle_set(t))


def test_long_text_in_blocks(monkeypatch):
    from attrix.llm import shingles
    text = " ".join(str(i * 7919 % 1000) for i in range(5000)) + " " + "z" * 3000
    whole = shingles.text_shingles(text)
    monkeypatch.setattr(shingles, "BLOCK_BYTES", 997)
    assert shingles.text_shingles(text).tolist() == whole.tolist()


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  B"), (6, "b a"), (7, "one two three four five six"),
            (7, "one two three four five six"), (9, "one two three four five six")]
    assert run(spark, rows) == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6),
                                       (7, 2, 7), (7, 2, 7), (9, 2, 7)])
    assert run(spark, []) == []


def test_planted_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(J, "GROUP", 4)
    monkeypatch.setattr(J, "QUERIES", 3)
    monkeypatch.setattr(J, "MIN_FREQUENT", 3)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    passage = [rng.choice(words) for _ in range(30)]
    rows, k = [], 0
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.randint(5, 80))]
        for _ in range(rng.choice([1, 1, 2, 12])):
            t = list(base)
            for _ in range(rng.randint(0, max(1, len(t) // 25))):
                t[rng.randrange(len(t))] = rng.choice(words)
            if rng.random() < 0.4:
                t = t + passage
            rows.append((k, " ".join(t)))
            k += 1
    assert run(spark, rows) == brute.shingle_components(rows)


@pytest.mark.parametrize("sf", [SF_CHECK])
def test_table_against_brute_force(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in J.shingle_components(df).collect())
    assert got == brute.shingle_components(rows)


def test_position_bound_of_very_large_sets(spark):
    n = 12_000_000  # 180 times this is no 32-bit integer
    sets = spark.createDataFrame([(k, k, n, [1], bytearray(b"\xff" * 8), "a b") for k in (1, 2)],
                                 "sig long, rep long, n long, leads array<long>, sketch binary, text string")
    shared = spark.createDataFrame([(7, 1, n), (7, 2, n)], "token long, sig long, left int")
    homes = spark.createDataFrame([], "rep long, home long")
    assert {tuple(sorted(r)) for r in J._search(sets, shared, homes, 5, 80, None).collect()} == {(1, 2)}
