"""Ranked lexical search against SQL and a plain form."""

import math
import re
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from attrix.llm import lexical
from tests.conftest import SF_CHECK, SF_SMALL

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, top=20):
    bags = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n = len(bags)
    length = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    w = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * k + 1))) for t, k in df.items()}
    queries = {}
    for item, text in set(items):
        queries.setdefault(item, Counter()).update(terms(text))
    out = []
    for item, query in queries.items():
        scored = []
        for doc, b in bags:
            m = 75 + (25 * sum(b.values()) * n) // length
            score = sum(k * w[t] * ((10 ** 9 * b[t]) // (1000 * b[t] + 12 * m)) for t, k in query.items() if t in b)
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("sf", [SF_SMALL, SF_CHECK])
def test_search_equals_its_sql(spark, sf):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    want = con.execute(f"SELECT item_id, rank, doc_id, score FROM ({E.oracle_sql()['op12_lexical_search']})").fetchall()
    got = rows(E.queries()["op12_lexical_search"](spark, sf))
    assert got == sorted(want, key=str) and len(got) > 300


@pytest.fixture(scope="module")
def odd(spark):
    docs = [(1, "Alpha beta, beta GAMMA-delta"), (2, "alpha beta beta gamma delta"), (3, None), (4, ""), (5, " ,;! "),
            (None, "alpha beta"), (6, "alpha"), (6, "alpha"), (7, "Été É é x9 x9\x7fy"), (8, "word " * 30_000 + "rare"),
            (9, "epsilon zeta"), (-3, "ALPHA beta BETA gamma delta")]
    docs += [(100 + i, "hot copy of alpha and rare words") for i in range(300)]
    items = [(1, "alpha alpha beta?"), (2, "RARE words"), (2, "RARE words"), (3, None), (4, "nothing known"), (None, "x9 Été"),
             (-5, "gamma"), (-5, "delta zeta"), (6, "word rare y")]
    d = spark.createDataFrame([(*r, "h", 1, 2) for r in docs], "doc_id long, text string, bag string, n int, t int")
    i = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, term string")
    return docs, items, d, i


def test_edge_rows_and_slices(spark, odd):
    docs, items, d, i = odd
    want = plain(docs, items)
    assert rows(lexical.search(d, i)) == want
    # three terms a slice: many vocabulary slices and item slices
    assert rows(lexical.search(d.repartition(5), i, limit=3)) == want
    assert rows(lexical.search(d, i, top=2)) == plain(docs, items, 2)


def test_empty_tables(spark, odd):
    _, _, d, i = odd
    assert lexical.search(d.limit(0), i).count() == 0
    assert lexical.search(d, i.limit(0)).count() == 0
    assert lexical.search(d.where("text IS NULL"), i).count() == 0
