"""Driver contract and SQL-oracle agreement at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
# Fast oracle-backed queries re-checked here (the full set: check_oracle.py).
FAST = ["churn_by_segment", "service_features", "feature_lookup", "feature_lookup_multi",
        "stratified_split", "hash_sample", "summary_stats", "data_profile", "histogram",
        "top_values", "standardise", "impute_mean", "impute_mode", "features_merge",
        "features_merge_partial", "csv_roundtrip", "best_trial", "group_difference"]


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns[:3] == ["segment", "n_customers", "n_churned"]
    assert len(rows) >= 1


def test_every_oracle_has_a_query():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 60


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _key(row):
    return tuple((v is None, str(v)) for v in row)


@pytest.mark.parametrize("name", FAST)
def test_oracle_agrees(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = df.columns
    got = sorted((tuple(r[c] for c in sorted(cols)) for r in df.collect()), key=_key)
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(ocols) == sorted(cols)
    idx = [ocols.index(c) for c in sorted(cols)]
    want = sorted((tuple(r[i] for i in idx) for r in cur.fetchall()), key=_key)
    assert got == want
