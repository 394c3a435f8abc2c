"""Bucketed merges: what is rewritten, what concurrent writers leave, and who is refused."""

import threading
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrix.session import scratch_path
from attrix.sources import manifest as M
from attrix.sources.features import FeatureTableError

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])


def table(spark, buckets=32):
    return M.ManifestTable.create(spark, scratch_path(spark, "manifest"), "id", SCHEMA, buckets)


def rows(spark, ids, a):
    return spark.createDataFrame([(i, a, f"b{i}") for i in ids], SCHEMA)


def content(df):
    return {r["id"]: (r["a"], r["b"]) for r in df.collect()}


def test_merge_rewrites_only_touched_buckets(spark):
    t = table(spark)
    assert t.read().count() == 0 and t.read().columns == ["id", "a", "b"]
    first = t.merge(rows(spark, range(2000), 1))
    one = spark.range(2000).select("id", M.bucket_of(["id"], 32).alias("k"))
    target = one.where("id = 77").first()["k"]
    same = [r["id"] for r in one.where(F.col("k") == target).limit(10).collect()]
    second = t.merge(rows(spark, same, 2))
    changed = [b for b, (x, y) in enumerate(zip(first.folders, second.folders)) if x != y]
    assert changed == [target]
    got = content(t.read())
    assert len(got) == 2000 and all(got[i][0] == (2 if i in same else 1) for i in got)
    # readers of the version before see it whole
    assert set(a for a, _ in content(t.read(first.version)).values()) == {1}


def test_partial_columns_and_new_keys(spark):
    t = table(spark, 4)
    t.merge(rows(spark, [1, 2, 3], 1))
    t.merge(spark.createDataFrame([(2, 9), (5, 9)], "id long, a long"))
    assert content(t.read()) == {1: (1, "b1"), 2: (9, "b2"), 3: (1, "b3"), 5: (9, None)}
    t.overwrite(rows(spark, [7], 3))
    assert content(t.read()) == {7: (3, "b7")}


def test_refusals(spark):
    t = table(spark, 4)
    t.merge(rows(spark, [1], 1))
    for bad in ([(1, 1, "x"), (1, 2, "y")], [(None, 1, "x")]):
        with pytest.raises(FeatureTableError):
            t.merge(spark.createDataFrame(bad, SCHEMA))
    with pytest.raises(FeatureTableError):
        t.merge(spark.createDataFrame([(1, "x")], "id long, a string"))
    with pytest.raises(FeatureTableError):
        t.merge(spark.createDataFrame([(1, 2)], "id long, c long"))
    with pytest.raises(FeatureTableError):
        t.overwrite(spark.createDataFrame([(1, 2)], "id long, a long"))
    with pytest.raises(FeatureTableError):
        M.ManifestTable.create(spark, t.root, "id", SCHEMA)
    with pytest.raises(FeatureTableError):
        M.ManifestTable.create(spark, scratch_path(spark, "m"), "nope", SCHEMA)
    assert content(t.read()) == {1: (1, "b1")}
    assert t.merge(rows(spark, [], 1)).version == t.manifest().version


def committed_between(t, other):
    """Let ``other`` commit between the writer's look at the table and its own commit, once."""
    inner, left = t._commit, [other]

    def commit(m):
        if left:
            left.pop()()
        return inner(m)
    t._commit = commit


@pytest.mark.parametrize("ids", [[1000, 1001], [3, 4]])
def test_no_merge_is_lost_to_a_concurrent_one(spark, ids):
    """The other merge commits first, in other buckets or in the very same ones, with a key in common."""
    t = table(spark, 8)
    t.merge(rows(spark, range(50), 1))
    other = M.ManifestTable(spark, t.root)
    committed_between(t, lambda: other.merge(rows(spark, [*ids, 7], 2)))
    t.merge(spark.createDataFrame([(7, "mine"), (8, "mine")], "id long, b string"))
    got = content(t.read())
    assert all(got[i][0] == 2 for i in ids) and got[7] == (2, "mine") and got[8] == (1, "mine")
    assert len(got) == len({*range(50), *ids}) and t.versions() == [0, 1, 2, 3]


def test_merges_from_threads(spark):
    t = table(spark, 8)
    failed = []

    def work(k):
        try:
            M.ManifestTable(spark, t.root).merge(rows(spark, range(100 * k, 100 * k + 60), k))
        except Exception as e:  # noqa: BLE001
            failed.append(e)
    threads = [threading.Thread(target=work, args=(k,)) for k in range(4)]
    for x in threads:
        x.start()
    for x in threads:
        x.join()
    assert not failed
    got = content(t.read())
    assert len(got) == 240 and all(a == i // 100 for i, (a, _) in got.items())


def test_overwrite_over_a_concurrent_merge(spark):
    t = table(spark, 8)
    t.merge(rows(spark, range(20), 1))
    other = M.ManifestTable(spark, t.root)
    committed_between(t, lambda: other.merge(rows(spark, [500], 2)))
    t.overwrite(rows(spark, [1, 2], 5))
    assert content(t.read()) == {1: (5, "b1"), 2: (5, "b2")}


def test_lookup_of_few_keys_opens_few_files(spark):
    t = table(spark, 64)
    t.merge(rows(spark, range(5000), 1))
    keys = spark.createDataFrame([(i,) for i in (3, 900, 4999, 70_000, None)], "id long")
    found = t.read_for(keys)
    assert content(found) == {3: (1, "b3"), 900: (1, "b900"), 4999: (1, "b4999")}
    assert len({f.rpartition("/")[0] for f in found.inputFiles()}) <= 4 < len({f.rpartition("/")[0] for f in t.read().inputFiles()})
    assert "In(id" in found._jdf.queryExecution().toString()
    many = t.read_for(spark.range(2000).select("id"))
    assert many.count() == 5000 and "In(id" not in many._jdf.queryExecution().toString()
    assert t.read_for(keys.where("id IS NULL")).count() == 0


def test_by_name_in_the_catalog(spark):
    from attrix.operators.lookup import FeatureLookup, create_training_set
    from attrix.sources import features as FT

    name = f"managed_{uuid.uuid4().hex[:8]}"
    FT.create_feature_table(spark, name, "id", schema=SCHEMA, merge_buckets=4)
    FT.write_features(spark, name, rows(spark, [1, 2], 1))
    FT.write_features(spark, name, rows(spark, [2, 3], 2))
    assert content(FT.read_features(spark, name)) == {1: (1, "b1"), 2: (2, "b2"), 3: (2, "b3")}
    assert FT.primary_keys(spark, name) == ["id"]
    with pytest.raises(Exception, match="read_features"):
        spark.read.table(name).collect()
    base = spark.createDataFrame([(2, "x"), (9, "y")], "id long, c string")
    got = create_training_set(base, [FeatureLookup(table=name, lookup_key="id")]).load_df()
    assert sorted(map(tuple, got.select("id", "c", "a").collect())) == [(2, "x", 2), (9, "y", None)]
    with pytest.raises(FeatureTableError):
        FT.create_feature_table(spark, name, "id", schema=SCHEMA, merge_buckets=4)
    FT.write_features(spark, name, rows(spark, [5], 5), "overwrite")
    assert FT.expire_versions(spark, name, keep=0) > 0 and content(FT.read_features(spark, name)) == {5: (5, "b5")}


def test_expire_keeps_what_is_named(spark):
    t = table(spark, 4)
    for k in range(4):
        t.merge(rows(spark, [k], k))
    before = content(t.read())
    assert t.expire(keep=2) > 0
    assert t.versions() == [3, 4] and content(t.read()) == before and len(content(t.read(3))) == 3
    with pytest.raises(FeatureTableError):
        t.read(1)
    t.merge(rows(spark, [9], 9))
    assert len(content(t.read())) == 5
