"""Keyed feature tables on the Spark catalog.

A feature table is an external Parquet table with a declared primary key
(kept in table properties). Every write checks the key (no nulls, no
duplicates) and lands in a fresh folder of its own attempt; the catalog entry is then
pointed at it (``ALTER TABLE ... SET LOCATION``). A merge therefore never
overwrites the files it is reading, and readers of the old version are not
disturbed mid-write. Old versions are left in place.

Write modes:
  overwrite  the new rows replace the table
  merge      upsert by key: new rows replace old rows with the same key, old
             rows without a new row stay. When the new rows carry only some
             of the feature columns, the other columns keep their old values.

A table created with ``merge_buckets`` keeps its rows by key bucket under a manifest
(``attrix.sources.manifest``): a merge rewrites only the buckets that it touches, and
concurrent merges are all kept. Its catalog entry holds the key and the folder; the
rows are read with ``read_features`` (lookups by name do so), and a plain read of
the entry is an error.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrix.session import scratch_path
from attrix.sources.tables import bucket_spec, is_path, read_table, table_exists, table_location

PROP_KEYS = "attrix.primary_keys"
PROP_ROOT = "attrix.root"
PROP_MANIFEST = "attrix.manifest"


class FeatureTableError(ValueError):
    pass


def key_violations(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Keys that break a primary key: duplicated or (partly) null.

    A grouped count with map-side partial aggregation, so a heavily repeated
    key is combined before the shuffle.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
              .filter((F.col("n_rows") > 1) | null_key))


def check_keys(df: DataFrame, keys: Sequence[str]) -> None:
    bad = key_violations(df, keys).limit(5).collect()
    if bad:
        raise FeatureTableError(f"primary key {list(keys)} violated, e.g. {[r.asDict() for r in bad]}")


def _props(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    return {r["key"]: r["value"] for r in rows}


def primary_keys(spark: SparkSession, name: str) -> list[str]:
    p = _props(spark, name)
    if PROP_KEYS not in p:
        raise FeatureTableError(f"{name} is not a feature table")
    return p[PROP_KEYS].split(",")


def create_feature_table(spark: SparkSession, name: str, primary_keys: str | Iterable[str],
                         schema: T.StructType | None = None, df: DataFrame | None = None,
                         description: str = "", path: str | None = None,
                         buckets: int | None = None, merge_buckets: int | None = None) -> str:
    """Register an empty feature table with a key and a schema.

    Refuses when the table exists: a feature table is not silently
    re-created. With ``df`` the rows are merged in right away. ``buckets``
    hash-buckets every version by the key, so lookups against a base table
    bucketed the same way need no shuffle. ``merge_buckets`` keeps the rows
    under a manifest of so many key buckets instead.
    """
    keys = [primary_keys] if isinstance(primary_keys, str) else list(primary_keys)
    if table_exists(spark, name):
        raise FeatureTableError(f"feature table {name} already exists")
    schema = schema if schema is not None else df.schema
    missing = [k for k in keys if k not in schema.fieldNames()]
    if missing:
        raise FeatureTableError(f"key columns {missing} not in schema")
    root = path or scratch_path(spark, f"features/{name.replace('.', '_')}")
    if merge_buckets:
        if buckets:
            raise FeatureTableError("a table is bucketed for joins or for merges, not both")
        _create_under_manifest(spark, name, root, keys, schema, merge_buckets)
        if df is not None:
            write_features(spark, name, df, mode="merge")
        return root
    first = f"{root}/v00000"
    # The first version is an empty folder: the schema lives in the catalog,
    # and no file means no file without a bucket id in a bucketed table.
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(first)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(hpath):
        raise FeatureTableError(f"{first} already exists")
    fs.mkdirs(hpath)
    if buckets:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        key_list = ", ".join(f"`{k}`" for k in keys)
        quoted = description.replace("\\", "\\\\").replace("'", "\\'")
        comment = f" COMMENT '{quoted}'" if description else ""
        spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet CLUSTERED BY ({key_list}) "
                  f"SORTED BY ({key_list}) INTO {int(buckets)} BUCKETS LOCATION '{first}'{comment}")
    else:
        spark.catalog.createTable(name, path=first, source="parquet", schema=schema,
                                  description=description or None)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ("
              f"'{PROP_KEYS}'='{','.join(keys)}', '{PROP_ROOT}'='{root}')")
    if df is not None:
        write_features(spark, name, df, mode="merge")
    return root


def _create_under_manifest(spark: SparkSession, name: str, root: str, keys: Sequence[str],
                           schema: T.StructType, buckets: int) -> None:
    """The table's folder, and a catalog entry that says where it is and refuses to be read itself."""
    from attrix.sources.manifest import ManifestTable

    ManifestTable.create(spark, root, keys, schema, buckets)
    refuse = f"raise_error('read {name} with read_features')"
    cols = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields)
    spark.sql(f"CREATE VIEW {name} TBLPROPERTIES ('{PROP_KEYS}'='{','.join(keys)}', '{PROP_ROOT}'='{root}', "
              f"'{PROP_MANIFEST}'='true') AS SELECT {cols} WHERE {refuse} IS NULL")


def _manifest(spark: SparkSession, name: str):
    """The table of ``name`` if it lies under a manifest, else None."""
    from attrix.sources.manifest import ManifestTable

    if is_path(name) or not spark.catalog.tableExists(name) or spark.catalog.getTable(name).isTemporary:
        return None
    props = _props(spark, name)
    return ManifestTable(spark, props[PROP_ROOT]) if PROP_MANIFEST in props else None


def merge_rows(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert ``new`` into ``old`` by key, as a join plan (no driver work)."""
    keys = list(keys)
    old_cols = old.columns
    new_feats = [c for c in new.columns if c not in keys]
    if set(new.columns) == set(old_cols):
        kept = old.join(new.select(*keys), on=keys, how="left_anti")
        return kept.unionByName(new.select(*old_cols))
    unknown = [c for c in new_feats if c not in old_cols]
    if unknown:
        raise FeatureTableError(f"columns {unknown} are not in the feature table")
    o = old.alias("o")
    n = new.withColumn("__new_row", F.lit(True)).alias("n")
    joined = o.join(n, on=keys, how="full_outer")
    out = []
    for c in old_cols:
        if c in keys:
            out.append(F.col(c))
        elif c in new_feats:
            out.append(F.when(F.col("n.__new_row"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
        else:
            out.append(F.col(f"o.{c}").alias(c))
    return joined.select(*out)


def write_features(spark: SparkSession, name: str, df: DataFrame, mode: str = "merge") -> str:
    """Write the new version to a folder of this attempt, check its keys, swap.

    The folder name is unique to the attempt, so what a failed write left
    behind is never in the way. The rows are derived once: keys are checked on
    the written files (the new rows' own keys too, since a merge would hide a
    repeated key). The swap is one statement, the table's location; the version
    number is read from it.
    """
    if mode not in ("merge", "overwrite"):
        raise FeatureTableError(f"unsupported mode {mode!r}")
    under = _manifest(spark, name)
    if under is not None:
        under.merge(df) if mode == "merge" else under.overwrite(df)
        return under.root
    props = _props(spark, name)
    keys = props[PROP_KEYS].split(",")
    root = props[PROP_ROOT]
    version = _version(spark, name) + 1
    current = spark.read.table(name)
    table_types = dict(current.dtypes)
    for c, t in df.dtypes:
        if c in table_types and table_types[c] != t:
            raise FeatureTableError(f"column {c} is {t}, table has {table_types[c]}")
    if mode == "overwrite":
        missing = [c for c in current.columns if c not in df.columns]
        if missing:
            raise FeatureTableError(f"overwrite is missing columns {missing}")
        rows = df.select(*current.columns)
    else:
        fresh = f"{root}/new-{uuid.uuid4().hex}"
        df.write.mode("errorifexists").parquet(fresh)
        df = spark.read.schema(df.schema).parquet(fresh)
        check_keys(df, keys)
        rows = merge_rows(current, df, keys)
    target = f"{root}/v{version:05d}-{uuid.uuid4().hex[:12]}"
    spec = bucket_spec(spark, name)
    if spec:
        # Bucketed files are written through a temporary external table
        # (its entry is dropped; the files stay and become the new version).
        tmp = f"{name}__v{version:05d}_{uuid.uuid4().hex[:12]}"
        (rows.write.format("parquet").mode("errorifexists").bucketBy(spec[0], *spec[1])
             .sortBy(*spec[1]).option("path", target).saveAsTable(tmp))
        spark.sql(f"DROP TABLE {tmp}")
    else:
        rows.write.mode("errorifexists").parquet(target)
    if mode == "overwrite":
        check_keys(spark.read.schema(rows.schema).parquet(target), keys)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{target}'")
    spark.catalog.refreshTable(name)
    return target


def expire_versions(spark: SparkSession, name: str, keep: int = 1) -> int:
    """Delete all but the current folder and the ``keep`` newest older ones; returns how many went.

    Merged-in rows (``new-*``) and folders of failed writes go too. Call it when
    no reader is on an old version any more.
    """
    under = _manifest(spark, name)
    if under is not None:
        return under.expire(keep + 1)
    root = _props(spark, name)[PROP_ROOT]
    current = (table_location(spark, name) or "").rstrip("/").rpartition("/")[2]
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [f.getPath() for f in fs.listStatus(path)]
    old = [p for p in found if p.getName() != current]
    versions = sorted((p for p in old if p.getName().startswith("v")), key=lambda p: p.getName(), reverse=True)
    gone = [p for p in old if p not in versions[:keep]]
    for p in gone:
        fs.delete(p, True)
    return len(gone)


def _version(spark: SparkSession, name: str) -> int:
    """The number in the folder name of the table's current version."""
    m = re.search(r"/v(\d+)(-[0-9a-f]+)?/?$", table_location(spark, name) or "")
    return int(m[1]) if m else 0


def read_features(spark: SparkSession, name: str, for_keys: DataFrame | None = None) -> DataFrame:
    """The current rows of a feature table (or any table or path).

    With ``for_keys`` (rows that hold the key columns) a table under a manifest opens
    only what a lookup of these keys can meet.
    """
    under = _manifest(spark, name)
    if under is None:
        return read_table(spark, name)
    return under.read() if for_keys is None else under.read_for(for_keys)
