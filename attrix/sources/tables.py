"""Catalog tables: databases, reads and writes.

A table is addressed by a catalog name (``db.t``) or by a path. Writes are
Parquet (no Delta in this environment). Write modes follow Spark's:
``errorifexists`` (the default of ``saveAsTable``) and ``overwrite``.

Overwriting a table that the written plan itself reads would delete the
input files before the job has read them, so such writes are refused here;
``attrix.sources.features`` writes merges to a fresh folder and then swaps.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

FORMAT = "parquet"


def is_path(name: str) -> bool:
    return "/" in name or ":" in name


def read_table(spark: SparkSession, name: str) -> DataFrame:
    if is_path(name):
        return spark.read.parquet(name)
    return spark.read.table(name)


def table_exists(spark: SparkSession, name: str) -> bool:
    if is_path(name):
        jvm = spark.sparkContext._jvm
        jsc = spark.sparkContext._jsc
        p = jvm.org.apache.hadoop.fs.Path(name)
        fs = p.getFileSystem(jsc.hadoopConfiguration())
        return bool(fs.exists(p))
    return spark.catalog.tableExists(name)


def table_location(spark: SparkSession, name: str) -> str | None:
    if is_path(name):
        return name
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def _norm(path: str) -> str:
    return re.sub(r"^file:/*", "/", path).rstrip("/")


def _guard_self_overwrite(df: DataFrame, spark: SparkSession, name: str) -> None:
    loc = table_location(spark, name) if table_exists(spark, name) else None
    if not loc:
        return
    loc = _norm(loc)
    for root in _plan_roots(df):
        if root == loc or root.startswith(loc + "/") or loc.startswith(root + "/"):
            raise ValueError(f"refusing to overwrite {name}: the written plan reads it")


def _plan_roots(df: DataFrame) -> list[str]:
    """Root paths of the file relations in the plan (a few strings, not the list of files)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    roots = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if "LogicalRelation" not in leaf.getClass().getSimpleName():
            continue
        relation = leaf.relation()
        if hasattr(relation, "location") and "HadoopFsRelation" in relation.getClass().getSimpleName():
            paths = relation.location().rootPaths()
            roots += [_norm(paths.apply(k).toString()) for k in range(paths.size())]
    return roots


def write_table(df: DataFrame, name: str, mode: str = "errorifexists",
                path: str | None = None, partition_by: list[str] | None = None,
                bucket_by: tuple[int, list[str]] | None = None) -> None:
    """Save ``df`` as a table (catalog name) or Parquet folder (path).

    ``path`` with a catalog name makes an external table at that location.
    ``bucket_by=(n, keys)`` (catalog tables only) hash-buckets and sorts the
    files by ``keys``: two tables bucketed alike on the join key are then
    joined without a shuffle on either side.
    """
    spark = df.sparkSession
    if mode == "overwrite":
        _guard_self_overwrite(df, spark, name)
    w = df.write.format(FORMAT).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if is_path(name):
        if bucket_by:
            raise ValueError("bucketing needs a catalog table name")
        w.save(name)
        return
    if bucket_by:
        n, keys = bucket_by
        w = w.bucketBy(n, *keys).sortBy(*keys)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def bucket_spec(spark: SparkSession, name: str) -> tuple[int, list[str]] | None:
    """(number of buckets, bucket columns) of a catalog table, if bucketed."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    info = {r["col_name"]: r["data_type"] for r in rows}
    if "Num Buckets" not in info:
        return None
    cols = [c.strip().strip("`") for c in info["Bucket Columns"].strip("[]").split(",")]
    return int(info["Num Buckets"]), cols


# --- databases and catalog -------------------------------------------------

def create_database(spark: SparkSession, db: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{loc}")


def use_database(spark: SparkSession, db: str) -> None:
    spark.catalog.setCurrentDatabase(db)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def current_catalog_and_database(spark: SparkSession) -> tuple[str, str]:
    return spark.catalog.currentCatalog(), spark.catalog.currentDatabase()


def list_tables(spark: SparkSession, db: str | None = None) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(db))
