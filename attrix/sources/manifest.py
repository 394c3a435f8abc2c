"""Keyed feature tables whose merges rewrite only the key buckets they touch.

Rows lie in files by hash bucket of the primary key. A manifest names, per bucket,
the folder that holds its current rows; every commit is one numbered manifest file.
A merge reads the touched buckets, joins the new rows in, writes these
buckets to a folder of its own, and commits a manifest that differs from
the one before in these buckets only.

Commits are optimistic. The next manifest is written to a file of its own and
renamed to its number, which fails when that number is taken. The writer that
finds it taken looks at what was committed meanwhile: if other buckets changed, it
puts its own buckets on top and tries the next number; if its buckets changed as
well, it merges its rows into them again. So no merge is lost and none is half done.
Readers keep the manifest that they started with; old folders stay until ``expire``.

The rename is one step where the file system has it as one (HDFS); on a store that has
not, writers of one table must not run at once.

The manifest has one entry per bucket, a number fixed at creation, so what the driver
holds does not grow with the data.

Rows: keys must not be null or repeated in the rows of one write; rows that carry
only some feature columns keep the others (null for new keys).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrix.sources.features import FeatureTableError, check_keys, merge_rows

BUCKETS = 64
#: tries of one commit before it gives up
ATTEMPTS = 20
#: keys of a lookup that are listed in the scan's filter
LISTED = 1000
_BUCKET = "__bucket"
#: key types that a Bloom filter takes
_BLOOM = (T.StringType, T.BinaryType, T.IntegerType, T.LongType)


@dataclass(frozen=True)
class Manifest:
    version: int
    keys: tuple[str, ...]
    schema: T.StructType
    #: per bucket the folder of its rows under ``data``; None for an empty bucket
    folders: tuple[str | None, ...]


class _Files:
    """The table's folder through Hadoop's file system, which Spark's readers use as well."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark.sparkContext._jvm, root.rstrip("/")
        self.fs = self.path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        p = self.path(folder)
        return sorted(f.getPath().getName() for f in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        out = self.fs.create(self.path(name), False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def take(self, source: str, target: str) -> bool:
        """Rename ``source`` to ``target``; False when ``target`` is there already."""
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.fs.getConf())
        none = self.jvm.java.lang.reflect.Array.newInstance(
            self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            context.rename(self.path(source), self.path(target), none)
            return True
        except Py4JJavaError as e:
            if self.fs.exists(self.path(target)):
                return False
            raise e


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


class ManifestTable:
    """A feature table in the folder ``root``, see the module's text."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root.rstrip("/"), _Files(spark, root)

    @classmethod
    def create(cls, spark: SparkSession, root: str, keys: str | Sequence[str], schema: T.StructType,
               buckets: int = BUCKETS) -> ManifestTable:
        keys = (keys,) if isinstance(keys, str) else tuple(keys)
        missing = [k for k in keys if k not in schema.fieldNames()]
        if missing or not keys:
            raise FeatureTableError(f"key columns {missing or list(keys)} not in schema")
        if buckets < 1:
            raise FeatureTableError("a table needs at least one bucket")
        table = cls(spark, root)
        if not table._commit(Manifest(0, keys, schema, (None,) * buckets)):
            raise FeatureTableError(f"{root} is a feature table already")
        return table

    # --- reading ---

    def versions(self) -> list[int]:
        return [int(n[1:-5]) for n in self.files.names("manifest") if n.startswith("v") and n.endswith(".json")]

    def manifest(self, version: int | None = None) -> Manifest:
        found = self.versions()
        if not found or (version is not None and version not in found):
            raise FeatureTableError(f"{self.root} has no version {version if found else ''}".rstrip())
        at = max(found) if version is None else version
        d = json.loads(self.files.read(f"manifest/v{at:08d}.json"))
        return Manifest(at, tuple(d["keys"]), T.StructType.fromJson(d["schema"]), tuple(d["folders"]))

    def read(self, version: int | None = None) -> DataFrame:
        return self._rows(self.manifest(version))

    def _rows(self, m: Manifest, buckets: Sequence[int] | None = None) -> DataFrame:
        wanted = range(len(m.folders)) if buckets is None else buckets
        paths = [f"{self.root}/data/{m.folders[b]}/{_BUCKET}={b}" for b in wanted if m.folders[b]]
        if not paths:
            return self.spark.createDataFrame([], m.schema)
        return self.spark.read.schema(m.schema).parquet(*paths)

    def read_for(self, base: DataFrame, version: int | None = None) -> DataFrame:
        """The rows that a lookup of ``base``'s keys can meet, without reading the rest.

        Only the buckets of these keys are opened. Up to ``LISTED`` keys of a one-column key go
        to the scan as a list, where row groups go by their Bloom filters.
        """
        m = self.manifest(version)
        keys = base.select(*m.keys).na.drop()
        buckets = sorted(r["b"] for r in keys.select(bucket_of(m.keys, len(m.folders)).alias("b")).distinct().collect())
        rows = self._rows(m, buckets)
        if len(m.keys) == 1:
            few = [r[0] for r in keys.distinct().limit(LISTED + 1).collect()]
            if len(few) <= LISTED:
                rows = rows.where(F.col(m.keys[0]).isin(few))
        return rows

    # --- writing ---

    def merge(self, rows: DataFrame) -> Manifest:
        """Upsert ``rows`` by key."""
        m = self.manifest()
        self._check_columns(m, rows, whole=False)
        return self._write(rows, m, keep=True)

    def overwrite(self, rows: DataFrame) -> Manifest:
        """Replace the table's rows."""
        m = self.manifest()
        self._check_columns(m, rows, whole=True)
        return self._write(rows.select(*m.schema.fieldNames()), m, keep=False)

    def _write(self, rows: DataFrame, seen: Manifest, keep: bool) -> Manifest:
        buckets = len(seen.folders)
        # the new rows by bucket, once: merged again from here if a commit is lost
        fresh = self._store(rows, seen, "new")
        new = self.spark.read.schema(rows.schema).parquet(*[f"{self.root}/data/{fresh}/{_BUCKET}={b}" for b in self._held(fresh)]) \
            if self._held(fresh) else rows.limit(0)
        check_keys(new, seen.keys)
        touched = self._held(fresh) if keep else list(range(buckets))
        if not touched:
            return seen
        done: dict[int, str | None] = {}
        base: Manifest | None = None
        for _ in range(ATTEMPTS):
            now = self.manifest()
            # merge where this writer has no result yet, or where the rows under it have changed
            stale = [b for b in touched if base is None or (keep and now.folders[b] != base.folders[b])]
            if stale:
                done.update(self._merged(now, new, fresh, stale) if keep else self._replaced(fresh, stale))
            base = now
            folders = tuple(done.get(b, f) for b, f in enumerate(now.folders))
            after = Manifest(now.version + 1, now.keys, now.schema, folders)
            if self._commit(after):
                return after
        raise FeatureTableError(f"{ATTEMPTS} other commits came first")

    def _merged(self, now: Manifest, new: DataFrame, fresh: str, stale: list[int]) -> dict[int, str | None]:
        some = self.spark.read.schema(new.schema).parquet(*[f"{self.root}/data/{fresh}/{_BUCKET}={b}" for b in stale])
        folder = self._store(merge_rows(self._rows(now, stale), some, now.keys), now, "v")
        return dict.fromkeys(stale, folder)

    def _replaced(self, fresh: str, stale: list[int]) -> dict[int, str | None]:
        held = set(self._held(fresh))
        return {b: fresh if b in held else None for b in stale}

    def _store(self, rows: DataFrame, m: Manifest, kind: str) -> str:
        """Write ``rows`` by bucket to a folder of this attempt; its name."""
        name = f"{kind}-{uuid.uuid4().hex}"
        placed = rows.withColumn(_BUCKET, bucket_of(m.keys, len(m.folders)))
        # one shuffle by bucket: a bucket is a few files, however many tasks write
        out = placed.repartition(_BUCKET, F.pmod(F.xxhash64(*m.keys, F.lit(1)), F.lit(4))).write.mode("errorifexists")
        out = out.option("compression", "zstd").option("parquet.bloom.filter.adaptive.enabled", "true")
        for k in m.keys:
            if isinstance(m.schema[k].dataType, _BLOOM):
                out = out.option(f"parquet.bloom.filter.enabled#{k}", "true")
        out.partitionBy(_BUCKET).parquet(f"{self.root}/data/{name}")
        return name

    def _held(self, folder: str) -> list[int]:
        return sorted(int(n.split("=")[1]) for n in self.files.names(f"data/{folder}") if n.startswith(f"{_BUCKET}="))

    def _check_columns(self, m: Manifest, rows: DataFrame, whole: bool) -> None:
        types = {f.name: f.dataType for f in m.schema}
        for f in rows.schema:
            if f.name not in types:
                raise FeatureTableError(f"columns {[f.name]} are not in the feature table")
            if types[f.name] != f.dataType:
                raise FeatureTableError(f"column {f.name} is {f.dataType.simpleString()}, table has {types[f.name].simpleString()}")
        missing = [n for n in (types if whole else m.keys) if n not in rows.columns]
        if missing:
            raise FeatureTableError(f"the rows are missing columns {missing}")

    def _commit(self, m: Manifest) -> bool:
        """Make ``m`` the manifest of its number; False when another writer was first."""
        draft = f"manifest/draft-{uuid.uuid4().hex}"
        self.files.write(draft, json.dumps({"keys": list(m.keys), "schema": m.schema.jsonValue(), "folders": list(m.folders)}))
        if self.files.take(draft, f"manifest/v{m.version:08d}.json"):
            return True
        self.files.fs.delete(self.files.path(draft), False)
        return False

    def expire(self, keep: int = 2) -> int:
        """Delete the manifests but the ``keep`` newest, and folders that none of those names; returns how many folders went.

        Call it when no writer is at work and no reader is on an older version.
        """
        found = self.versions()
        kept = found[-keep:] if keep > 0 else found[-1:]
        used = {f for v in kept for f in self.manifest(v).folders if f}
        gone = [n for n in self.files.names("data") if n not in used]
        for v in found:
            if v not in kept:
                self.files.fs.delete(self.files.path(f"manifest/v{v:08d}.json"), False)
        for n in gone:
            self.files.fs.delete(self.files.path(f"data/{n}"), True)
        return len(gone)
