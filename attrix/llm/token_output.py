"""Operator 9: token ids as Parquet list columns.

Texts are encoded, ordered by document id with a range exchange of the ids, and
written by the tasks as Parquet files of one row per document: ``doc_id``,
``n_tokens`` and the list column ``ids``. The writer controls what readers can
skip: row groups of about ``group_tokens`` ids, small data pages, page indexes
and statistics, dictionary or delta encoding of the id column. Readers can take
the metadata columns alone or some documents' ids alone (``read_documents``).

Every task writes under a name of its own attempt and reports it; only reported
files belong to the table (``manifest``), so a lost or repeated task leaves no
trace in the result. Files go to the shared scratch folder or to ``target``.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attrix.llm.common import stored, text_batches
from attrix.llm.encoding import encoder
from attrix.session import scratch_path

GROUP_TOKENS = 1 << 20
PAGE_BYTES = 64 << 10
_FILE = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])


def encoded(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the ids of each row's whole text and the end id, as little-endian 16 or 32-bit integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        end = np.array([end_id], dtype="<u4").tobytes()
        for (ids,), texts in text_batches(batches, ["doc_id"], "text"):
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([narrow(enc.encode(t) + end) for t in texts], pa.binary())],
                names=["doc_id", "ids"])
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, ids binary")


def narrow(ids: bytes) -> bytes:
    """Half the bytes while all ids fit into 16 bits; the first byte tells which."""
    wide = np.frombuffer(ids, dtype="<u4")
    if len(wide) and wide.max() >= 1 << 16:
        return b"\4" + ids
    return b"\2" + wide.astype("<u2").tobytes()


def widen(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, dtype="<u2" if packed[:1] == b"\2" else "<u4", offset=1).astype("<u4")


def _writer(root: str, encoding: str, group_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = pa.fs.FileSystem.from_uri(root)
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.parquet"
        out = stream = None
        held, size = [], 0
        docs = tokens = 0
        first = None

        def flush() -> None:
            nonlocal out, stream, size
            ids = [widen(p) for _, p in held]
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
            lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids).astype(np.int32)))
            if out is None:
                fs.create_dir(folder, recursive=True)
                stream = fs.open_output_stream(f"{folder}/{name}")
                out = pq.ParquetWriter(
                    stream, _FILE, compression="zstd", write_page_index=True,
                    write_statistics=True, data_page_size=PAGE_BYTES, store_schema=False,
                    use_dictionary=["ids.list.element"] if encoding == "dictionary" else False,
                    column_encoding=None if encoding == "dictionary" else {
                        "doc_id": "DELTA_BINARY_PACKED", "n_tokens": "DELTA_BINARY_PACKED",
                        "ids.list.element": "DELTA_BINARY_PACKED"})
            out.write_table(pa.table([pa.array([d for d, _ in held], pa.int64()), pa.array(np.diff(offsets), pa.int64()),
                                      lists], schema=_FILE), row_group_size=len(held))
            held.clear()
            size = 0

        for b in batches:
            for doc, packed in zip(b.column("doc_id").to_pylist(), b.column("ids").to_pylist()):
                n = (len(packed) - 1) // (2 if packed[:1] == b"\2" else 4)
                first = doc if not docs else first
                docs, tokens, size = docs + 1, tokens + n, size + n
                held.append((doc, packed))
                if size >= group_tokens:
                    flush()
        if held:
            flush()
        if out is not None:
            out.close()
            stream.close()
        if docs:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([name]), pa.array([first], pa.int64()),
                 pa.array([docs], pa.int64()), pa.array([tokens], pa.int64())],
                names=["part", "name", "first_doc", "docs", "tokens"])
    return run


@dataclass
class TokenTable:
    """Written files: ``root`` and the manifest (part, name, first_doc, docs, tokens, start)."""

    root: str
    manifest: DataFrame


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int, encoding: str = "dictionary",
                 group_tokens: int = GROUP_TOKENS, target: str | None = None) -> TokenTable:
    """Encode all rows and write them in ascending ``doc_id`` order.

    Null and empty texts are documents of the end id alone; rows with equal ids
    are all written, ordered by their ids' bytes; a null id sorts first; an
    empty table writes no file. ``encoding`` is "dictionary" or "delta".
    """
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"unknown encoding {encoding!r}")
    spark = docs.sparkSession
    root = target or scratch_path(spark, "tokens")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (stored(encoded(docs, tokenizer, end_id), "token-ids").withColumn("tie", F.crc32("ids"))
               .repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "ids").select("doc_id", "ids"))
    files = stored(ordered.mapInArrow(_writer(root, encoding, group_tokens),
                                      "part int, name string, first_doc long, docs long, tokens long"), "token-manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return TokenTable(root, files.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0))))


def read_back(table: TokenTable) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, from the files alone."""
    root = table.root

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = pa.fs.FileSystem.from_uri(root)
        for b in batches:
            for name, start in zip(b.column("name").to_pylist(), b.column("start").to_pylist()):
                with fs.open_input_file(f"{folder}/{name}") as f:
                    reader = pq.ParquetFile(f)
                    for group in range(reader.num_row_groups):
                        t = reader.read_row_group(group).combine_chunks()
                        lists = t.column("ids").chunk(0)
                        ids = lists.flatten().to_numpy().astype("<u4")
                        ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
                        yield pa.RecordBatch.from_arrays(
                            [t.column("doc_id").chunk(0), pa.array(start + ends[:-1].astype(np.int64)),
                             pa.array(np.diff(ends).astype(np.int64)),
                             pa.array([zlib.crc32(ids[a:z].tobytes()) for a, z in zip(ends, ends[1:])], pa.int64())],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"])
                        start += int(ends[-1])
    n = max(1, table.manifest.count())
    return (table.manifest.select("name", "start").repartition(n, "name")
            .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def read_documents(spark: SparkSession, table: TokenTable, doc_ids: list[int] | None = None,
                   columns: tuple[str, ...] = ("doc_id", "n_tokens", "ids")) -> DataFrame:
    """The stated columns of some documents (all if none are stated). The filter
    reaches row-group statistics and page indexes, the columns the scan."""
    paths = [f"{table.root}/{r['name']}" for r in table.manifest.select("name").collect()]
    df = spark.read.schema("doc_id long, n_tokens long, ids array<int>").parquet(*paths) if paths else \
        spark.createDataFrame([], "doc_id long, n_tokens long, ids array<int>")
    return (df if doc_ids is None else df.where(F.col("doc_id").isin(doc_ids))).select(*columns)
