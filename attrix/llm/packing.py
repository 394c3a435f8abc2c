"""Operator 8: cost-balanced packing of documents into token sequences.

A piece of ``n`` tokens costs ``linear * n + quadratic * n * n`` (attention
within the piece). Texts are encoded where they lie; each document's full
sequences of ``capacity`` tokens are pieces of their own already, and its tail
is packed with others: tails are dealt evenly into groups of about ``GROUP``,
and in each group they go, in descending order, to the sequence of the lowest
cost that still has room, out of as many as the group's tokens need. A tail
that fits nowhere whole is cut to fill the room that is left, so that a group
pads less than one sequence in all.

Tails carry their ids through the shuffle (16 bits each while they fit), full
sequences do not move. Groups are dealt by a number that each tail got when it
was written, so copies or a long document never meet in one group by design.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrix.llm.common import stored, text_batches
from attrix.llm.encoding import encoder
from attrix.llm.token_output import narrow, widen

CAPACITY = 1024
GROUP = 2048
LINEAR, QUADRATIC = 1.0, 1 / 1024

_PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, ids binary")
_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]


def _cut(tokenizer: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(tokenizer), np.array([end_id], dtype="<u4").tobytes()
        number = TaskContext.get().partitionId() << 33
        for (docs,), texts in text_batches(batches, ["doc_id"], "text"):
            rows = []
            for doc, text in zip(docs, texts):
                ids = enc.encode(text) + end
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    part = ids[4 * start:4 * (start + capacity)]
                    rows.append((doc, start, len(part) // 4, zlib.crc32(part), total,
                                 2 * number + 1 if len(part) == 4 * capacity else None, number, narrow(part)))
                    number += 1
            cols = list(zip(*rows)) if rows else [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols[:7]] + [pa.array(cols[7], pa.binary())],
                                             names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "full", "number", "ids"])
    return run


def balance(lengths: np.ndarray, capacity: int, linear: float, quadratic: float) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (document, start, length).

    Documents in descending order, each to the sequence of the lowest cost with
    room for it; what fits nowhere whole is cut to fill the sequences, again
    from the lowest cost up.
    """
    count = max(1, -(-int(lengths.sum()) // capacity))
    room = np.full(count, capacity, dtype=np.int64)
    cost = np.zeros(count)
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(count)]

    def put(seq: int, doc: int, start: int, n: int) -> None:
        out[seq].append((doc, start, n))
        room[seq] -= n
        cost[seq] += linear * n + quadratic * n * n

    left = []
    for doc in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[doc])
        seq = int(np.where(room >= n, cost, np.inf).argmin())
        if room[seq] >= n:
            put(seq, doc, 0, n)
        else:
            left.append(doc)
    for doc in left:
        start, n = 0, int(lengths[doc])
        while start < n:
            seq = int(np.where(room > 0, cost, np.inf).argmin())
            take = min(int(room[seq]), n - start)
            put(seq, doc, start, take)
            start += take
    return [s for s in out if s]


def _pack(capacity: int, linear: float, quadratic: float):
    def run(key, table):
        doc, start, total, packed = (table.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids"))
        order = sorted(range(len(doc)), key=lambda i: (-len(packed[i]), packed[i], start[i], doc[i] is None, doc[i] or 0))
        ids = [widen(packed[i]) for i in order]
        rows = []
        for s, pieces in enumerate(balance(np.array([len(x) for x in ids]), capacity, linear, quadratic)):
            offset = 0
            for k, a, n in pieces:
                i, part = order[k], ids[k][a:a + n].tobytes()
                rows.append((doc[i], start[i] + a, n, zlib.crc32(part), total[i],
                             2 * ((key[0].as_py() << 20) + s), offset, narrow(part)))
                offset += n
        cols = list(zip(*rows)) if rows else [[]] * 8
        return pa.table([pa.array(c, pa.int64()) for c in cols[:7]] + [pa.array(cols[7], pa.binary())], names=_NAMES)
    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, group: int = GROUP,
         linear: float = LINEAR, quadratic: float = QUADRATIC, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    ``ids`` holds the piece's token ids (``token_output.widen`` reads them).
    A null or empty text is a document of the end id alone; repeated rows and
    rows with a null id are packed like any other; an empty table gives no
    piece. Other columns are ignored.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    cut = stored(src.mapInArrow(_cut(tokenizer, end_id, capacity),
                                "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                                "full long, number long, ids binary"), "pieces")
    tails = cut.where("full IS NULL")
    groups = max(1, -(-tails.count() // group))
    packed = (tails.withColumn("grp", F.pmod(F.xxhash64("number"), F.lit(groups)))
              .select("grp", "doc_id", "start", "doc_tokens", "ids")
              .groupBy("grp").applyInArrow(_pack(capacity, linear, quadratic), _PIECE))
    whole = cut.where("full IS NOT NULL").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", F.col("full").alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"), "ids")
    return whole.unionByName(packed)


def sequences(pieces: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """(sequence_id, n_tokens, padded_length, ids): the padded token sequences.

    A sequence is padded to ``capacity`` unless its length is a power of two.
    """
    def run(key, table):
        rows = sorted(zip(table.column("offset").to_pylist(), table.column("ids").to_pylist()))
        ids = np.concatenate([widen(p) for _, p in rows])
        n = len(ids)
        to = n if n & (n - 1) == 0 else capacity
        return pa.table({"sequence_id": pa.array([key[0].as_py()], pa.int64()), "n_tokens": pa.array([n], pa.int64()),
                         "padded_length": pa.array([to], pa.int64()),
                         "ids": pa.array([np.pad(ids, (0, to - n), constant_values=pad_id).astype(np.int32)], pa.list_(pa.int32()))})
    return pieces.groupBy("sequence_id").applyInArrow(
        run, "sequence_id long, n_tokens long, padded_length long, ids array<int>")
