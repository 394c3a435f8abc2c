"""Operator 5: k-d tree partitioning of documents into shards of near-equal bytes.

Documents are points in metadata space. Starting with all of them, a node that
holds ``k`` leaves is cut along its widest dimension (its extent relative to the
whole table's) so that ``floor(k / 2) / k`` of its bytes lie on the left, until
every leaf is one shard, i.e. holds about the target bytes.

The cut is a distributed weighted median: a position is the dimension's value,
scaled to 28 bits, followed by 20 bits of a hash of the row's id, size, text and
metadata, which spreads equal values, and 14 bits of a hash of the row's number, which
spreads wholly equal rows. Bins end where content ends as long as more than one
content is in question, so shards do not depend on the layout of the files; only
which of wholly equal rows go where does. All nodes of a level are searched together by summing bytes per (node, bin) of
``BINS`` equal bins and descending into the bin that holds the cut, until that
bin weighs less than the tolerance. What reaches the driver is one row per node
and bin; what the rows get is a nested CASE over their own columns.

The law of this sharding is ``bytes``: sizes near equal. Only DataFrame
functions are used. Rows of equal texts are points like any others.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attrix.llm.common import stored

BINS = 1024
TOLERANCE = 0.002  # of a shard's bytes
OVERHEAD = 16
DIMENSIONS = ("doc_id", "size", "lang", "source")
_VALUE_BITS, _CONTENT_BITS, _ROW_BITS = 28, 20, 14
_TIE_BITS = _CONTENT_BITS + _ROW_BITS


@dataclass
class Node:
    first: int                  # first shard of the subtree
    leaves: int
    dim: str | None = None
    cut: int = 0                # positions below it go left
    left: Node | None = None
    right: Node | None = None

    def expr(self, keys: dict[str, Column]) -> Column:
        """The shard of a row (for a grown tree: of its open node)."""
        if self.left is None:
            return F.lit(self.first)
        return F.when(keys[self.dim] < F.lit(self.cut), self.left.expr(keys)).otherwise(self.right.expr(keys))

    def open_nodes(self) -> list[Node]:
        if self.left is None:
            return [self] if self.leaves > 1 else []
        return self.left.open_nodes() + self.right.open_nodes()


def _positions(rows: DataFrame, dims: list[str]) -> dict[str, Column]:
    """Per dimension a 62-bit position: scaled value, hash of the row's content, hash of its number."""
    ends = rows.agg(*(F.min(d).alias(f"lo_{d}") for d in dims), *(F.max(d).alias(f"hi_{d}") for d in dims)).first()
    content = F.xxhash64(*sorted({"size", "text_crc32", *dims})).bitwiseAND(F.lit((1 << _CONTENT_BITS) - 1))
    tie = F.shiftleft(content, _ROW_BITS) + F.xxhash64("row").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    out = {}
    for d in dims:
        lo, hi = float(ends[f"lo_{d}"] or 0), float(ends[f"hi_{d}"] or 0)
        share = (F.coalesce(F.col(d).cast("double"), F.lit(lo)) - lo) / (hi - lo) if hi > lo else F.lit(0.0)
        scaled = F.least(F.floor(share * float(1 << _VALUE_BITS)), F.lit((1 << _VALUE_BITS) - 1)).cast("long")
        out[d] = F.shiftleft(scaled, _TIE_BITS) + tie
    return out


def _width(span: int, bins: int) -> int:
    """Bins of whole contents while the span has more than one, then of positions."""
    unit = 1 << _ROW_BITS if span > 1 << _ROW_BITS else 1
    return -(-span // (bins * unit)) * unit


def build_tree(rows: DataFrame, dims: list[str], shards: int, bins: int = BINS, tolerance: float = TOLERANCE) -> tuple[Node, dict[str, Column]]:
    """The tree over ``rows`` (row, size, text_crc32 and the dimensions) and the rows' positions."""
    keys = _positions(rows, dims)
    top = Node(0, shards)
    while level := top.open_nodes():
        owner = top.expr(keys).alias("node")
        ranges = {r["node"]: r for r in rows.groupBy(owner).agg(
            F.sum("size").alias("bytes"), *(F.min(k).alias(f"lo_{d}") for d, k in keys.items()),
            *(F.max(k).alias(f"hi_{d}") for d, k in keys.items())).collect()}  # one row per node
        live = {}
        for node in level:
            r = ranges.get(node.first)
            half = node.leaves // 2
            if r is None:  # no rows: any cut will do
                node.dim, node.cut = dims[0], 0
            else:
                node.dim = max(dims, key=lambda d: (r[f"hi_{d}"] >> _TIE_BITS) - (r[f"lo_{d}"] >> _TIE_BITS))
                want = r["bytes"] * half / node.leaves
                same = (1 << _ROW_BITS) - 1  # from the start of the first content to the end of the last
                live[node.first] = [r[f"lo_{node.dim}"] & ~same, (r[f"hi_{node.dim}"] | same) + 1, 0, want, r["bytes"] / node.leaves, node]
        while live:
            width = {k: _width(v[1] - v[0], bins) for k, v in live.items()}
            asked = rows.sparkSession.range(1).select(F.inline(F.array(*(
                F.struct(F.lit(k).alias("node"), F.lit(v[5].dim).alias("dim"), F.lit(v[0]).cast("long").alias("low"),
                         F.lit(v[1]).cast("long").alias("high"), F.lit(width[k]).cast("long").alias("step"))
                for k, v in live.items()))))  # one row per open node
            value = F.coalesce(*(F.when(F.col("dim") == d, k) for d, k in keys.items()))
            found = (rows.withColumn("node", top.expr(keys)).join(F.broadcast(asked), "node").withColumn("at", value)
                     .where("at >= low AND at < high").groupBy("node", F.expr("(at - low) div step").alias("bin"))
                     .agg(F.sum("size").alias("bytes")))
            sums: dict[int, dict[int, int]] = {}
            for r in found.collect():  # at most one row per open node and bin
                sums.setdefault(r["node"], {})[r["bin"]] = r["bytes"]
            for k in list(live):
                lo, hi, before, want, shard, n = live[k]
                at, total = 0, before
                for b, size in sorted(sums.get(k, {}).items()):
                    at = b
                    if total + size > want:
                        break
                    total += size
                start = lo + at * width[k]
                end = min(hi, start + width[k])
                size = sums.get(k, {}).get(at, 0)
                if width[k] == 1 or size <= tolerance * shard:
                    # the bin's nearer edge
                    n.cut = start if want - total <= total + size - want else end
                    del live[k]
                else:
                    live[k][:3] = [start, end, total]
        for node in level:
            half = node.leaves // 2
            node.left, node.right = Node(node.first, half), Node(node.first + half, node.leaves - half)
    return top, keys


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None,
              id_col: str = "doc_id", text_col: str = "text", metadata: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row.

    ``size``: UTF-8 bytes of the text (null: none) plus 16. Give the number of
    shards or the bytes a shard should hold. Null metadata and ids count as the
    smallest value of their dimension; string metadata is placed by its hash.
    Repeated rows are points of their own. A document larger than a shard's
    share makes that shard larger; an empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = stored(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
        *(F.xxhash64(F.col(m).cast("string")).alias(m) for m in metadata),
        F.monotonically_increasing_id().alias("row")), "kd-rows")
    if shards is None:
        total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
        shards = max(1, -(-total // target_bytes))
    tree, keys = build_tree(rows, ["doc_id", "size", *metadata], shards)
    # a row's number has the writing task in its upper bits: rows are counted per
    # task and shard, so a slot needs no order over a whole shard
    placed = rows.select("doc_id", "size", "text_crc32", "row", tree.expr(keys).cast("int").alias("shard"),
                         F.shiftright("row", 33).alias("task"))
    before = Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = (placed.groupBy("shard", "task").agg(F.count(F.lit(1)).alias("n"))
              .select("shard", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    inside = Window.partitionBy("shard", "task").orderBy("row")
    return (placed.join(counts, ["shard", "task"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("base") + F.row_number().over(inside) - 1).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
