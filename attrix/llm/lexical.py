"""Ranked lexical search over bags: identical documents are scored once.

1. The vocabulary of the items is the only one that can score. Every document is
   read whole once and reduced to its bag: the number of its terms, and how often
   it has each term of the vocabulary, by 64-bit term key.
2. Documents whose bag and length part ``m`` are equal form a class. Classes are
   grouped by hash, and the bag itself is part of the grouping key, so equal hashes
   are verified.
3. Each class is scored once against the items. Tasks keep the best ``top`` classes
   of each item by (score, smallest doc_id), and these are merged.
4. The winners are expanded to their members by ascending doc_id. Of one class no
   more than ``top`` members can be wanted, and the best documents of an item always
   lie in its best ``top`` classes: each class before another holds a document
   that comes before all of the other's.

The score is integer arithmetic, see ``impact`` and ``weighted``. Document
frequencies count classes by their sizes, over all documents.

The vocabulary and the items' postings go to the tasks in slices of at most
``SLICE`` entries, counted before anything is collected. With one vocabulary slice a
document's bag is whole at once; with more, the documents are written with a row
number, read once per slice, and their parts joined by it. With more item slices
the classes are scored slice by slice.

Rows: a document without terms (null or empty text) is no document. Repeated
rows are documents of their own. Null doc_ids come after all others. Rows of the
items that are wholly equal count once; rows that share an item_id (null included) are
one item with the terms of all its texts. An item without terms, or with none that a
document has, returns nothing. Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attrix.llm.common import stored

#: documents per item
TOP = 20
#: vocabulary terms, or item postings, that go to a task at once
SLICE = 400_000
#: classes that are scored together
BATCH = 1024
#: 64-bit integers of one scoring table
CELLS = 1 << 22

#: ASCII letters lower-cased, digits and all bytes of other characters kept, the rest blank
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
              for b in range(256))

_BAG = "array<struct<t:bigint,tf:bigint>>"


def terms_of(text: str | None) -> list[bytes]:
    """Maximal runs of letters, digits and non-ASCII characters, A-Z lower-cased."""
    return text.encode().translate(_FOLD).split() if text else []


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[tuple] = []
        for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
            rows += [(item, t, n) for t, n in Counter(terms_of(text)).items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()),
             pa.array([r[2] for r in rows], pa.int64())], names=["item_id", "term", "n"])


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, t, n): how often each item has each term; ``t`` names the term in 64 bits."""
    found = (items.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
             .mapInArrow(_item_terms, "item_id long, term binary, n long")
             .groupBy("item_id", "term").agg(F.sum("n").alias("n")))
    found = stored(found, "search-items")
    seed = 0
    while True:
        keyed = found.withColumn("t", F.xxhash64(F.lit(seed), "term"))
        n, keys = keyed.agg(F.count_distinct("term"), F.count_distinct("t")).first()
        if n == keys:
            return keyed
        seed += 1  # two terms of the vocabulary share a key: another hash


def _bag_reader(vocabulary: dict[bytes, int]) -> Callable:
    """Rows (row, doc_id, text) -> (row, doc_id, n, bag sorted by term key)."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = vocabulary.get
        for batch in batches:
            sizes, offsets, keys, counts = [], [0], [], []
            for text in batch.column("text"):
                words = terms_of(text.as_py())
                sizes.append(len(words))
                bag = sorted((k, c) for w, c in Counter(words).items() if (k := get(w)) is not None)
                keys += [k for k, _ in bag]
                counts += [c for _, c in bag]
                offsets.append(len(keys))
            entries = pa.StructArray.from_arrays([pa.array(keys, pa.int64()), pa.array(counts, pa.int64())], ["t", "tf"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), entries)], names=["row", "doc_id", "n", "bag"])
    return read


def bags(docs: DataFrame, terms: DataFrame, limit: int = SLICE) -> DataFrame:
    """(doc_id, n, bag) of every document with at least one term."""
    vocabulary = terms.select("term", "t").distinct()
    slices = max(1, -(-vocabulary.count() // limit))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.where("text IS NOT NULL")
    if slices > 1:
        rows = stored(rows, "search-rows")
    parts = []
    for i in range(slices):
        part = vocabulary.where(F.pmod("t", F.lit(slices)) == i)
        known = {bytes(r["term"]): r["t"] for r in part.toLocalIterator()}
        parts.append(rows.mapInArrow(_bag_reader(known), f"row long, doc_id long, n long, bag {_BAG}").where("n > 0"))
    whole = parts[0]
    if slices > 1:
        for p in parts[1:]:
            whole = whole.unionByName(p)
        whole = whole.groupBy("row", "doc_id", "n").agg(F.sort_array(F.flatten(F.collect_list("bag"))).alias("bag"))
    return stored(whole.select("doc_id", "n", "bag"), "search-bags")


def length_part(docs: int, length: int) -> Column:
    """``m`` of a document of ``n`` terms: 75, and 25 parts of its length against the mean."""
    return F.expr(f"CAST(75 + ({25 * docs}L * n) div {length}L AS BIGINT)")


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def weighted(terms: DataFrame, classes: DataFrame, docs: int) -> DataFrame:
    """(item_id, t, value): how often the item has the term, times the term's weight."""
    df = (classes.select("members", F.explode("bag").alias("e")).groupBy(F.col("e.t").alias("t"))
          .agg(F.sum("members").alias("df")))
    w = F.floor(F.lit(1000.0) * F.ln(F.lit(2.0 * docs + 2.0) / (2.0 * F.col("df") + 1.0)))
    return terms.join(df, "t").select("item_id", "t", (F.col("n") * w).cast("long").alias("value"))


def _scorer(items: list[int | None], postings: dict[int, tuple[np.ndarray, np.ndarray]], top: int) -> Callable:
    """Classes (cid, lead, m, bag) -> the task's best classes of every item."""
    def best(cid: np.ndarray, lead: np.ndarray, score: np.ndarray) -> np.ndarray:
        return np.lexsort((cid, lead, -score))[:top]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.empty(0, np.int64),) * 3 for _ in items]
        step = max(1, min(BATCH, CELLS // max(1, len(items))))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                cid, lead, m = (part.column(c).to_numpy(zero_copy_only=False) for c in ("cid", "lead", "m"))
                bag = part.column("bag")
                ends = bag.offsets.to_numpy() - bag.offsets[0].as_py()
                entries = bag.flatten()
                t = entries.field("t").to_numpy(zero_copy_only=False)
                owner = np.repeat(np.arange(part.num_rows), np.diff(ends))
                value = impact(entries.field("tf").to_numpy(zero_copy_only=False), m[owner])
                table = np.zeros((len(items), part.num_rows), np.int64)
                order = np.argsort(t, kind="stable")
                cuts = np.flatnonzero(np.diff(t[order], prepend=t[order[:1]] - 1))
                for a, b in zip(cuts, [*cuts[1:], len(order)]):
                    hit = postings.get(int(t[order[a]]))
                    if hit is not None:
                        at = order[a:b]
                        table[np.ix_(hit[0], owner[at])] += np.outer(hit[1], value[at])
                for i, (c0, l0, s0) in enumerate(kept):
                    row = table[i]
                    floor = s0[-1] if len(s0) == top else 1
                    on = np.flatnonzero(row >= max(1, floor))
                    if len(on):
                        c, lo, s = np.r_[c0, cid[on]], np.r_[l0, lead[on]], np.r_[s0, row[on]]
                        pick = best(c, lo, s)
                        kept[i] = c[pick], lo[pick], s[pick]
        ids = np.repeat(np.arange(len(items)), [len(k[0]) for k in kept])
        yield pa.RecordBatch.from_arrays(
            [pa.array([items[i] for i in ids], pa.int64()),
             *(pa.array(np.concatenate([k[j] for k in kept]) if kept else np.empty(0, np.int64)) for j in range(3))],
            names=["item_id", "cid", "lead", "score"])
    return run


_LAST = (1 << 63) - 1


def search(docs: DataFrame, items: DataFrame, top: int = TOP, limit: int = SLICE) -> DataFrame:
    """(item_id, rank, doc_id, score): every item's ``top`` documents, best first."""
    terms = item_terms(items)
    found = bags(docs, terms, limit)
    count, length = found.agg(F.count(F.lit(1)), F.sum("n")).first()
    sized = found.where(F.size("bag") > 0).select("doc_id", length_part(count, length or 1).alias("m"), "bag")
    sized = sized.withColumn("h", F.xxhash64("m", "bag"))
    lead = F.min(F.coalesce("doc_id", F.lit(_LAST))).alias("lead")
    classes = stored(sized.groupBy("h", "m", "bag").agg(F.count(F.lit(1)).alias("members"), lead)
                     .withColumn("cid", F.monotonically_increasing_id()), "search-classes")
    postings = stored(weighted(terms, classes, count).where("value > 0"), "search-postings")

    slices = max(1, -(-postings.count() // limit))
    scored = None
    for i in range(slices):
        part = postings.where(F.pmod(F.xxhash64("item_id"), F.lit(slices)) == i)
        run = _scorer(*_postings(part), top)
        got = classes.select("cid", "lead", "m", "bag").mapInArrow(run, "item_id long, cid long, lead long, score long")
        scored = got if scored is None else scored.unionByName(got)
    line = Window.partitionBy("item_id").orderBy(F.desc("score"), "lead", "cid")
    winners = stored(scored.withColumn("r", F.row_number().over(line)).where(F.col("r") <= top)
                     .select("item_id", "cid", "score"), "search-winners")

    wanted = winners.select("cid").distinct().join(classes.select("cid", "h", "m", "bag"), "cid")
    members = sized.join(wanted, ["h", "m", "bag"]).select("cid", "doc_id")
    first = Window.partitionBy("cid").orderBy(F.asc_nulls_last("doc_id"))
    members = members.withColumn("k", F.row_number().over(first)).where(F.col("k") <= top)
    final = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (winners.join(members, "cid").withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= top)
            .select("item_id", "rank", "doc_id", "score"))


def _postings(part: DataFrame) -> tuple[list[int | None], dict[int, tuple[np.ndarray, np.ndarray]]]:
    """One slice's items, and by term their places and values; at most some ``SLICE`` rows."""
    rows = list(part.toLocalIterator())
    items = sorted({r["item_id"] for r in rows}, key=lambda i: (i is None, i))
    place = {item: k for k, item in enumerate(items)}
    by_term: dict[int, list[tuple[int, int]]] = {}
    for r in rows:
        by_term.setdefault(r["t"], []).append((place[r["item_id"]], r["value"]))
    return items, {t: (np.array([i for i, _ in e]), np.array([v for _, v in e], np.int64)) for t, e in by_term.items()}
