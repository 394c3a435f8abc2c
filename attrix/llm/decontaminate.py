"""Operator 2: benchmark decontamination by BM25 retrieval and overlap checks.

The benchmark items are the indexed side, the training texts the queries:

1. *Index.* Items become posting lists of BM25 impacts (``k1``, ``b``), divided
   by the item's score for itself, so 1.0 means that all of the item is there.
   Items are ordered by length and cut into blocks of ``BLOCK``; per term the
   index holds its largest impact in any block (the block maxima) and overall.
   The index is built from the benchmark alone; its size is checked against
   ``max_index_bytes`` before it is broadcast, beyond that the build refuses.
2. *Passages.* Every text is cut into windows of ``2 w`` words that advance by
   ``w``, ``w`` being the longest item, so every item fits into some window
   whole. A text's last window ends with the text.
3. *Block-max WAND.* The commonest terms, as long as they add at most
   ``COMMON`` to any item's score, are not essential: their largest sum per block
   is kept instead. Per window the block maxima of its other terms plus that sum
   bound each block; blocks below the threshold are skipped, and only the items
   of the remaining blocks are scored in full. All items that reach the
   threshold are retrieved, none is cut off.
4. *Verification.* A retrieved item's text is cut into question (all but the
   last sentence, or the first two thirds of the words if there is only one)
   and answer (the rest). A pair counts if at least ``question_share`` of the
   question's word trigrams and ``answer_share`` of the answer's occur in the
   window, each with its multiplicity (shorter parts: the whole sequence).

Words are maximal runs of letters and digits, lower case. Bounds and scores of
a slice of windows are computed with numpy, so memory follows the slice.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrix.llm.common import text_batches
from attrix.llm.encoding import release
from attrix.llm.shingles import distinct

K1, B = 1.2, 0.75
BLOCK = 4
#: bounds held at once, in windows times blocks
CELLS = 1 << 21
THRESHOLD = 0.5
COMMON = 0.25
QUESTION_SHARE, ANSWER_SHARE = 0.7, 0.7
MAX_INDEX_BYTES = 256 << 20
_WORD = re.compile(r"[^\W_]+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    parts = [w for w in map(words_of, _SENTENCE.split(text.strip())) if w]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    words = parts[0] if parts else []
    cut = -(-2 * len(words) // 3)
    return words[:cut], words[cut:]


def grams(words: list[str]) -> Counter:
    if not words:
        return Counter()
    k = min(3, len(words))
    return Counter(tuple(words[i:i + k]) for i in range(len(words) - k + 1))


def share_found(part: list[str], window: list[str]) -> float:
    want = grams(part)
    if not want:
        return 1.0
    k = len(next(iter(want)))
    have = Counter(tuple(window[i:i + k]) for i in range(len(window) - k + 1))
    return sum(min(n, have[g]) for g, n in want.items()) / sum(want.values())


@dataclass
class Index:
    items: list[int]                 # item ids, in index order
    parts: list[tuple[list[str], list[str]]]
    terms: dict[str, int]
    impact: list[tuple[np.ndarray, np.ndarray]]  # term -> (items, impacts)
    block_max: np.ndarray            # term x block
    most: np.ndarray                 # term -> largest impact
    rare: np.ndarray                 # term -> not one of the common words
    slack: np.ndarray                # block -> what common words alone can add to an item of it
    ends: np.ndarray                 # block lists of the terms: ends[t] to ends[t + 1]
    blocks: np.ndarray
    maxima: np.ndarray
    step: int

    def nbytes(self) -> int:
        return (self.block_max.nbytes + self.most.nbytes + sum(a.nbytes + b.nbytes for a, b in self.impact)
                + sum(len(t) + 60 for t in self.terms) + sum(60 * (len(q) + len(a)) for q, a in self.parts))


def build_index(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                max_index_bytes: int = MAX_INDEX_BYTES) -> Index | None:
    """The impact index of all items; None if there are no items with words.

    Items without words are ignored; equal items are all kept. Refuses a
    benchmark whose texts or index exceed ``max_index_bytes``.
    """
    src = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    size = src.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    if size > max_index_bytes:
        raise ValueError(f"the benchmark has {size} bytes of text, more than max_index_bytes={max_index_bytes}")
    rows = sorted(((len(words_of(t)), i if i is not None else -1, t) for i, t in src.collect()))
    rows = [r for r in rows if r[0]]
    if not rows:
        return None
    texts = [words_of(t) for _, _, t in rows]
    mean = sum(map(len, texts)) / len(texts)
    holders = Counter(w for t in texts for w in set(t))
    idf = {w: float(np.log1p((len(texts) - n + 0.5) / (n + 0.5))) for w, n in holders.items()}
    terms = {w: k for k, w in enumerate(sorted(holders))}
    lists: list[list[tuple[int, float]]] = [[] for _ in terms]
    for i, t in enumerate(texts):
        weight = {w: idf[w] * n * (K1 + 1) / (n + K1 * (1 - B + B * len(t) / mean)) for w, n in Counter(t).items()}
        own = sum(weight.values()) or 1.0
        for w, x in weight.items():
            lists[terms[w]].append((i, x / own))
    impact = [(np.array([i for i, _ in p], dtype=np.int32), np.array([x for _, x in p])) for p in lists]
    block_max = np.zeros((len(terms), -(-len(texts) // BLOCK)), dtype=np.float32)
    for k, (i, x) in enumerate(impact):
        np.maximum.at(block_max[k], i // BLOCK, x.astype(np.float32))
    rare, slack = _common(impact, len(texts), block_max.shape[1])
    held = np.nonzero(block_max)
    ends = np.searchsorted(held[0], np.arange(len(terms) + 1))
    index = Index([r[1] for r in rows], [question_and_answer(r[2]) for r in rows], terms, impact, block_max,
                  block_max.max(1), rare, slack, ends, held[1], block_max[held], max(map(len, texts)))
    if index.nbytes() > max_index_bytes:
        raise ValueError(f"the index has {index.nbytes()} bytes, more than max_index_bytes={max_index_bytes}")
    return index


def candidates(index: Index, codes: list[np.ndarray], threshold: float) -> Iterator[tuple[int, int, int, float]]:
    """(text, window start, item position, score) of all items at or above the threshold.

    ``codes`` has per text the term numbers of its words (-1: not in the index).
    Texts are cut into pieces of ``step`` words; a window is two adjacent ones.
    """
    step, limit = index.step, threshold - 1e-6
    lengths = np.array([len(c) for c in codes], dtype=np.int64)
    pieces = -(-lengths // step)
    if not pieces.sum():
        return
    flat = np.concatenate(codes)
    offset = np.concatenate(([0], np.cumsum(lengths)))
    first_piece = np.concatenate(([0], np.cumsum(pieces)))
    n_terms, n_blocks = len(index.most), index.block_max.shape[1]
    place = np.flatnonzero((flat >= 0) & index.rare[flat])
    owner = np.searchsorted(offset, place, side="right") - 1
    inside = (place - offset[owner]) // step
    piece = first_piece[owner] + inside
    # the window of a piece starts with it; the last piece belongs to the one before unless it is alone
    begins = (inside < pieces[owner] - 1) | (pieces[owner] == 1)
    window = np.concatenate((piece[begins], piece[inside > 0] - 1))
    term = np.concatenate((flat[place[begins]], flat[place[inside > 0]]))
    pair = distinct(window * n_terms + term)
    window, term = pair // n_terms, pair % n_terms
    # expand each rare term to the blocks that hold it, and add up the block maxima
    open_: set[int] = set()
    span = max(1, CELLS // n_blocks)
    for low in range(0, int(first_piece[-1]), span):
        lo, hi = np.searchsorted(window, (low, low + span))
        t = term[lo:hi]
        count = index.ends[t + 1] - index.ends[t]
        at = np.repeat(index.ends[t] - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
        cell = np.repeat((window[lo:hi] - low) * n_blocks, count) + index.blocks[at]
        n = min(span, int(first_piece[-1]) - low)
        bound = np.bincount(cell, weights=index.maxima[at], minlength=n * n_blocks).reshape(n, n_blocks)
        open_.update((low + np.flatnonzero((bound + index.slack >= limit).any(1))).tolist())
    if (index.slack >= limit).any():
        open_ = set(range(int(first_piece[-1])))  # common words alone may reach it
    for w in sorted(open_):
        text = int(np.searchsorted(first_piece, w, side="right")) - 1
        a = int(offset[text]) + (w - int(first_piece[text])) * step
        terms = distinct(flat[a:min(a + 2 * step, int(offset[text + 1]))])
        yield from ((text, a - int(offset[text]), i, x) for i, x in _scored(index, terms[terms >= 0], limit))


def _common(impact: list[tuple[np.ndarray, np.ndarray]], n_items: int, n_blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Mark the terms of most items as common while they add at most COMMON to any
    item; returns the mark of the others and the largest such sum per block."""
    total, rare = np.zeros(n_blocks * BLOCK), np.ones(len(impact), dtype=bool)
    for t in sorted(range(len(impact)), key=lambda t: -len(impact[t][0])):
        items, x = impact[t]
        if len(items) <= max(1, n_items // 50) or (total[items] + x).max() > COMMON:
            break
        total[items] += x
        rare[t] = False
    return rare, total.reshape(n_blocks, BLOCK).max(1)


def _scored(index: Index, terms: np.ndarray, limit: float) -> Iterator[tuple[int, float]]:
    """Block-max search of one window's distinct terms."""
    blocks = np.flatnonzero(index.block_max[terms].sum(0) >= limit)
    if not len(blocks):
        return
    open_ = np.zeros(index.block_max.shape[1], dtype=bool)
    open_[blocks] = True
    scores = np.zeros(index.block_max.shape[1] * BLOCK)
    for t in terms[index.block_max[np.ix_(terms, blocks)].any(1)].tolist():
        items, x = index.impact[t]
        use = open_[items // BLOCK]
        scores[items[use]] += x[use]
    for i in np.flatnonzero(scores >= limit).tolist():
        yield i, float(scores[i])


def _verified(index: Index, texts: list[str | None], threshold: float, question_share: float,
              answer_share: float) -> dict[tuple[int, int], tuple[float, float, float]]:
    """(text, item position) -> (score, question overlap, answer overlap) of the best window of all verified pairs."""
    get = index.terms.get
    found = [words_of(t) for t in texts]
    codes = [np.array([get(w, -1) for w in ws], dtype=np.int64) for ws in found]
    best: dict[tuple[int, int], tuple[float, float, float]] = {}
    for k, a, i, score in candidates(index, codes, threshold):
        window = found[k][a:a + 2 * index.step]
        q, z = (share_found(p, window) for p in index.parts[i])
        if q >= question_share and z >= answer_share:
            best[k, i] = max(best.get((k, i), (0.0, 0.0, 0.0)), (score, q, z))
    return best


def _search(shared, threshold: float, question_share: float, answer_share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        index = shared.value
        for (ids,), texts in text_batches(batches, ["id"], "text"):
            best = _verified(index, texts, threshold, question_share, answer_share)
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[k] for k, _ in best], pa.int64()),
                 pa.array([index.items[i] if index.items[i] >= 0 else None for _, i in best], pa.int64()),
                 *(pa.array([v[j] for v in best.values()], pa.float64()) for j in range(3))],
                names=["id", "item_id", "score", "question_overlap", "answer_overlap"])
    return run


def _clean(shared, text_col: str, threshold: float, question_share: float, answer_share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        index = shared.value
        for b in batches:
            keep, at = np.ones(b.num_rows, dtype=bool), 0
            for _, texts in text_batches(iter([b]), [], text_col):
                keep[[at + k for k, _ in _verified(index, texts, threshold, question_share, answer_share)]] = False
                at += len(texts)
            yield b.filter(pa.array(keep))
    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 threshold: float = THRESHOLD, question_share: float = QUESTION_SHARE,
                 answer_share: float = ANSWER_SHARE, max_index_bytes: int = MAX_INDEX_BYTES) -> DataFrame:
    """(id, item_id, score, question_overlap, answer_overlap) of all verified pairs.

    One row per document row and item (the best window's figures). Null or
    empty texts match nothing; repeated rows each get their own; without
    benchmark items the result is empty. Other columns are ignored.
    """
    spark = docs.sparkSession
    index = build_index(benchmark, max_index_bytes=max_index_bytes)
    schema = f"`{id_col}` long, item_id long, score double, question_overlap double, answer_overlap double"
    if index is None:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(index)  # at most max_index_bytes
    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(_search(shared, threshold, question_share, answer_share),
                        "id long, item_id long, score double, question_overlap double, answer_overlap double")
            .withColumnRenamed("id", id_col))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", threshold: float = THRESHOLD,
                  question_share: float = QUESTION_SHARE, answer_share: float = ANSWER_SHARE,
                  max_index_bytes: int = MAX_INDEX_BYTES) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item. Each row is decided by
    its own text, whatever its id or those of others."""
    index = build_index(benchmark, max_index_bytes=max_index_bytes)
    if index is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(index)  # at most max_index_bytes
    return docs.mapInArrow(_clean(shared, text_col, threshold, question_share, answer_share), docs.schema)
