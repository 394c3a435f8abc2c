"""Boosted trees by second-order histograms, for several parameter sets at once.

All trees of one round and one level are grown in one pass over the data: each
task sums gradient and hessian per (trial, node, feature, bin) over its rows, the
sums of a few nodes meet in a task, and that task finds their splits. Trials
that have all their trees, and nodes that cannot be split, drop out of the pass.

A barrier stage grows ``ROUNDS`` rounds in one job. Its tasks run side by side, keep their rows, and
meet level by level over the shared folder (``Meeting``); the driver gets the trees. Where
tasks cannot stay side by side (dynamic allocation) or cannot hold their rows (``RESIDENT``), each
level is a job of its own; the driver then gets a handful of numbers per open node.

Splits have the gain of the regularised second-order objective; a child must
hold a hessian sum of at least ``min_child_weight``. Log loss, start margin zero.

Rows are kept as blocks (codes of one byte, label, and a margin per trial), cached on
memory and disk. Slots of few bins share a byte, so that a pass adds up bytes and not slots
(``Packing``). With a job per level each round's trees are applied to the margins by the pass that
opens the next round; every ``CHECKPOINT`` rounds the blocks are checkpointed to the shared folder. Blocks are
RDD rows, as each pass is array arithmetic on a block with state, not a relational step.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow.fs
from pyspark import RDD, BarrierTaskContext, StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, TypeConverters
from pyspark.ml.param import Params as Params_
from pyspark.ml.param.shared import HasFeaturesCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrix.session import scratch_path, scratch_root, ship, slots

BINS = 64
CHECKPOINT = 20
BLOCK_ROWS = 1 << 16
CODES = 256
#: slots of up to so many bins share a byte
SHARED = 16
#: nodes whose sums meet in one task
NODES = 16
#: partitions of vectors that make one of blocks at most
MERGED = 8
#: rounds that one barrier stage grows; a lost task repeats them
ROUNDS = 200
#: rows that make up for a task of their own in a barrier stage
TASK_ROWS = 1 << 12
#: rows of a task that are added up at a time
SUMMED = 1 << 14
#: bytes of rows and their state that a task of a barrier stage holds at most
RESIDENT = 1 << 29
#: seconds that a task waits for another one's part
PATIENCE = 3_600.0
#: rows that are scored at a time
SCORED = 1 << 12
#: chains of mixed rows that are scored at a time
CHAINS = 1 << 12
#: trees whose leaves meet in one product
FOREST = 16

# The published defaults of the objective.
LAMBDA = 1.0      # weight of the squared leaf values
LEAST_GAIN = 1e-6


@dataclass(frozen=True)
class Params:
    max_depth: int
    learning_rate: float
    min_child_weight: float
    n_estimators: int

    @classmethod
    def of(cls, p: Mapping[str, float]) -> Params:
        out = cls(int(round(p["max_depth"])), float(p["learning_rate"]), float(p["min_child_weight"]), int(round(p["n_estimators"])))
        if out.max_depth < 1 or out.n_estimators < 1 or out.learning_rate <= 0 or out.min_child_weight < 0:
            raise ValueError(f"parameters out of range: {dict(p)}")
        return out


    def leaf(self, sums: np.ndarray) -> float:
        return float(-self.learning_rate * sums[0] / (sums[1] + LAMBDA))


@dataclass
class Tree:
    """Nodes by number: feature (-1 for a leaf), the last bin that goes left, children, leaf value."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int) -> tuple[int, int]:
        at = len(self.feature)
        self.feature[node], self.cut[node], self.left[node] = feature, cut, at
        for _ in range(2):
            self.feature.append(-1)
            self.cut.append(0)
            self.left.append(0)
            self.value.append(0.0)
        return at, at + 1

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The leaf that each row of ``bins`` comes to."""
        return Walk.of(self).leaves(bins)


@dataclass(frozen=True)
class Walk:
    """A tree as arrays; a leaf leads to itself, so that all rows take ``depth`` steps."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    depth: int

    @classmethod
    def of(cls, tree: Tree) -> Walk:
        feature, cut, left = np.array(tree.feature), np.array(tree.cut), np.array(tree.left)
        inner = feature >= 0
        depth, level = 0, [0]
        while level := [c for n in level if inner[n] for c in (tree.left[n], tree.left[n] + 1)]:
            depth += 1
        return cls(np.where(inner, feature, 0), np.where(inner, cut, CODES), np.where(inner, left, np.arange(len(left))),
                   np.array(tree.value, float), depth)

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        flat, first = bins.ravel(), np.arange(len(bins)) * bins.shape[1]
        node = np.zeros(len(bins), np.int64)
        for _ in range(self.depth):
            node = self.left.take(node) + (flat.take(first + self.feature.take(node)) > self.cut.take(node))
        return node


@dataclass(frozen=True)
class Forest:
    """Several trees as arrays, with the inner nodes of each level and the leaves."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    levels: list[np.ndarray]
    leaves: np.ndarray

    @classmethod
    def of(cls, walks: Sequence[Walk]) -> Forest:
        roots = np.append(0, np.cumsum([len(w.left) for w in walks])[:-1])
        feature, cut, value = (np.concatenate([getattr(w, c) for w in walks]) for c in ("feature", "cut", "value"))
        left = np.concatenate([w.left + r for w, r in zip(walks, roots)])
        inner = left != np.arange(len(left))
        levels, level = [], roots[inner[roots]]
        while level.size:
            levels.append(level)
            level = np.concatenate([left[level], left[level] + 1])
            level = level[inner[level]]
        return cls(feature, cut, left, value, roots, levels, np.flatnonzero(~inner))

    def crossed(self, x: np.ndarray, other: np.ndarray, mine: np.ndarray) -> np.ndarray:
        """``Grown.crossed_margins`` of these trees; ``x`` and ``other`` are slots x rows.

        A mixed row comes to a leaf if its row goes that way at all nodes of ``mine``, and its partner at
        all others: the rows that may come to a leaf, times its value, times the partners that may.
        """
        may = [np.zeros((len(self.left), side.shape[1]), bool) for side in (x, other)]
        for reach in may:
            reach[self.roots] = True
        for level in self.levels:
            for side, reach, own in zip((x, other), may, (mine, ~mine)):
                decides = own[self.feature[level]]
                for nodes, decided in ((level[decides], True), (level[~decides], False)):
                    left, here = self.left[nodes], reach[nodes]
                    right = side[self.feature[nodes]] > self.cut[nodes, None] if decided else True
                    reach[left], reach[left + 1] = here & ~right if decided else here, here & right
        leaves = self.leaves[may[0][self.leaves].any(1) & may[1][self.leaves].any(1)]
        return may[0][leaves].T.astype(float) @ (may[1][leaves] * self.value[leaves, None])


@dataclass(frozen=True)
class Packing:
    """Slots in columns of one byte: a code stands for the bins of all slots of its column."""

    counts: np.ndarray    # slot -> bins
    column: np.ndarray    # slot -> column
    stride: np.ndarray    # slot -> what one bin more adds to the code
    spans: np.ndarray     # column -> codes

    @classmethod
    def of(cls, counts: Sequence[int], shared: int = SHARED) -> Packing:
        column, stride, spans = [], [], []
        for n in counts:
            at = next((c for c, span in enumerate(spans) if n <= shared and span * n <= CODES), len(spans))
            if at == len(spans):
                spans.append(1)
            column.append(at)
            stride.append(spans[at])
            spans[at] *= n
        return cls(np.array(counts), np.array(column), np.array(stride), np.array(spans))

    @property
    def starts(self) -> np.ndarray:
        """The place of each slot's first bin among the bins of all slots."""
        return np.append(0, self.counts.cumsum()[:-1])

    def codes(self, bins: np.ndarray) -> np.ndarray:
        """columns x rows"""
        return np.stack([(bins[:, self.column == c] * self.stride[self.column == c]).sum(1) for c in range(len(self.spans))]).astype(np.uint8)

    def bin_of(self) -> np.ndarray:
        """slots x codes: the bin of the slot at a code of its column."""
        return np.arange(CODES)[None, :] // self.stride[:, None] % self.counts[:, None]

    def bins(self, codes: np.ndarray) -> np.ndarray:
        """slots x rows"""
        return np.stack([b.take(codes[c]) for b, c in zip(self.bin_of(), self.column)]).astype(np.uint8)

    def spread(self) -> list[tuple[np.ndarray, np.ndarray | None]]:
        """Per column the places of its slots' bins, and codes x bins as 0 and 1 (None: the codes are the bins)."""
        out, bin_of = [], self.bin_of()
        for c, span in enumerate(self.spans):
            slots = np.flatnonzero(self.column == c)
            places = np.concatenate([self.starts[s] + np.arange(self.counts[s]) for s in slots])
            bins = np.concatenate([np.arange(self.counts[s])[None, :] == bin_of[s, :span, None] for s in slots], axis=1)
            out.append((places, None if len(slots) == 1 else bins.astype(float)))
        return out

    def leaves(self, walk: Walk, codes: np.ndarray) -> np.ndarray:
        """The leaf that each column of ``codes`` comes to."""
        column, rows = self.column[walk.feature] * codes.shape[1], np.arange(codes.shape[1])
        right = (self.bin_of()[walk.feature] > walk.cut[:, None]).ravel().view(np.uint8)
        flat, node = codes.ravel(), np.zeros(codes.shape[1], np.int64)
        for _ in range(walk.depth):
            code = flat.take(column.take(node) + rows)
            node = walk.left.take(node) + right.take(node * CODES + code)
        return node


@dataclass
class Block:
    codes: np.ndarray   # columns x rows
    label: np.ndarray
    margin: np.ndarray  # trials x rows

    def moved(self, packing: Packing, trees: Mapping[int, Sequence[Walk]]) -> Block:
        """The block after more trees of each trial."""
        margin = self.margin.copy()
        for t, walks in trees.items():
            for walk in walks:
                margin[t] += walk.value[packing.leaves(walk, self.codes)]
        return Block(self.codes, self.label, margin)


def cut_points(vectors: DataFrame, features: str = "features", bins: int = BINS) -> list[np.ndarray]:
    """Per slot the upper ends of all bins but the last: distinct quantiles of the slot, one aggregation."""
    first = vectors.select(F.size(vector_to_array(features)).alias("d")).first()
    if first is None:
        raise ValueError("there are no rows to fit")
    cells = vectors.select(vector_to_array(features).alias("x"))
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    row = cells.agg(*[F.percentile_approx(F.col("x")[j], shares, 10_000).alias(f"q{j}") for j in range(first["d"])],
                    *[F.max(F.col("x")[j]).alias(f"m{j}") for j in range(first["d"])]).first()
    out = []
    for j in range(first["d"]):
        ends = np.unique(np.array(row[f"q{j}"], float))
        out.append(ends[ends < row[f"m{j}"]])
    return out


def bin_rows(x: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """One byte per slot: the number of cut points below the value."""
    return np.column_stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)]).astype(np.uint8)


def blocks_of(vectors: DataFrame, cuts: Sequence[np.ndarray], packing: Packing, label: str, trials: int,
              features: str = "features") -> RDD:
    def run(rows: Iterator) -> Iterator[Block]:
        held: list = []
        for r in rows:
            held.append(r)
            if len(held) == BLOCK_ROWS:
                yield block(held)
                held = []
        if held:
            yield block(held)

    def block(held: list) -> Block:
        x = np.array([r[0] for r in held], float)
        y = np.array([r[1] for r in held], float)
        return Block(packing.codes(bin_rows(x, cuts)), y, np.zeros((trials, len(held))))
    return vectors.select(vector_to_array(features), F.col(label).cast("double")).rdd.mapPartitions(run)


def histograms(block: Block, growing: Mapping[int, Walk], open_: Mapping[int, Sequence[int]], packing: Packing) -> dict[int, np.ndarray]:
    """trial -> (open nodes, bins of all slots, 2) sums of gradient and hessian over the block."""
    width, spread, out = int(packing.counts.sum()), packing.spread(), {}
    for t, walk in growing.items():
        chance = 1.0 / (1.0 + np.exp(-block.margin[t]))
        gradient, hessian = chance - block.label, chance * (1 - chance)
        nodes, codes = len(open_[t]), block.codes
        place = np.full(len(walk.left), -1)
        place[open_[t]] = np.arange(nodes)
        place = place[packing.leaves(walk, codes)]
        if (rows := np.flatnonzero(place >= 0)).size < len(place):
            place, codes, gradient, hessian = place[rows], codes[:, rows], gradient[rows], hessian[rows]
        out[t] = _sums(codes, place, nodes, gradient, hessian, packing.spans, width, spread)
    return out


def _sums(codes: np.ndarray, place: np.ndarray, nodes: int, gradient: np.ndarray, hessian: np.ndarray, spans: np.ndarray,
          width: int, spread: Sequence[tuple]) -> np.ndarray:
    """(nodes, bins of all slots, 2) of the rows, which lie at ``place`` among the nodes."""
    sums = np.zeros((nodes, width, 2))
    for code, span, (places, bins) in zip(codes, spans, spread):
        cell = place * span + code
        for i, v in enumerate((gradient, hessian)):
            of_codes = np.bincount(cell, v, nodes * span).reshape(nodes, span)
            sums[:, places, i] = of_codes if bins is None else of_codes @ bins
    return sums


def best_splits(sums: np.ndarray, starts: np.ndarray, least: float) -> tuple[np.ndarray, ...]:
    """Per node: gain, slot and last bin on the left (first of equal gains), and the (gradient, hessian) of node and left child."""
    nodes, width, _ = sums.shape
    slot = np.searchsorted(starts, np.arange(width), side="right") - 1
    last = np.append(starts[1:], width) - 1
    running = sums.cumsum(1)
    before = np.where((starts > 0)[:, None], running[:, starts - 1], 0.0)
    left = running - before[:, slot]
    whole = (running[:, last] - before)[:, :1]
    right = whole - left
    score = lambda s: s[..., 0] ** 2 / (s[..., 1] + LAMBDA)
    gain = score(left) + score(right) - score(whole)
    fits = (left[..., 1] >= least) & (right[..., 1] >= least) & (np.arange(width) != last[slot])
    gain = np.where(fits, gain, -np.inf)
    # equal up to rounding is equal: the first one
    top = gain.max(1, keepdims=True)
    at = np.argmax(gain >= top - 1e-9 * np.maximum(1.0, np.abs(top)), axis=1)
    rows = np.arange(nodes)
    return gain[rows, at], slot[at], at - starts[slot[at]], whole[:, 0], left[rows, at]


def _true(flags: np.ndarray) -> np.ndarray:
    """``np.flatnonzero`` of few flags, eight at a time."""
    flat = flags.ravel()
    if len(flat) % 8:
        return np.flatnonzero(flat)
    eights = np.flatnonzero(flat.view(np.uint64))
    at = np.flatnonzero(flat.reshape(-1, 8)[eights])
    return eights.take(at >> 3) * 8 + (at & 7)


@dataclass
class Grown:
    """Cut points and trees of one parameter set."""

    cuts: list[np.ndarray]
    trees: list[Tree]

    @cached_property
    def walks(self) -> list[Walk]:
        return [Walk.of(t) for t in self.trees]

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        for lo in range(0, len(x), SCORED):
            bins = bin_rows(x[lo:lo + SCORED], self.cuts)
            if bins.shape[1]:
                # rows of the same bins get the same margin: mixed rows of an explanation often are
                _, first, which = np.unique(np.ascontiguousarray(bins).view(f"V{bins.shape[1]}").ravel(), return_index=True, return_inverse=True)
                bins = bins[first]
            else:
                which = np.arange(len(bins))
            margin = np.zeros(len(bins))
            for walk in self.walks:
                margin += walk.value.take(walk.leaves(bins))
            out[lo:lo + SCORED] = margin[which]
        return out

    def chain_margins(self, x: np.ndarray, other: np.ndarray, place: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """rows x (features + 1): the margins while a row's features replace those of its partner one by one.

        ``x`` and ``other`` are the bins of the rows and of their partners, ``owner`` the feature of each slot,
        ``place`` (rows x features) when a feature comes: at step k those of places below k are the row's.
        Only the turns of features that change a bin count. Of each chain the steps that come to a node are a run, so a
        node is the first and last step of all chains, in as few bytes as the steps need: one comparison with what the
        node's cut allows leads to a child. Margins are those of ``margin``, bit by bit.
        """
        n, steps = len(x), place.shape[1] + 1
        kind = np.min_scalar_type(steps)
        top = kind.type(np.iinfo(kind).max)
        moves = np.zeros(place.shape, bool)
        rows, slots = np.nonzero(x != other)
        moves[rows, owner[slots]] = True
        turns = np.column_stack([np.zeros(n, np.int64), np.take_along_axis(moves, place.argsort(1), 1).cumsum(1)])
        turn = np.take_along_axis(turns, place, 1)[:, owner].T.astype(kind)
        begins = np.append(0, (turns[:, -1] + 1).cumsum())
        size, begins = begins[-1], begins[:-1]
        x, other, allowed = np.ascontiguousarray(x.T), np.ascontiguousarray(other.T), {}

        def ways(slot: int, cut: int) -> tuple[np.ndarray, ...]:
            """Per child the first step that may come there, and ``top`` less the last one."""
            if (slot, cut) not in allowed:
                mine, theirs, at = x[slot] > cut, other[slot] > cut, turn[slot]
                allowed[slot, cut] = tuple(np.stack([np.where(b, 0, np.where(a, at + kind.type(1), top)), np.where(a | ~b, 0, top - at)]).astype(kind)
                                           for a, b in ((~mine, ~theirs), (mine, theirs)))
            return allowed[slot, cut]

        out, value, runs = np.zeros(size), np.zeros(size), np.zeros(size, bool)
        whole = np.stack([np.zeros(n, kind), (top - turns[:, -1]).astype(kind)])
        for walk in self.walks:
            inner = walk.left != np.arange(len(walk.left))
            come = np.empty((len(walk.left), 2, n), kind)
            come[0] = whole
            for node, slot, cut, left in zip(*(v[inner].tolist() for v in (np.arange(len(inner)), walk.feature, walk.cut, walk.left))):
                to_left, to_right = ways(slot, cut)
                np.maximum(come[node], to_left, out=come[left])
                np.maximum(come[node], to_right, out=come[left + 1])
            leaves = np.flatnonzero(~inner)
            first = come[leaves, 0]
            some = _true(first <= top - come[leaves, 1])
            leaf, chain = np.divmod(some, n)
            at = begins.take(chain) + first.ravel().take(some)
            value[at], runs[at] = walk.value[leaves].take(leaf), True
            starts = np.flatnonzero(runs)
            out += np.repeat(value.take(starts), np.diff(starts, append=size))
            runs[at] = False
        return out[begins[:, None] + turns]

    @cached_property
    def forests(self) -> list[Forest]:
        return [Forest.of(self.walks[lo:lo + FOREST]) for lo in range(0, len(self.walks), FOREST)]

    def crossed_margins(self, x: np.ndarray, other: np.ndarray, mine: np.ndarray) -> np.ndarray:
        """rows of ``x`` x rows of ``other``: the margins of rows that take the slots of ``mine`` (0 and 1) from one, the rest from the other."""
        out = np.zeros((len(x), len(other)))
        for forest in self.forests:
            out += forest.crossed(x.T, other.T, mine)
        return out

    def to_json(self) -> str:
        return json.dumps({"cuts": [c.tolist() for c in self.cuts],
                           "trees": [[t.feature, t.cut, t.left, t.value] for t in self.trees]})

    @classmethod
    def from_json(cls, text: str) -> Grown:
        d = json.loads(text)
        return cls([np.array(c, float) for c in d["cuts"]], [Tree(*t) for t in d["trees"]])


def chances(grown: Sequence[Grown], features: str = "features") -> Column:
    """The positive probabilities of several models for a vector column, in one pass."""
    models = list(grown)

    @F.pandas_udf("array<double>")
    def run(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=object)
        rows = np.stack(x.to_list())
        return pd.Series(list(np.column_stack([1.0 / (1.0 + np.exp(-m.margin(rows))) for m in models])))
    return run(vector_to_array(F.col(features)))


def bins_of(grown: Grown, features: str = "features") -> Column:
    """The bins of a vector column, a byte per slot."""
    @F.pandas_udf("binary")
    def run(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=object)
        return pd.Series([r.tobytes() for r in bin_rows(np.stack(x.to_list()), grown.cuts)])
    return run(vector_to_array(F.col(features)))


def chain_credits(grown: Grown, owner: Sequence[int], p: int, x: str, other: str, turn: str) -> Column:
    """What each of ``p`` features adds to the positive probability, then the probabilities without and with all of them.

    Features replace those of the partner ``other`` in the order of the numbers ``turn``; both are ``bins_of`` columns.
    """
    slots, of = len(grown.cuts), np.array(owner, int)

    @F.pandas_udf("array<double>")
    def run(x: pd.Series, other: pd.Series, turn: pd.Series) -> pd.Series:
        out: list[np.ndarray] = []
        for lo in range(0, len(x), CHAINS):
            mine, theirs = (np.frombuffer(b"".join(s.iloc[lo:lo + CHAINS]), np.uint8).reshape(-1, slots) for s in (x, other))
            turns = np.stack(turn.iloc[lo:lo + CHAINS].to_list()).argsort(1, kind="stable")
            chance = 1.0 / (1.0 + np.exp(-grown.chain_margins(mine, theirs, turns.argsort(1), of)))
            found = np.empty((len(turns), p + 2))
            np.put_along_axis(found, turns, np.diff(chance, axis=1), 1)
            found[:, p], found[:, p + 1] = chance[:, 0], chance[:, p]
            out.extend(found)
        return pd.Series(out, dtype=object)
    return run(F.col(x), F.col(other), F.col(turn))


def parts_of(bins: str, masks: np.ndarray) -> Column:
    """Per mask (slots as 0 and 1) the bins of its slots, and zero in the others."""
    keep = masks.astype(np.uint8)

    @F.pandas_udf("array<binary>")
    def run(x: pd.Series) -> pd.Series:
        return pd.Series([[part.tobytes() for part in np.frombuffer(b, np.uint8) * keep] for b in x], dtype=object)
    return run(F.col(bins))


def crossed_sums(grown: Grown, masks: np.ndarray, which: str, x: str, other: Column, times: Column) -> Column:
    """Per part of the array ``x`` the sum, over the parts of ``other`` with their ``times``, of the mixed rows' positive probability.

    The column ``which`` is the number from 1 of the mask whose slots come from ``x``.
    """
    slots = len(grown.cuts)

    @F.pandas_udf("array<double>")
    def run(which: pd.Series, x: pd.Series, other: pd.Series, times: pd.Series) -> pd.Series:
        out = []
        for m, mine, theirs, n in zip(which, x, other, times):
            mine, theirs = (np.frombuffer(b"".join(side), np.uint8).reshape(-1, slots) for side in (mine, theirs))
            chance = 1.0 / (1.0 + np.exp(-grown.crossed_margins(mine, theirs, masks[m - 1] > 0)))
            out.append(chance @ np.asarray(n, float))
        return pd.Series(out, dtype=object)
    return run(F.col(which), F.col(x), other, times)


class HistogramTreesModel(Model, HasFeaturesCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability`` and ``prediction``; saved and loaded like any pipeline stage."""

    trees = Param(Params_._dummy(), "trees", "cut points and trees as JSON", typeConverter=TypeConverters.toString)

    def __init__(self, grown: Grown | None = None, featuresCol: str = "features"):
        super().__init__()
        self._set(featuresCol=featuresCol)
        if grown is not None:
            self._set(trees=grown.to_json())

    def grown(self) -> Grown:
        return Grown.from_json(self.getOrDefault(self.trees))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ship(dataset.sparkSession)
        out = dataset.withColumn("__p", chances([self.grown()], self.getFeaturesCol())[0])
        return (out.withColumn("probability", array_to_vector(F.array(F.lit(1.0) - F.col("__p"), F.col("__p"))))
                .withColumn("prediction", (F.col("__p") > 0.5).cast("double")).drop("__p"))


class HistogramTrees(Estimator, HasFeaturesCol):
    """``grow`` for one parameter set, as the last stage of a pipeline."""

    def __init__(self, params: Mapping[str, float], label: str = "Churn", featuresCol: str = "features"):
        super().__init__()
        Params.of(params)
        self._set(featuresCol=featuresCol)
        self.parameters, self.label = dict(params), label

    def _fit(self, dataset: DataFrame) -> HistogramTreesModel:
        vectors = dataset.select(F.col(self.getFeaturesCol()).alias("features"), self.label)
        return HistogramTreesModel(grow(vectors, [self.parameters], self.label)[0], self.getFeaturesCol())


def grow(vectors: DataFrame, params: Sequence[Mapping[str, float]], label: str = "Churn", bins: int = BINS,
         begun: Sequence[Grown] | None = None) -> list[Grown]:
    """One model per parameter set, all grown together on (features, label).

    With ``begun`` (a model per set, from an earlier call on the same rows) each model
    keeps its trees and goes on up to its ``n_estimators``; the margins of the trees it
    has are added up once. The result equals growing all trees in one call.

    Rows that make a single block are dealt out by trial: each task grows one trial on
    the block, with the same arithmetic as the passes over many blocks. More blocks are dealt
    out in pieces to the tasks of a barrier stage.
    """
    spark = vectors.sparkSession
    scratch_root(spark)
    ship(spark)
    trials = [Params.of(p) for p in params]
    had: list[list[Tree]] = [list(m.trees) for m in begun] if begun else [[] for _ in trials]
    if len(had) != len(trials):
        raise ValueError(f"{len(had)} begun models for {len(trials)} parameter sets")
    trials = [replace(p, n_estimators=max(0, p.n_estimators - len(h))) for p, h in zip(trials, had)]
    cuts = begun[0].cuts if begun else cut_points(vectors, bins=bins)
    packing = Packing.of([len(c) + 1 for c in cuts])
    # a pass holds some bytes a row: fewer, larger partitions than the vectors need
    cores, parts = spark.sparkContext.defaultParallelism, vectors.rdd.getNumPartitions()
    wanted = cores * -(-parts // (MERGED * cores))
    state = blocks_of(vectors.coalesce(wanted) if wanted < parts else vectors, cuts, packing, label, len(trials))
    state = state.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sizes = state.map(lambda b: len(b.label)).collect()  # one number per block
        if len(sizes) == 1:
            # few rows: a byte per slot, so that the sums of a bin are added up row by row
            apart = Packing.of(packing.counts, shared=0)
            alone = (state.flatMap(lambda b: [(t, Block(packing.bins(b.codes), b.label, b.margin[:1])) for t in range(len(trials))])
                     .partitionBy(len(trials), lambda t: t)
                     .map(lambda x: (x[0], _rounds([trials[x[0]]], _OneBlock(x[1], apart), [had[x[0]]])[0])))
            trees = [found for _, found in sorted(alone.collect(), key=lambda x: x[0])]
        elif tasks := _side_by_side(spark, sum(sizes), len(packing.spans), len(trials)):
            trees = _together(state, packing, trials, had, tasks, scratch_path(spark, "sums"))
        else:
            passes = _Blocks(state, packing)
            try:
                trees = _rounds(trials, passes, had)
            finally:
                passes.free()
    finally:
        state.unpersist()
    return [Grown(cuts, [*old, *found]) for old, found in zip(had, trees)]


def _rounds(trials: Sequence[Params], passes, had: list[list[Tree]]) -> list[list[Tree]]:
    """The new trees of every trial; ``passes`` gives the splits of a level and takes the trees of past rounds."""
    if any(had):
        passes.renew({t: [Walk.of(tree) for tree in trees] for t, trees in enumerate(had)}, True)
    done: list[list[Tree]] = [[] for _ in trials]
    rounds = max(p.n_estimators for p in trials)
    for round_ in range(rounds):
        trees = {t: Tree() for t, p in enumerate(trials) if p.n_estimators > round_}
        open_ = {t: [0] for t in trees}
        level = 0
        while open_:
            found = passes.level({t: Walk.of(trees[t]) for t in open_}, open_, {t: trials[t].min_child_weight for t in open_})
            following: dict[int, list[int]] = {}
            for t, nodes in open_.items():
                p, tree = trials[t], trees[t]
                gain, slot, cut, whole, left = found[t]
                for k, node in enumerate(nodes):
                    if not gain[k] > LEAST_GAIN:
                        tree.value[node] = p.leaf(whole[k])
                        continue
                    # the children's sums are known here: only those that may split are looked at again
                    for child, part in zip(tree.split(node, int(slot[k]), int(cut[k])), (left[k], whole[k] - left[k])):
                        tree.value[child] = p.leaf(part)
                        if level + 1 < p.max_depth and part[1] >= 2 * p.min_child_weight:
                            following.setdefault(t, []).append(child)
            open_, level = following, level + 1
        for t, tree in trees.items():
            done[t].append(tree)
        if round_ + 1 < rounds:
            passes.renew({t: [Walk.of(tree)] for t, tree in trees.items() if trials[t].n_estimators > round_ + 1})
    return done


class _OneBlock:
    """Passes over a block in the task that holds it."""

    def __init__(self, block: Block, packing: Packing):
        self.block, self.packing = block, packing

    def level(self, growing, open_, least):
        sums = histograms(self.block, growing, open_, self.packing)
        return {t: best_splits(s, self.packing.starts, least[t]) for t, s in sums.items()}

    def renew(self, trees, _cut: bool = False) -> None:
        self.block = self.block.moved(self.packing, trees)


def _side_by_side(spark, rows: int, columns: int, trials: int) -> int:
    """How many tasks of a barrier stage hold the rows; 0 where there can be no such stage."""
    if spark.conf.get("spark.dynamicAllocation.enabled", "false").lower() == "true":
        return 0
    tasks = min(slots(spark), -(-rows // TASK_ROWS))
    # codes twice (those of open rows apart), label, and per trial margin, gradient, hessian, nodes and open rows
    return tasks if rows // max(1, tasks) * (2 * columns + 8 + 56 * trials) <= RESIDENT else 0


def _together(state: RDD, packing: Packing, trials: list[Params], had: list[list[Tree]], tasks: int, folder: str) -> list[list[Tree]]:
    """The new trees of every trial, ``ROUNDS`` of them a job, by ``tasks`` tasks side by side."""
    def dealt(part: int, blocks: Iterable[Block]) -> Iterator[tuple]:
        for i, b in enumerate(blocks):
            ends = len(b.label) * np.arange(tasks + 1) // tasks
            for j, (lo, hi) in enumerate(zip(ends[:-1], ends[1:])):
                yield (part + i + j) % tasks, (part, i, b.codes[:, lo:hi], b.label[lo:hi])

    pieces = state.mapPartitionsWithIndex(dealt).partitionBy(tasks, lambda k: k)
    new: list[list[Tree]] = [[] for _ in trials]
    while any(len(n) < p.n_estimators for n, p in zip(new, trials)):
        now = [replace(p, n_estimators=min(ROUNDS, p.n_estimators - len(n))) for n, p in zip(new, trials)]
        begun = [h + n for h, n in zip(had, new)]

        def run(found: Iterator[tuple], now=now, begun=begun) -> Iterator[list]:
            context = BarrierTaskContext.get()
            me = context.partitionId()
            # a stage that is run again meets elsewhere
            place = context.allGather(uuid.uuid4().hex)[0]
            held = sorted((piece for _, piece in found), key=lambda x: x[:2])
            passes = _Resident(held, packing, len(now), Meeting(f"{folder}/{place}", me, tasks))
            trees = _rounds(now, passes, begun)
            if me == 0:
                yield trees
        for n, more in zip(new, pieces.barrier().mapPartitions(run).collect()[0]):
            n.extend(more)
    return new


class Meeting:
    """Tasks of a barrier stage exchange arrays over the shared folder.

    A part becomes visible whole, by rename; who needs it looks until it is there. Parts are
    deleted as soon as all have read them. (Spark's own barrier answers once a second.)
    """

    def __init__(self, folder: str, me: int, tasks: int):
        self.fs, self.folder = pyarrow.fs.FileSystem.from_uri(folder)
        self.me, self.tasks = me, tasks
        self.fs.create_dir(self.folder, recursive=True)

    def _path(self, name: str, task: int) -> str:
        return f"{self.folder}/{name}-{task}"

    def put(self, name: str, values: np.ndarray) -> None:
        path = self._path(name, self.me)
        with self.fs.open_output_stream(path + ".part") as out:
            out.write(np.ascontiguousarray(values, float).data.cast("B"))
        self.fs.move(path + ".part", path)

    def get(self, name: str, task: int, spans: Sequence[tuple[int, int]]) -> list[np.ndarray]:
        """Numbers (from, to) of the array that ``task`` put under ``name``."""
        path, until, pause = self._path(name, task), time.monotonic() + PATIENCE, 0.0005
        while self.fs.get_file_info(path).type != pyarrow.fs.FileType.File:
            if time.monotonic() > until:
                raise TimeoutError(f"task {task} did not put {name}")
            time.sleep(pause)
            pause = min(pause * 1.3, 0.02)
        with self.fs.open_input_file(path) as f:
            return [np.frombuffer(f.read_at(8 * (b - a), 8 * a)) for a, b in spans]

    def drop(self, name: str) -> None:
        self.fs.delete_file(self._path(name, self.me))


class _Open:
    """What a tree in growth knows of a block's rows: the node of each; gradient, hessian and codes of those in open nodes."""

    def __init__(self, block: Block, margin: np.ndarray):
        chance = 1.0 / (1.0 + np.exp(-margin))
        self.gradient, self.hessian = chance - block.label, chance * (1 - chance)
        self.codes, self.rows = block.codes, np.arange(len(margin))
        self.node, self.place = np.zeros(len(margin), np.int64), np.zeros(len(margin), np.int64)

    def step(self, column: np.ndarray, right: np.ndarray, left: np.ndarray) -> None:
        """Rows of the open nodes go to their children."""
        code = self.codes.ravel().take(column.take(self.place) * len(self.place) + np.arange(len(self.place)))
        self.node[self.rows] = left.take(self.place) + right.take(self.place * CODES + code)

    def keep(self, place_of: np.ndarray) -> None:
        """Only rows of the nodes that are open now, and their places among these."""
        place = place_of[self.node[self.rows]]
        if (at := np.flatnonzero(place >= 0)).size < len(place):
            self.rows, self.codes, self.gradient, self.hessian = self.rows[at], self.codes[:, at], self.gradient[at], self.hessian[at]
            place = place[at]
        self.place = place


class _Resident:
    """Passes over the rows that one of the tasks holds; all tasks find the same splits and grow the same trees."""

    def __init__(self, pieces: Sequence[tuple], packing: Packing, trials: int, meeting: Meeting):
        self.blocks: list[Block] = []
        if pieces:
            codes, label = np.concatenate([p[2] for p in pieces], axis=1), np.concatenate([p[3] for p in pieces])
            self.blocks = [Block(codes[:, i:i + SUMMED].copy(), label[i:i + SUMMED], np.zeros((trials, len(label[i:i + SUMMED]))))
                           for i in range(0, len(label), SUMMED)]
        self.packing, self.meeting, self.levels, self.finders = packing, meeting, 0, 0
        self.width, self.spread, self.bin_of = int(packing.counts.sum()), packing.spread(), packing.bin_of()
        #: trial -> state of each block, and the nodes that were open at the last level
        self.open: dict[int, list[_Open]] = {}
        self.nodes: dict[int, Sequence[int]] = {}

    def _step(self, t: int, walk: Walk) -> None:
        nodes = self.nodes[t]
        feature = walk.feature[nodes]
        right = (self.bin_of[feature] > walk.cut[nodes][:, None]).ravel().view(np.uint8)
        for part in self.open[t]:
            part.step(self.packing.column[feature], right, walk.left[nodes])

    def level(self, growing, open_, least):
        whole = []
        for t, walk in growing.items():
            if open_[t] == [0]:
                self.open[t] = [_Open(b, b.margin[t]) for b in self.blocks]
            else:
                self._step(t, walk)
                place_of = np.full(len(walk.left), -1)
                place_of[open_[t]] = np.arange(len(open_[t]))
                for part in self.open[t]:
                    part.keep(place_of)
            self.nodes[t] = open_[t]
            sums = np.zeros((len(open_[t]), self.width, 2))
            for part in self.open[t]:
                sums += _sums(part.codes, part.place, len(open_[t]), part.gradient, part.hessian, self.packing.spans, self.width, self.spread)
            whole.append(sums)
        return self._splits(np.concatenate(whole), open_, least)

    def _splits(self, sums: np.ndarray, open_, least):
        """Some nodes' sums meet in a task, which finds their splits; all tasks read these."""
        meeting, n, each = self.meeting, self.levels, 2 * self.width
        self.levels += 1
        chunks, at = [], 0  # (trial, first node among all, one past the last)
        for t, nodes in open_.items():
            chunks += [(t, at + i, at + min(i + NODES, len(nodes))) for i in range(0, len(nodes), NODES)]
            at += len(nodes)
        of = lambda task: chunks[task::meeting.tasks]
        meeting.put(f"sums{n}", sums)
        if mine := of(meeting.me):
            met: list[np.ndarray] = [np.zeros((b - a) * each) for _, a, b in mine]
            # in the order of the tasks: reruns agree
            for task in range(meeting.tasks):
                for total, part in zip(met, meeting.get(f"sums{n}", task, [(a * each, b * each) for _, a, b in mine])):
                    total += part
            found = [best_splits(m.reshape(-1, self.width, 2), self.packing.starts, least[t]) for m, (t, _, _) in zip(met, mine)]
            meeting.put(f"splits{n}", np.concatenate([np.column_stack(f) for f in found]))
        rows = np.empty((at, 7))
        for task in range(min(meeting.tasks, len(chunks))):
            theirs = of(task)
            values = meeting.get(f"splits{n}", task, [(0, 7 * sum(b - a for _, a, b in theirs))])[0].reshape(-1, 7)
            for (_, a, b), lo in zip(theirs, np.cumsum([0] + [b - a for _, a, b in theirs])):
                rows[a:b] = values[lo:lo + b - a]
        # whoever found splits has read all sums, and every task the splits of the level before
        meeting.drop(f"sums{n}")
        if n and meeting.me < self.finders:
            meeting.drop(f"splits{n - 1}")
        self.finders = min(meeting.tasks, len(chunks))
        out, at = {}, 0
        for t, nodes in open_.items():
            r = rows[at:at + len(nodes)]
            out[t], at = (r[:, 0], r[:, 1].astype(int), r[:, 2].astype(int), r[:, 3:5], r[:, 5:7]), at + len(nodes)
        return out

    def renew(self, trees, begun: bool = False) -> None:
        if begun:
            self.blocks = [b.moved(self.packing, trees) for b in self.blocks]
            return
        for t, (walk,) in trees.items():
            self._step(t, walk)
            for block, part in zip(self.blocks, self.open.pop(t)):
                block.margin[t] += walk.value[part.node]
        self.open.clear()


class _Blocks:
    """Passes over blocks in many tasks: one job per level, whose second stage finds the splits."""

    def __init__(self, state: RDD, packing: Packing):
        self.state, self.packing, self.renewed, self.past = state, packing, 0, []
        self.parts = state.getNumPartitions()

    def level(self, growing, open_, least):
        packing = self.packing
        chunks = [(t, i) for t, nodes in open_.items() for i in range(0, len(nodes), NODES)]

        def sums(part: int, blocks: Iterable[Block]) -> Iterator[tuple]:
            total: dict[int, np.ndarray] = {}
            for block in blocks:
                for t, s in histograms(block, growing, open_, packing).items():
                    total[t] = total[t] + s if t in total else s
            if total:
                yield from ((k, (part, total[t][i:i + NODES])) for k, (t, i) in enumerate(chunks))

        def splits(found: Iterable[tuple]) -> Iterator[tuple]:
            held: dict[int, list] = {}
            for k, s in found:
                held.setdefault(k, []).append(s)
            # in the order of the partitions, whichever came first: reruns agree
            for k, parts in held.items():
                whole = sum(s for _, s in sorted(parts, key=lambda x: x[0]))
                yield k, best_splits(whole, packing.starts, least[chunks[k][0]])

        met = self.state.mapPartitionsWithIndex(sums).partitionBy(min(self.parts, len(chunks)), lambda k: k)
        found: dict[int, list] = {}
        for k, s in sorted(met.mapPartitions(splits).collect(), key=lambda x: x[0]):
            found.setdefault(chunks[k][0], []).append(s)
        while self.past:
            self.past.pop().unpersist()
        return {t: [np.concatenate(column) for column in zip(*s)] for t, s in found.items()}

    def renew(self, trees, cut: bool = False) -> None:
        """Margins after ``trees``; the next level's pass computes them."""
        packing = self.packing
        new = self.state.map(lambda b: b.moved(packing, trees)).persist(StorageLevel.MEMORY_AND_DISK)
        self.renewed += 1
        if cut or self.renewed % CHECKPOINT == 0:
            new.checkpoint()
        self.past.append(self.state)
        self.state = new

    def free(self) -> None:
        for state in (*self.past, self.state):
            state.unpersist()
