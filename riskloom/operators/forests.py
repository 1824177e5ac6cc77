"""ML-5/ML-6: gradient boosted trees and random forests grown level by level on binned rows.

The models are those of spark.ml's ``GBTClassifier`` and ``RandomForestClassifier``: log loss with labels of -1 and 1, regression
trees of the residuals by variance (the first of the labels, then with the learning rate), rows drawn without replacement per round; and
class trees by Gini impurity on Poisson row counts, sibling leaves of the same class merged, class shares averaged. Each node draws its
columns. With all rows and columns the trees are those of spark.ml, given the cuts.

What differs is the work. Rows are numpy blocks of joint codes (``histograms``), a level adds up the smaller child of each split only,
many trees of a forest grow in one visit, and rows are drawn by a hash of their key, so that a visit needs no state but the scores of
boosting. These are kept by the Python worker; one that does not have them computes them anew from the trees so far. All sums are whole
numbers (residuals in fixed point): a fit does not depend on partitions or on the order of additions, given the cuts. The driver holds
histograms of one group of trees, whatever the number of rows.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators import histograms as H

#: Fixed point of residuals; trees of a forest that grow at the same time; boosted trees sent with a task before they go into a
#: broadcast; rows scored at a time.
POINT, GROUP, RECENT, SCORE_ROWS = 1 << 24, 50, 25, 1 << 15
#: A split has to lower the impurity by more than the error of its arithmetic.
LEAST_GAIN = 1e-12


@dataclass(frozen=True)
class TreeParams:
    """``forest``: class trees on Poisson counts of the rows; else boosted ones on rows drawn once at most."""

    trees: int
    depth: int
    forest: bool
    row_share: float = 0.9
    column_share: float = 0.9
    learning_rate: float = 0.1
    seed: int = 42
    bootstrap: bool = True

    def columns(self, width: int) -> int:
        return max(1, math.ceil(self.column_share * width))


@dataclass
class Tree:
    """Nodes in heap order (children of i: 2i + 1 and 2i + 2); ``feature`` -1: a leaf. Rows with a bin above ``bin`` go right."""

    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> "Tree":
        n = (2 << depth) - 1
        return cls(np.full(n, -1, np.int16), np.zeros(n, np.uint8), np.zeros(n))

    def descend(self, x, node: np.ndarray, level: int, rows: np.ndarray | None = None) -> None:
        """Rows at the split nodes of a level go to their children. ``node``: of the rows given, or of all."""
        for k in range((1 << level) - 1, (2 << level) - 1):
            if self.feature[k] >= 0:
                at = np.flatnonzero(node == k)
                node[at] = 2 * k + 1 + x.above(int(self.feature[k]), int(self.bin[k]), at if rows is None else rows[at])

    def leaves(self, x, depth: int) -> np.ndarray:
        node = np.zeros(len(x), np.uint8 if depth < 7 else np.int32)
        for level in range(depth):
            self.descend(x, node, level)
        return node


class _Bins:
    """Plain bins of a few rows, column by column."""

    def __init__(self, x: np.ndarray) -> None:
        self.columns = np.ascontiguousarray(x.T)
        self.n = len(x)

    def __len__(self) -> int:
        return self.n

    def above(self, f: int, b: int, rows: np.ndarray | None = None) -> np.ndarray:
        column = self.columns[f]
        return (column if rows is None else column[rows]) > b


# ----------------------------------------------------------------------------- drawn rows and columns

def uniform(key: np.ndarray, draw: int, seed: int) -> np.ndarray:
    """32 random bits per row key and number of the draw (the mixer of SplitMix64)."""
    start = np.uint64((seed * 0xD1342543DE82EF95 + (draw + 1) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    z = key + start
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z ^= z >> np.uint64(shift)
        z *= np.uint64(factor)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(32)).astype(np.uint32)


def poisson_steps(rate: float) -> np.ndarray:
    """Cumulative probabilities of 0, 1, ... in 2 ** 32nds, as long as they are below one."""
    p, total, steps, k = math.exp(-rate), 0.0, [], 0
    while True:
        total += p
        if round(total * 2**32) >= 2**32 or k > 200:
            return np.array(steps, np.uint32)
        steps.append(round(total * 2**32))
        k += 1
        p *= rate / k


def drawn_rows(key: np.ndarray, tree: int, p: TreeParams) -> tuple[np.ndarray | None, np.ndarray | None]:
    """Rows that a tree is grown on (None: all) and how often each counts (None: once)."""
    if p.forest and p.bootstrap:
        u, steps = uniform(key, tree, p.seed), poisson_steps(p.row_share)
        rows = np.flatnonzero(u >= steps[0])
        u, times = u[rows], np.ones(len(rows))
        for s in steps[1:]:
            times += u >= s
        return rows, times
    if p.row_share >= 1:
        return None, None
    return np.flatnonzero(uniform(key, tree, p.seed) < round(p.row_share * 2**32)), None


def drawn_columns(width: int, tree: int, node: int, p: TreeParams) -> np.ndarray:
    out = np.ones(width, bool)
    if (n := p.columns(width)) < width:
        out[np.random.default_rng([p.seed, tree, node]).permutation(width)[n:]] = False
    return out


# ----------------------------------------------------------------------------- visits

def _at_asked(tree: Tree, asked: list[int], node: np.ndarray) -> tuple[np.ndarray | slice, np.ndarray]:
    """Which rows are at the asked nodes, and the place of their node among these."""
    if asked == [0]:
        return slice(None), np.zeros(len(node), np.int64)
    slot = np.full(len(tree.feature), -1, np.int64)
    slot[asked] = np.arange(len(asked))
    of_row = slot[node]
    at = np.flatnonzero(of_row >= 0)
    return at, of_row[at]


def _visit_forest(offsets: np.ndarray, p: TreeParams, first: int, trees: list[Tree], level: int, asked: list[list[int]], blocks) -> Iterator[np.ndarray]:
    """Of the asked nodes of all trees one after the other (nodes, places, 2): rows, and those of label 1."""
    total, places = None, int(offsets[-1])
    for _, columns, y, key in blocks:
        by_bin, parts = columns.by_bin(offsets), []
        for t, (tree, nodes) in enumerate(zip(trees, asked)):
            if not nodes:
                continue
            rows, times = drawn_rows(key, first + t, p)
            rows = np.arange(len(y)) if rows is None else rows
            node = np.zeros(len(rows), np.uint8 if p.depth < 7 else np.int32)
            for above in range(level):
                tree.descend(columns, node, above, rows)
            at, slot = _at_asked(tree, nodes, node)
            rows = rows[at]
            by_class = columns.sums(rows, 2 * slot + y[rows], 2 * len(nodes), [times if times is None else times[at]], places, by_bin).reshape(len(nodes), 2, places)
            parts.append(np.stack([by_class.sum(axis=1), by_class[:, 1]], axis=2))
        part = np.concatenate(parts).astype(np.int64)
        total = part if total is None else total + part
    if total is not None:
        yield total


_KEPT: dict = {}


class _Margin:
    """A block's margins after some trees, and where its drawn rows are in the tree that grows."""

    def __init__(self, y: np.ndarray) -> None:
        self.sign, self.margin, self.trees, self.node = 2.0 * y - 1.0, np.zeros(len(y)), 0, None

    def catch_up(self, columns, key: np.ndarray, done: list[Tree], p: TreeParams) -> None:
        for t in range(self.trees, len(done)):
            self.margin += (p.learning_rate if t else 1.0) * done[t].value[done[t].leaves(columns, p.depth)]
            self.node = None
        self.trees = len(done)
        if self.node is None:
            target = 4.0 * self.sign / (1.0 + np.exp(2.0 * self.sign * self.margin)) if done else self.sign
            self.rows, _ = drawn_rows(key, len(done), p)
            self.rows = np.arange(len(target)) if self.rows is None else self.rows
            self.target = np.rint(target[self.rows] * POINT)
            self.node, self.level = np.zeros(len(self.target), np.uint8 if p.depth < 7 else np.int32), 0

    def descend(self, columns, tree: Tree, level: int) -> None:
        for above in range(self.level, level):
            tree.descend(columns, self.node, above, self.rows)
        self.level = level


def _visit_boosted(fit: str, offsets: np.ndarray, p: TreeParams, older, recent: list[Tree], tree: Tree, level: int, asked: list[int], blocks) -> Iterator[np.ndarray]:
    """(asked nodes, places, 2): rows and sums of residuals."""
    if _KEPT.get("fit") != fit:
        _KEPT.clear()
        _KEPT["fit"] = fit
    done, total = older.value + recent, None
    for name, columns, y, key in blocks:
        block = _KEPT.get(name)
        if block is None or block.trees > len(done) or block.trees == len(done) and block.node is not None and block.level > level:
            block = _KEPT[name] = _Margin(y)
        block.catch_up(columns, key, done, p)
        block.descend(columns, tree, level)
        at, slot = _at_asked(tree, asked, block.node)
        part = columns.sums(block.rows[at], slot, len(asked), [None, block.target[at]], int(offsets[-1]), columns.by_bin(offsets))
        part = part.transpose(0, 2, 1).astype(np.int64)
        total = part if total is None else total + part
    if total is not None:
        yield total


# ----------------------------------------------------------------------------- growing

def _term(x: np.ndarray, forest: bool) -> np.ndarray:
    """What the impurity of (rows, sum) is lowered by, times the rows; nothing without rows."""
    n, s = x[..., 0].astype(np.float64), x[..., 1].astype(np.float64) / (1 if forest else POINT)
    return np.divide(s * s + (n - s) ** 2 if forest else s * s, n, out=np.zeros_like(n), where=n > 0)


def best_splits(hists: np.ndarray, drawn: np.ndarray, offsets: np.ndarray, forest: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per node (places, 2) its best split: gain, feature, bin, and the sums of the left child; of equal gains the first by (feature, bin)."""
    sums = hists.cumsum(axis=1)
    total = sums[:, offsets[1] - 1]
    before = np.concatenate([np.zeros((len(hists), 1, 2), np.int64), sums[:, offsets[1:-1] - 1]], axis=1)
    left = sums - np.repeat(before, np.diff(offsets), axis=1)
    right = total[:, None] - left
    gain = (_term(left, forest) + _term(right, forest) - _term(total, forest)[:, None]) / np.maximum(total[:, :1], 1)
    gain[~drawn | (left[..., 0] == 0) | (right[..., 0] == 0)] = -1.0
    k, node = gain.argmax(axis=1), np.arange(len(hists))
    feature = np.searchsorted(offsets, k, side="right") - 1
    return gain[node, k], feature, k - offsets[feature], left[node, k]


class _Growing:
    """Trees of one group, level by level: the histograms of the level's nodes, and which nodes a visit has to add up."""

    def __init__(self, first: int, count: int, offsets: np.ndarray, p: TreeParams) -> None:
        self.first, self.offsets, self.p, self.level = first, offsets, p, 0
        self.trees = [Tree.empty(p.depth) for _ in range(count)]
        self.sums = [np.zeros((len(t.feature), 2), np.int64) for t in self.trees]
        self.hists: dict[tuple[int, int], np.ndarray] = {}
        self.asked = [[0] for _ in self.trees]

    def take(self, got: np.ndarray) -> bool:
        """The histograms of the asked nodes come in, the level's nodes are split; whether there is another level to ask for."""
        p, offsets, hists = self.p, self.offsets, {}
        for (t, k), h in zip(((t, k) for t, nodes in enumerate(self.asked) for k in nodes), got):
            hists[t, k] = h
            if k:
                hists[t, k + 1 if k % 2 else k - 1] = self.hists[t, (k - 1) // 2] - h
            else:
                self.sums[t][0] = h[: offsets[1]].sum(axis=0)
        nodes = sorted(hists)
        width = len(offsets) - 1
        drawn = np.repeat(np.array([drawn_columns(width, self.first + t, k, p) for t, k in nodes]), np.diff(offsets), axis=1)
        gain, feature, cut, left = best_splits(np.array([hists[x] for x in nodes]), drawn, offsets, p.forest)
        self.asked, self.hists, self.level = [[] for _ in self.trees], {}, self.level + 1
        for i, (t, k) in enumerate(nodes):
            if gain[i] > LEAST_GAIN:
                tree, sums = self.trees[t], self.sums[t]
                tree.feature[k], tree.bin[k] = feature[i], cut[i]
                sums[2 * k + 1], sums[2 * k + 2] = left[i], sums[k] - left[i]
                if self.level < p.depth:
                    self.hists[t, k] = hists[t, k]
                    self.asked[t].append(2 * k + 1 if 2 * left[i][0] <= sums[k][0] else 2 * k + 2)
        return any(self.asked)

    def finished(self) -> list[Tree]:
        for tree, sums in zip(self.trees, self.sums):
            n = np.maximum(sums[:, 0], 1)
            tree.value[:] = sums[:, 1] / n / (1 if self.p.forest else POINT)
            if self.p.forest:  # sibling leaves of the same class are one leaf
                one = 2 * sums[:, 1] > sums[:, 0]
                for k in range(len(tree.feature) // 2 - 1, -1, -1):
                    a, b = 2 * k + 1, 2 * k + 2
                    if tree.feature[k] >= 0 and tree.feature[a] < 0 and tree.feature[b] < 0 and one[a] == one[b]:
                        tree.feature[k] = -1
        return self.trees


@dataclass
class TreeModel:
    cuts: list[np.ndarray]
    trees: list[Tree]
    params: TreeParams
    features_col: str = "features"

    def probability(self, x: np.ndarray) -> np.ndarray:
        bins = _Bins(H.binned(x, self.cuts))
        out = np.zeros(len(x))
        for t, tree in enumerate(self.trees):
            part = tree.value[tree.leaves(bins, self.params.depth)]
            out += part if self.params.forest or not t else self.params.learning_rate * part
        return out / len(self.trees) if self.params.forest else 1.0 / (1.0 + np.exp(-2.0 * out))

    def transform(self, df: DataFrame, col: str = "p") -> DataFrame:
        """``df`` with the probability of label 1 from its features (array<double>)."""
        schema = df.withColumn(col, F.lit(0.0)).schema
        return df.mapInArrow(partial(_score, self, df.columns.index(self.features_col), col), schema)


def _score(model: TreeModel, at: int, col: str, batches: Iterator[pa.RecordBatch]):
    def scored(held):
        for_all = pa.Table.from_batches(held).combine_chunks()
        x = H.matrix(pa.concat_arrays([b.column(at) for b in held]), len(model.cuts))
        yield from for_all.append_column(col, pa.array(model.probability(x))).to_batches()

    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= SCORE_ROWS:
            yield from scored(held)
            held, n = [], 0
    if n:
        yield from scored(held)


@dataclass
class BinnedRows:
    """Training rows that any number of fits read."""

    cuts: list[np.ndarray]
    blocks: RDD | None
    features_col: str

    def release(self) -> None:
        if self.blocks is not None:
            self.blocks.unpersist()


def bin_rows(df: DataFrame, label_col: str, key_col: str, max_bins: int = 32, features_col: str = "features") -> BinnedRows:
    """The array<double> column ``features_col`` (equal lengths), binned, and the 0/1 column ``label_col``; rows with a null label are
    left out. ``key_col`` tells the rows apart: which trees a row is drawn for follows from it. The blocks are made now: fits that share
    the executors with other jobs would get them dealt unevenly, and every visit waits for the executor that has most."""
    rows = df.where(F.col(label_col).isNotNull()).select(F.col(features_col).alias("x"), F.col(label_col).cast("int").alias("y"), F.xxhash64(key_col).alias("k"))
    head = rows.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("width")).first()
    n, width = head["n"], head["width"] or 0
    if n == 0 or width == 0:
        return BinnedRows([np.zeros(0)] * width, None, features_col)
    cuts = H.halfway_cuts(rows, "x", width, max_bins)
    out = BinnedRows(cuts, H.kept_blocks(rows, cuts, n), features_col)
    out.blocks.count()
    return out


def fit_trees(rows: BinnedRows, params: TreeParams) -> TreeModel:
    """Without rows or features the model is a share of 0 (forest) or a margin of 0."""
    if rows.blocks is None:
        return TreeModel(rows.cuts, [Tree.empty(params.depth)], params, rows.features_col)
    offsets, p = H.offsets_of(rows.cuts), params
    trees = _boosted(rows.blocks, offsets, p) if not p.forest else [
        t for first in range(0, p.trees, GROUP) for t in _forest(rows.blocks, first, min(GROUP, p.trees - first), offsets, p)]
    return TreeModel(rows.cuts, trees, p, rows.features_col)


def _forest(blocks, first: int, count: int, offsets: np.ndarray, p: TreeParams) -> list[Tree]:
    group = _Growing(first, count, offsets, p)
    while group.take(H.added_up(blocks.mapPartitions(partial(_visit_forest, offsets, p, first, group.trees, group.level, group.asked)))):
        pass
    return group.finished()


def _boosted(blocks, offsets: np.ndarray, p: TreeParams) -> list[Tree]:
    sc = blocks.context
    fit, trees, older, n_older = uuid.uuid4().hex, [], sc.broadcast([]), 0
    try:
        while len(trees) < p.trees:
            one = _Growing(len(trees), 1, offsets, p)
            while one.take(H.added_up(blocks.mapPartitions(partial(
                    _visit_boosted, fit, offsets, p, older, trees[n_older:], one.trees[0], one.level, one.asked[0])))):
                pass
            trees += one.finished()
            if len(trees) - n_older >= RECENT:
                older.destroy()
                older, n_older = sc.broadcast(list(trees)), len(trees)
    finally:
        older.destroy()
    return trees
