"""ML-6: boosted trees grown leaf by leaf on binned gradient histograms.

Rows are binned once and kept as numpy blocks of joint codes in a persisted RDD (``histograms``): a fit visits them thousands of times,
and what it needs of a visit is a small sum. A visit returns, for some nodes, the histograms (gradient, Hessian, rows per feature and
bin) of the smaller child; the sibling is the parent minus it. The driver holds histograms only: nodes of
one tree x features x bins, whatever the number of rows.

The tree is the best-first one: always the leaf of highest gain splits next, until it has as many leaves as allowed. To
spare visits, one visit expands every leaf that the order known so far would split; a leaf expanded in
vain is folded back, so the tree is that of one split at a time.

Gradients and Hessians are summed as whole numbers (fixed point), so a fit does not depend on partitions or on
the order of additions, given the cuts (approximate quantiles). A block's running scores, gradients and nodes are kept by the Python
worker between visits, 18 bytes a row; a worker that does not have them (a lost executor, another worker) computes them anew from
the trees so far.
"""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators import histograms as H
from riskloom.operators.histograms import binned, quantile_cuts
from riskloom.operators.histograms import matrix as _matrix

#: Fixed point of gradients and Hessians; rows of a block, about; trees sent with a task before they go into a broadcast.
POINT, BLOCK_ROWS, RECENT = 1 << 24, H.BLOCK_ROWS, 25


@dataclass(frozen=True)
class LeafwiseParams:
    rounds: int = 500
    leaves: int = 31
    learning_rate: float = 0.1
    reg_lambda: float = 5.0
    max_bins: int = 255
    min_rows: int = 20
    min_hessian: float = 1e-3
    column_share: float = 0.9
    seed: int = 42


@dataclass
class Tree:
    """Split i cuts leaf ``leaf[i]``: rows with a bin above ``bin[i]`` of ``feature[i]`` go to leaf i + 1."""

    leaf: list[int] = field(default_factory=list)
    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    values: list[float] = field(default_factory=list)
    rows: list[int] = field(default_factory=list)
    gradients: list[int] = field(default_factory=list)
    hessians: list[int] = field(default_factory=list)

    def assign(self, x: np.ndarray | H.Columns) -> np.ndarray:
        out = np.zeros(len(x), np.int16)
        for k, (leaf, f, b) in enumerate(zip(self.leaf, self.feature, self.bin)):
            rows = np.flatnonzero(out == leaf)
            out[rows[x.above(f, b, rows) if isinstance(x, H.Columns) else x[rows, f] > b]] = k + 1
        return out


def gradients(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the log loss by the score, in fixed point (whole numbers held as doubles)."""
    p = 1.0 / (1.0 + np.exp(-score))
    return np.rint((p - y) * POINT), np.rint(p * (1.0 - p) * POINT)


def _blocks(cuts: list[np.ndarray], batches: Iterator[pa.RecordBatch]):
    """Blocks of BLOCK_ROWS rows, whatever the size of the batches; the last one of a partition may be smaller."""
    return H.pieces(cuts, batches, BLOCK_ROWS)


_SCORES: dict = {}


class _Block:
    """A block's rows with their scores after ``trees`` trees and their nodes in the tree that grows."""

    def __init__(self, x: np.ndarray | H.Columns, y: np.ndarray, start: float, offsets: np.ndarray) -> None:
        self.offsets, self.trees, self.score, self.node, self.expanded = offsets, 0, np.full(len(y), start), None, 0
        self.hold(x if isinstance(x, H.Columns) else H.Columns(x), y)

    def hold(self, columns: H.Columns | None, y: np.ndarray | None) -> None:
        """The rows, for a visit: they come with it, so that a worker keeps the scores only."""
        self.columns, self.y = columns, y

    @property
    def at(self) -> np.ndarray:
        return self.columns.at

    def catch_up(self, done: list[Tree]) -> None:
        for tree in done[self.trees :]:
            self.score += np.array(tree.values)[tree.assign(self.columns)]
            self.node = None
        self.trees = len(done)
        if self.node is None:
            self.node, self.expanded = np.zeros(len(self.y), np.int16), 0
            self.g, self.h = (x.astype(np.int32) for x in gradients(self.score, self.y))

    def expand(self, splits: list[tuple[int, int, int, int]]) -> None:
        """Apply the splits (node, feature, bin, left child; the right one is the next number) not applied yet."""
        for node, f, b, left in splits[self.expanded :]:
            rows = np.flatnonzero(self.node == node)
            self.node[rows] = left + self.columns.above(f, b, rows)
        self.expanded = len(splits)

    def histograms(self, nodes: list[int], bins: int) -> np.ndarray:
        """(nodes, places, 3): sums of gradients and Hessians, and rows."""
        slot = np.full(int(self.node.max(initial=0)) + 2, -1, np.int64)
        for k, n in enumerate(nodes):
            if n < len(slot):
                slot[n] = k
        of_row = slot[self.node]
        rows = np.flatnonzero(of_row >= 0)
        rows, of_row = (None, of_row) if len(rows) == len(of_row) else (rows, of_row[rows])
        weights = [(w if rows is None else w[rows]).astype(np.float64) for w in (self.g, self.h)]
        out = self.columns.sums(rows, of_row, len(nodes), [*weights, None], bins, self.columns.by_bin(self.offsets))
        return out.transpose(0, 2, 1).astype(np.int64)


def _visit(fit: str, offsets: np.ndarray, start: float, older, recent: list[Tree], splits, nodes, rows) -> Iterator[np.ndarray]:
    if _SCORES.get("fit") != fit:
        _SCORES.clear()
        _SCORES["fit"] = fit
    done, total = older.value + recent, None
    for name, columns, y, _ in rows:
        block = _SCORES.get(name)
        if block is None or block.trees > len(done) or block.expanded > len(splits) and block.trees == len(done):
            block = _SCORES[name] = _Block(columns, y, start, offsets)
        block.hold(columns, y)
        block.catch_up(done)
        block.expand(splits)
        part = block.histograms(nodes, int(offsets[-1]))
        block.hold(None, None)
        total = part if total is None else total + part
    if total is not None:
        yield total


@dataclass
class _Node:
    hist: np.ndarray
    gain: float = 0.0
    feature: int = -1
    bin: int = -1
    left_rows: int = 0
    children: tuple[int, int] | None = None


def _best_split(hist: np.ndarray, offsets: np.ndarray, drawn: np.ndarray, p: LeafwiseParams) -> _Node:
    """The node with its split of highest gain; of equal ones the first by (feature, bin). Gain 0: none."""
    out = _Node(hist)
    sums = hist.cumsum(axis=0)
    total = sums[offsets[1] - 1]
    left = sums - np.repeat(np.vstack([np.zeros((1, 3), np.int64), sums[offsets[1:-1] - 1]]), np.diff(offsets), axis=0)
    right = total - left
    lam = p.reg_lambda * POINT
    ok = drawn & (np.minimum(left[:, 2], right[:, 2]) >= p.min_rows) & (np.minimum(left[:, 1], right[:, 1]) >= p.min_hessian * POINT)
    if not ok.any():
        return out

    def term(x):
        return x[..., 0].astype(np.float64) ** 2 / (x[..., 1] + lam)

    gain = np.where(ok, (term(left) + term(right) - term(total)) / POINT, 0.0)
    k = int(np.argmax(gain))
    if gain[k] > 1e-9:
        out.gain, out.feature, out.left_rows = float(gain[k]), int(np.searchsorted(offsets, k, side="right")) - 1, int(left[k, 2])
        out.bin = k - int(offsets[out.feature])
    return out


@dataclass
class LeafwiseModel:
    cuts: list[np.ndarray]
    start: float
    trees: list[Tree]
    params: LeafwiseParams

    def score(self, df: DataFrame, features_col: str = "features", col: str = "p") -> DataFrame:
        """``df`` with the probability of label 1 from the array<double> column ``features_col``."""
        schema = df.withColumn(col, F.lit(0.0)).schema
        return df.mapInArrow(partial(_score, self, df.columns.index(features_col), col), schema)

    def leaf_sums(self, df: DataFrame, features_col: str, label_col: str) -> DataFrame:
        """(tree, leaf, n, gradient, hessian) of the rows of ``df``, counted again from the rows alone: each tree's leaves with the
        gradients (fixed point) that the rows have after the trees before it."""
        rows = df.select(features_col, F.col(label_col).cast("int"))
        parts = rows.mapInArrow(partial(_sums, self), "tree int, leaf int, n long, gradient long, hessian long")
        return parts.groupBy("tree", "leaf").agg(*[F.sum(c).alias(c) for c in ("n", "gradient", "hessian")])

    def leaf_table(self, spark) -> DataFrame:
        """(tree, leaf, n, gradient, hessian, value) as fitted."""
        rows = [(t, k, tree.rows[k], tree.gradients[k], tree.hessians[k], tree.values[k]) for t, tree in enumerate(self.trees) for k in range(len(tree.values))]
        return spark.createDataFrame(rows, "tree int, leaf int, n long, gradient long, hessian long, value double")


def _score(model: LeafwiseModel, at: int, col: str, batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        x = binned(_matrix(batch.column(at), len(model.cuts)), model.cuts)
        score = np.full(len(x), model.start)
        for tree in model.trees:
            score += np.array(tree.values)[tree.assign(x)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1.0 / (1.0 + np.exp(-score)))], names=[*batch.schema.names, col])


def _sums(model: LeafwiseModel, batches: Iterator[pa.RecordBatch]):
    sums: dict = {}
    for batch in batches:
        x = binned(_matrix(batch.column(0), len(model.cuts)), model.cuts)
        y = batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
        score = np.full(len(x), model.start)
        for t, tree in enumerate(model.trees):
            leaf, (g, h) = tree.assign(x), gradients(score, y)
            k = len(tree.values)
            part = np.stack([np.bincount(leaf, weights=w, minlength=k).astype(np.int64) for w in (None, g, h)], axis=1)
            sums[t] = sums.get(t, 0) + part
            score += np.array(tree.values)[leaf]
    rows = [(t, k, *v) for t, part in sums.items() for k, v in enumerate(part.tolist())]
    names = ["tree", "leaf", "n", "gradient", "hessian"]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def fit_leafwise(df: DataFrame, label_col: str, features_col: str = "features", params: LeafwiseParams = LeafwiseParams()) -> LeafwiseModel:
    """Fit on the array<double> column ``features_col`` (equal lengths) and the 0/1 column ``label_col``.

    Rows with a null label are left out. Missing values (NaN, null) are a bin of their own below all others. Without rows or with one class only the
    model is the constant share. A tree without a split of positive gain ends the fit, as all later ones would be the same
    unless columns are drawn; with drawn columns it is a single leaf.
    """
    spark = df.sparkSession
    rows = df.where(F.col(label_col).isNotNull()).select(
        F.transform(F.col(features_col), lambda v: F.coalesce(v.cast("double"), F.lit(float("nan")))).alias("x"), F.col(label_col).cast("int").alias("y"))
    head = rows.agg(F.count("*").alias("n"), F.sum("y").alias("pos"), F.max(F.size("x")).alias("width")).first()
    n, pos, width = head["n"], head["pos"] or 0, head["width"] or 0
    if n == 0 or pos in (0, n) or width == 0:
        edge = 1e-15
        share = min(max(pos / n if n else 0.5, edge), 1 - edge)
        return LeafwiseModel([np.zeros(0)] * width, float(np.log(share / (1 - share))), [], params)
    cuts = quantile_cuts(rows, "x", width, params.max_bins)
    start, offsets = float(np.log(pos / (n - pos))), H.offsets_of(cuts)
    blocks = H.kept_blocks(rows, cuts, n)
    fit, sc = uuid.uuid4().hex, spark.sparkContext
    trees: list[Tree] = []
    older, n_older = sc.broadcast([]), 0
    rng = np.random.default_rng(params.seed)

    def visit(splits, nodes):
        return H.added_up(blocks.mapPartitions(partial(_visit, fit, offsets, start, older, trees[n_older:], splits, nodes)))

    try:
        while len(trees) < params.rounds:
            columns = np.sort(rng.permutation(width)[: max(1, int(round(params.column_share * width)))])
            drawn = np.repeat(np.isin(np.arange(width), columns), np.diff(offsets))
            tree = _grow(visit, offsets, drawn, params)
            trees.append(tree)
            if len(tree.values) == 1 and len(columns) == width:
                break
            if len(trees) - n_older >= RECENT:
                older.destroy()
                older, n_older = sc.broadcast(list(trees)), len(trees)
    finally:
        older.destroy()
        blocks.unpersist()
    return LeafwiseModel(cuts, start, trees, params)


def _grow(visit, offsets: np.ndarray, drawn: np.ndarray, p: LeafwiseParams) -> Tree:
    nodes = [_best_split(visit([], [0])[0], offsets, drawn, p)]
    splits: list[tuple[int, int, int, int]] = []
    while True:
        # the order known so far; a leaf whose children are not known yet counts as split, and is expanded next
        heap, order, unknown = [(-nodes[0].gain, 0)], [], []
        while heap and len(order) + 1 < p.leaves:
            gain, k = heapq.heappop(heap)
            if gain == 0:
                break
            order.append(k)
            if nodes[k].children is None:
                unknown.append(k)
            else:
                for c in nodes[k].children:
                    heapq.heappush(heap, (-nodes[c].gain, c))
        if not unknown:
            break
        asked = []
        for k in unknown:
            node, left = nodes[k], len(nodes)
            node.children = (left, left + 1)
            splits.append((k, node.feature, node.bin, left))
            asked.append(left if 2 * node.left_rows <= int(node.hist[: offsets[1], 2].sum()) else left + 1)
            nodes += [None, None]
        for k, child, hist in zip(unknown, asked, visit(splits, asked)):
            other = sum(nodes[k].children) - child
            nodes[child] = _best_split(hist, offsets, drawn, p)
            nodes[other] = _best_split(nodes[k].hist - hist, offsets, drawn, p)
    tree, leaf_of = Tree(), {0: 0}
    for i, k in enumerate(order):
        left, right = nodes[k].children
        tree.leaf.append(leaf_of[k])
        tree.feature.append(nodes[k].feature)
        tree.bin.append(nodes[k].bin)
        leaf_of[left], leaf_of[right] = leaf_of.pop(k), i + 1
    for k in sorted(leaf_of, key=leaf_of.get):
        g, h, n = nodes[k].hist[: offsets[1]].sum(axis=0).tolist()
        tree.values.append(-p.learning_rate * g / (h + p.reg_lambda * POINT))
        tree.rows.append(n)
        tree.gradients.append(g)
        tree.hessians.append(h)
    return tree
