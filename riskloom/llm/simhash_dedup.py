"""SimHash near-duplicates: all fingerprint pairs within a Hamming distance, found by vantage-point trees.

The distinct fingerprints are dealt to the leaves of a shallow tree. Its vantage points and median radii are
fitted on a bounded sample (they steer cost only; every fingerprint is routed). A fingerprint lives in the one leaf
that its distances lead to, and is sent as a query to every leaf that the triangle inequality cannot exclude:
at a node with radius m and distance d to the vantage point, the near side is excluded if d - r > m,
the far side if d + r <= m. Inside a leaf a task builds the tree further over all of the leaf's rows and
prunes the same way, down to small blocks that are compared outright, so the pairs are exact.
A leaf task emits a spanning forest of its links, never all pairs; components join the forests.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.components import components
from riskloom.llm.words import Words, text_buffer
from riskloom.session import ensure_checkpoint_dir

SHINGLE_WORDS = 4
MAX_BITS = 4
#: Rows of a leaf shard, about; rows of the sample that the shards' tree is fitted on.
LEAF_ROWS = 4096
SAMPLE_ROWS = 8192
#: Blocks compared outright inside a leaf.
BLOCK_ROWS = 192


def fingerprint(words: list[bytes], shingle: int) -> int:
    """Bit i is 1 if set in over half of the hashes of the shingles (repeats counted); no words: 0."""
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])[: len(words) - shingle + 1].tolist()
    ends = (ends[shingle - 1 :] - 1).tolist()
    h = xxhash.xxh64_intdigest
    return _majority(np.array([h(line[s:e], 42) for s, e in zip(starts, ends)], np.uint64))


def _majority(hashes: np.ndarray) -> int:
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 8192):
        counts += np.unpackbits(hashes[i : i + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int, batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        raw, offsets = text_buffer(batch.column(batch.num_columns - 1))
        out = np.zeros(len(offsets) - 1, np.uint64)
        for i in range(len(out)):
            out[i] = fingerprint(raw[offsets[i] : offsets[i + 1]].tobytes().lower().split(), shingle)
        columns = [batch.column(k) for k in range(batch.num_columns - 1)]
        names = [f"c{k}" for k in range(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(out.view(np.int64))], names=[*names, "fp"])


def fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE_WORDS, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns and ``fp``, the 64-bit SimHash of each whole text as a signed long."""
    keep = keep if keep is not None else [c for c in docs.columns if c != text_col]
    fields = "".join(f"c{k} {docs.schema[c].dataType.simpleString()}, " for k, c in enumerate(keep))
    out = docs.select(*[F.col(c) for c in keep], F.col(text_col).cast("string")).mapInArrow(partial(_fingerprints, shingle), f"{fields}fp long")
    return out.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(keep)], "fp")


class VantageTree:
    """A binary tree over 64-bit fingerprints: node k has children 2k+1 (distance <= radius) and 2k+2."""

    def __init__(self, points: np.ndarray, depth: int) -> None:
        self.depth = depth
        nodes = (1 << depth) - 1
        self.vantage, self.radius = np.zeros(nodes, np.uint64), np.zeros(nodes, np.int64)
        self._fit(points, 0, 0)

    def _fit(self, points: np.ndarray, node: int, level: int) -> None:
        if level == self.depth:
            return
        if len(points):
            self.vantage[node], self.radius[node], near = _split(points)
            self._fit(points[near], 2 * node + 1, level + 1)
            self._fit(points[~near], 2 * node + 2, level + 1)
        else:
            self._fit(points, 2 * node + 1, level + 1)
            self._fit(points, 2 * node + 2, level + 1)

    def leaves(self, points: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of point, leaf) for every leaf that may hold something within ``reach`` of the point."""
        at, node = np.arange(len(points)), np.zeros(len(points), np.int64)
        for _ in range(self.depth):
            d = np.bitwise_count(points[at] ^ self.vantage[node]).astype(np.int64)
            near, far = d - reach <= self.radius[node], d + reach > self.radius[node]
            at, node = np.concatenate([at[near], at[far]]), np.concatenate([2 * node[near] + 1, 2 * node[far] + 2])
        return at, node - ((1 << self.depth) - 1)


def _split(points: np.ndarray) -> tuple[np.uint64, int, np.ndarray]:
    """Of a few candidate vantage points the one whose median radius splits most evenly; ties: the first."""
    best = None
    for v in points[np.linspace(0, len(points) - 1, min(5, len(points))).astype(int)]:
        d = np.bitwise_count(points ^ v).astype(np.int64)
        m = int(np.median(d))
        near = d <= m
        for radius, side in ((m, near), (m - 1, d <= m - 1)):
            uneven = abs(int(side.sum()) * 2 - len(points))
            if best is None or uneven < best[0]:
                best = (uneven, v, radius, side)
    return best[1:]


class _Links:
    """Pairs gathered so far, kept as a spanning forest."""

    def __init__(self, n: int) -> None:
        self.root, self.edges, self.n_held, self.held = np.arange(n), [], 0, []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.held.append((a, b))
        self.n_held += len(a)
        if self.n_held > 1 << 18:
            self.merge()

    def merge(self) -> None:
        """Min-label hooking with pointer jumping; a hook that changes a root is a forest edge."""
        if not self.held:
            return
        a, b = (np.concatenate(x) for x in zip(*self.held))
        self.held, self.n_held = [], 0
        while len(a):
            ra, rb = self.root[a], self.root[b]
            differ = ra != rb
            a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
            if not len(a):
                break
            high, low = np.maximum(ra, rb), np.minimum(ra, rb)
            order = np.lexsort((low, high))
            first = order[np.append(True, high[order][1:] != high[order][:-1])]
            self.root[high[first]] = low[first]
            self.edges.append((a[first], b[first]))
            while True:
                up = self.root[self.root]
                if np.array_equal(up, self.root):
                    break
                self.root = up


def _within(points: np.ndarray, own: np.ndarray, asks: np.ndarray, reach: int, links: _Links) -> None:
    """Links between ``own`` rows and ``asks`` rows (indexes into points) within ``reach`` bits."""
    todo = [(own, asks)]
    while todo:
        own, asks = todo.pop()
        if not len(own) or not len(asks):
            continue
        if len(own) <= BLOCK_ROWS:
            for i in range(0, len(asks), 4096):
                part = asks[i : i + 4096]
                close = np.bitwise_count(points[part][:, None] ^ points[own][None, :]) <= reach
                x, y = np.nonzero(close)
                x, y = part[x], own[y]
                links.add(x[x != y], y[x != y])
            continue
        v, radius, near = _split(points[own])
        if near.all() or not near.any():  # no radius splits these: compare in blocks
            todo += [(own[i : i + BLOCK_ROWS], asks) for i in range(0, len(own), BLOCK_ROWS)]
            continue
        d = np.bitwise_count(points[asks] ^ v).astype(np.int64)
        todo += [(own[near], asks[d - reach <= radius]), (own[~near], asks[d + reach > radius])]


_ROUTED = "leaf int, home boolean, fps binary"
_ROUTED_ARROW = pa.schema([("leaf", pa.int32()), ("home", pa.bool_()), ("fps", pa.binary())])


def _route(tree: VantageTree, reach: int, batches: Iterator[pa.RecordBatch]):
    """Fingerprints packed by leaf: those that live there, and those that ask there from other leaves."""
    for batch in batches:
        points = batch.column(0).to_numpy().view(np.uint64)
        at, leaf = tree.leaves(points, reach)
        own_at, own_leaf = tree.leaves(points, 0)
        home = np.zeros(len(points), np.int64)
        home[own_at] = own_leaf
        rows = []
        is_home = leaf == home[at]
        for flag in (True, False):
            which = is_home == flag
            p, l = points[at[which]], leaf[which]
            order = np.argsort(l, kind="stable")
            l, p = l[order], p[order]
            cuts = np.flatnonzero(np.append(True, l[1:] != l[:-1])) if len(l) else []
            rows += [{"leaf": int(l[i]), "home": flag, "fps": p[i:j].tobytes()} for i, j in zip(cuts, [*cuts[1:], len(l)])]
        yield from pa.Table.from_pylist(rows, schema=_ROUTED_ARROW).to_batches()


def _leaf_links(reach, key, table):
    join = lambda flag: np.frombuffer(b"".join(r["fps"] for r in rows if r["home"] == flag), np.uint64)
    rows = table.to_pylist()
    own, asks = np.sort(join(True)), np.sort(join(False))
    points = np.concatenate([own, asks])
    links = _Links(len(points))
    everyone = np.arange(len(points))
    _within(points, everyone[: len(own)], everyone, reach, links)
    links.merge()
    a = np.concatenate([x for x, _ in links.edges]) if links.edges else np.zeros(0, np.int64)
    b = np.concatenate([x for _, x in links.edges]) if links.edges else a
    return pa.table({"a": points[a].view(np.int64), "b": points[b].view(np.int64)})


def similar_fingerprints(fps: DataFrame, reach: int = MAX_BITS, leaf_rows: int = LEAF_ROWS, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """A forest (a, b) that connects what chains of distances <= ``reach`` connect; fps: distinct longs ``fp``."""
    n = fps.count()
    depth = max(0, math.ceil(math.log2(max(n, 1) / leaf_rows)))
    # the sample fits the tree only; its size is a parameter
    drawn = fps.orderBy(F.xxhash64(F.lit(7), "fp")).limit(sample_rows).collect() if depth else []
    tree = VantageTree(np.array([r["fp"] for r in drawn], np.int64).view(np.uint64), depth)
    routed = fps.select("fp").mapInArrow(partial(_route, tree, reach), _ROUTED)
    return routed.groupBy("leaf").applyInArrow(partial(_leaf_links, reach), "a long, b long")


def linked_fingerprints(fps: DataFrame, reach: int = MAX_BITS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """``fps`` (distinct longs ``fp``, further columns) with ``root``, one fingerprint per component."""
    linked = components(similar_fingerprints(fps.select("fp"), reach, leaf_rows)).checkpoint()
    return fps.join(linked, fps.fp == linked.node, "left").select(*[fps[c] for c in fps.columns], F.coalesce("root", "fp").alias("root"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS,
                       reach: int = MAX_BITS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(``id_col``, fp, component_id) of each row: components of fingerprints linked at ``reach`` or fewer differing bits.

    component_id is the smallest id reachable (itself included).

    Defined cases: null, empty or wordless texts have fingerprint zero and link like any other; texts
    with fewer words than a shingle hash the whole sequence; rows of one id keep one row each; a row with a
    null id has its component's smallest non-null id, or null if there is none; an empty table gives an empty
    one; further columns are ignored, whatever their names.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    rows = fingerprints(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), "text", shingle, ["id"]).checkpoint()
    distinct = rows.groupBy("fp").agg(F.min("id").alias("least")).checkpoint()
    own = linked_fingerprints(distinct, reach, leaf_rows)
    least = own.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = own.join(least, "root").select("fp", "component_id")
    return rows.join(of_fp, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS,
                      reach: int = MAX_BITS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """Of each component of fingerprints one row, with the columns of ``docs``.

    It is the first by id (null ids last), then by hashes of the text and of the whole row; of rows equal in all
    of these, the first of the frozen table. Rows without id, repeated ids and repeated rows are rows like any
    other. Rows are reduced to one per fingerprint before components come in, so a group of copies, however
    large, is one row per map task.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    whole = F.xxhash64(*docs.columns, *[F.col(c).isNull() for c in docs.columns])  # a null alone does not change the hash
    frozen = docs.withColumn("_row", F.monotonically_increasing_id()).checkpoint()
    keys = frozen.select("_row", F.col(id_col).cast("long").alias("_id"), F.xxhash64(text_col).alias("_text"), whole.alias("_whole"), F.col(text_col).alias("text"))
    rows = fingerprints(keys)
    first = F.min(F.struct(F.col("_id").isNull().alias("no_id"), "_id", "_text", "_whole", "_row")).alias("first")
    distinct = rows.groupBy("fp").agg(first).checkpoint()
    found = linked_fingerprints(distinct, reach, leaf_rows).groupBy("root").agg(F.min("first").alias("first"))
    return frozen.join(found.select(F.col("first._row").alias("_row")), "_row", "left_semi").select(*docs.columns)


def op10_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document (4-word shingles, 4 bits)."""
    out = simhash_components(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
