"""Binned rows as numpy blocks in a persisted RDD, and their sums by node and bin, for the tree fits of ``boosting`` and ``forests``.

Columns whose bins occur together in few ways in a block (the one-hot columns of some categories, two columns of few bins) are kept
as one joint code of two bytes. Rows are added up by code, and the small table of codes is added up by bin, which gives the same
whole numbers as adding up every column.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a block, and of the pieces that blocks are dealt in, about; codes of a joint column at most; tasks a core in a visit.
BLOCK_ROWS, PIECE_ROWS, CODES, TASKS_A_CORE = 1 << 17, 1 << 10, 1 << 10, 2
#: Joint values tried at most for a joint column.
TRIED = 1 << 16
#: Partial sums that the driver adds up itself; more of them are added up by tasks.
COLLECTED = 64


def binned(values: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Bin of each value: the number of cuts below it, plus one; missing values are bin 0."""
    out = np.zeros(values.shape, np.uint8)
    for f, c in enumerate(cuts):
        v = values[:, f]
        out[:, f] = np.where(np.isnan(v), 0, np.searchsorted(c, v, side="left") + 1)
    return out


def matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), width)


def offsets_of(cuts: list[np.ndarray]) -> np.ndarray:
    """First place of each feature in a histogram over all features, and the number of places."""
    return np.cumsum([0, *[len(c) + 2 for c in cuts]])


class Columns:
    """Bins of a block's rows (rows x features) as joint codes ``at`` (rows x joint columns)."""

    def __init__(self, x: np.ndarray) -> None:
        self.n, self.width = x.shape
        codes, self.members, self.values = [], [], []
        for f in range(self.width):
            code, values = _compact(x[:, f].astype(np.int64), np.arange(256)[:, None])
            for j, have in enumerate(self.values):
                k = len(values)
                if len(have) * k <= TRIED:
                    both, pairs = _compact(codes[j] * k + code, np.column_stack([np.repeat(have, k, axis=0), np.tile(values, (len(have), 1))]), CODES)
                    if both is not None:
                        codes[j], self.values[j] = both, pairs
                        self.members[j].append(f)
                        break
            else:
                codes.append(code)
                self.values.append(values)
                self.members.append([f])
        self.values = [v.astype(np.uint8) for v in self.values]
        self.at = np.asfortranarray(np.column_stack(codes).astype(np.uint16)) if codes else np.zeros((self.n, 0), np.uint16)
        self.place = {f: (j, m) for j, members in enumerate(self.members) for m, f in enumerate(members)}

    def __len__(self) -> int:
        return self.n

    def above(self, f: int, b: int, rows: np.ndarray | None = None) -> np.ndarray:
        """Whether the bin of feature ``f`` is above ``b``, for all rows or some."""
        j, m = self.place[f]
        at = self.at[:, j]
        return (self.values[j][:, m] > b)[at if rows is None else at[rows]]

    def by_bin(self, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per joint column the places of its features, and a 0/1 matrix from its codes to them."""
        out = []
        for members, values in zip(self.members, self.values):
            sizes = [int(offsets[f + 1] - offsets[f]) for f in members]
            starts, rows = np.cumsum([0, *sizes]), np.arange(len(values))
            to = np.zeros((len(values), starts[-1]))
            for m, start in enumerate(starts[:-1]):
                to[rows, start + values[:, m].astype(np.int64)] = 1
            out.append((np.concatenate([np.arange(offsets[f], offsets[f + 1]) for f in members]), to))
        return out

    def sums(self, rows: np.ndarray | None, slot: np.ndarray, slots: int, weights: list[np.ndarray | None], places: int, by_bin) -> np.ndarray:
        """(slots, weights, places): sums of the weights (None: rows) of the given rows by slot and bin. Whole numbers below 2 ** 53 are exact."""
        out = np.zeros((slots, len(weights), places))
        for j, (to, codes) in enumerate(by_bin):
            k, at = len(codes), self.at[:, j]
            key = slot * k
            key += at if rows is None else at[rows]
            for s, w in enumerate(weights):
                out[:, s, to] = np.bincount(key, weights=w, minlength=slots * k).reshape(slots, k) @ codes
        return out


def _compact(code: np.ndarray, values: np.ndarray, most: int | None = None):
    """Codes from 0 on of those that occur, with their values; nothing if there are more than ``most``."""
    seen = np.flatnonzero(np.bincount(code, minlength=1))
    if most is not None and len(seen) > most:
        return None, None
    new = np.zeros(len(values), np.int64)
    new[seen] = np.arange(len(seen))
    return new[code], values[seen]


def pieces(cuts: list[np.ndarray], batches: Iterator[pa.RecordBatch], size: int | None = None):
    """Binned rows, ``size`` at a time whatever the size of the batches; the last ones of a partition may be fewer. Batches are
    of features, 0/1 labels and, if need be, row keys."""
    size, held, n = size or BLOCK_ROWS, [], 0

    def piece():
        x, y, k = (np.concatenate(c) for c in zip(*held))
        return pa.RecordBatch.from_pydict({"n": pa.array([len(y)], pa.int64()), "x": [x.tobytes()], "y": [y.tobytes()], "k": [k.tobytes()]})

    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, size - n)
            batch = batch.slice(part.num_rows)
            keys = part.column(2).to_numpy(zero_copy_only=False).astype(np.int64) if part.num_columns > 2 else np.zeros(0, np.int64)
            held.append((binned(matrix(part.column(0), len(cuts)), cuts), part.column(1).to_numpy(zero_copy_only=False).astype(np.uint8), keys))
            n += part.num_rows
            if n == size:
                yield piece()
                held, n = [], 0
    if held:
        yield piece()


def _blocks(width: int, parts: Iterator) -> Iterator[tuple]:
    """(name, columns, labels, keys) of blocks of about BLOCK_ROWS rows. The name is a digest of the rows: what a worker keeps under it
    fits any block of that name."""
    held, n = [], 0

    def block():
        x, y, k = (b"".join(c) for c in zip(*held))
        name = hashlib.blake2b(b"".join((x, y, k)), digest_size=16).digest()
        return name, Columns(np.frombuffer(x, np.uint8).reshape(n, width)), np.frombuffer(y, np.uint8), np.frombuffer(k, np.uint64)

    for r in parts:
        held.append((bytes(r["x"]), bytes(r["y"]), bytes(r["k"])))
        n += r["n"]
        if n >= BLOCK_ROWS:
            yield block()
            held, n = [], 0
    if held:
        yield block()


def kept_blocks(rows: DataFrame, cuts: list[np.ndarray], n_rows: int) -> RDD:
    """The rows (features, 0/1 label, row key if need be) as blocks dealt evenly over tasks, persisted: no more tasks than a block
    or some a core ask for, as every visit pays for each. Only the binned rows are dealt out, a byte a feature."""
    cores, n_blocks = rows.sparkSession.sparkContext.defaultParallelism, -(-n_rows // BLOCK_ROWS)
    tasks = max(1, min(-(-n_rows // (4 * PIECE_ROWS)), cores * min(TASKS_A_CORE, -(-n_blocks // cores))))
    parts = rows.mapInArrow(partial(pieces, cuts, size=PIECE_ROWS), "n long, x binary, y binary, k binary").repartition(tasks)
    return parts.rdd.mapPartitions(partial(_blocks, len(cuts))).persist(StorageLevel.MEMORY_AND_DISK)


def added_up(sums: RDD) -> np.ndarray:
    """The sum of the arrays of all tasks."""
    return sums.treeReduce(lambda a, b: a + b) if sums.getNumPartitions() > COLLECTED else sum(sums.collect())


def _few(width: int, most: int, batches: Iterator[pa.RecordBatch]):
    """The values of each feature in a partition, as far as they are few; one more says that they are not."""
    seen: list = [np.zeros(0)] * width
    for batch in batches:
        x = matrix(batch.column(0), width)
        for f in range(width):
            if len(seen[f]) <= most:
                v = x[:, f]
                seen[f] = np.unique(np.concatenate([seen[f], v[~np.isnan(v)]]))[: most + 1]
    feature = np.repeat(np.arange(width, dtype=np.int32), [len(s) for s in seen])
    yield pa.RecordBatch.from_arrays([pa.array(feature), pa.array(np.concatenate([*seen, np.zeros(0)]))], names=["feature", "value"])


def few_values(df: DataFrame, features_col: str, width: int, most: int) -> list[np.ndarray | None]:
    """Per feature its values in order if they are ``most`` at most, else nothing."""
    seen = df.select(features_col).mapInArrow(partial(_few, width, most), "feature int, value double").distinct()
    rows = seen.groupBy("feature").agg(F.slice(F.sort_array(F.collect_set("value")), 1, most + 1).alias("values")).collect()  # features x most numbers
    values = {r["feature"]: np.array(r["values"]) for r in rows}
    return [v if len(v := values.get(f, np.zeros(0))) <= most else None for f in range(width)]


def quantiles(df: DataFrame, features_col: str, wanted: list[int], bins: int) -> dict[int, np.ndarray]:
    """``bins`` - 1 quantiles (approximate) of each wanted feature, equal ones once."""
    if not wanted:
        return {}
    probs = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    got = df.agg(*[F.percentile_approx(F.when(~F.isnan(v := F.col(features_col)[f]), v), probs, F.lit(max(10_000, 20 * bins))).alias(f"q{f}") for f in wanted]).first()
    return {f: np.unique(np.array(got[f"q{f}"] or [], np.float64)) for f in wanted}


def quantile_cuts(df: DataFrame, features_col: str, width: int, bins: int) -> list[np.ndarray]:
    """At most ``bins`` - 1 ascending cuts per feature (quantiles; all values where they are as few): features x bins numbers."""
    few = few_values(df, features_col, width, bins - 1)
    many = quantiles(df, features_col, [f for f, v in enumerate(few) if v is None], bins)
    return [many[f][: bins - 1] if v is None else v for f, v in enumerate(few)]


def halfway_cuts(df: DataFrame, features_col: str, width: int, bins: int) -> list[np.ndarray]:
    """Cuts halfway between the values of a feature that has at most ``bins`` of them, else ``bins`` - 1 quantiles."""
    few = few_values(df, features_col, width, bins)
    many = quantiles(df, features_col, [f for f, v in enumerate(few) if v is None], bins)
    return [many[f] if v is None else (v[1:] + v[:-1]) / 2 for f, v in enumerate(few)]
