"""Documents dealt into parts that are ascending ranges of the id, and questions between parts.

``gather`` moves every row once: map tasks pack their rows by part into compressed Arrow blocks,
one shuffle brings the blocks of a part together, and a reliable checkpoint keeps them there.
Later steps visit a part (``visit``) or a part with the answers to its questions
(``visit_with``) without moving the texts again: a checkpoint keeps its hash partitioning, so only
the small other side is shuffled.

Questions go the other way: a part sends its distinct keys, sorted and cut into buckets by their
top bits, as packed arrays; one task per bucket sees a key's packed entries of all parts and
answers with packed arrays in the order of the keys. A key, however frequent, is one entry per
part.
"""

from __future__ import annotations

import ctypes
import math
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import ensure_checkpoint_dir

#: Text bytes of a part; a task holds one part at a time.
PART_BYTES = 8 << 20
#: Rows dealt at a time, bytes of them that ``items`` gets at a time, and bytes that a map task holds before it packs them.
DEAL_ROWS, ITEM_BYTES, HELD_BYTES = 1024, 16 << 20, 24 << 20
BLOCK_SCHEMA = "part int, n_rows long, n_items long, block binary"


class Parts:
    """The dealt table and what is known of it. Part p of 0..ranges-1 holds ids in (bounds[p-1], bounds[p]];
    the parts from ``ranges`` on hold the rows without id, dealt by their text."""

    def __init__(self, table: DataFrame, bounds: list[int], n_null: int, buckets: int, partitions: int) -> None:
        self.table, self.bounds, self.n_null, self.buckets, self.partitions = table, bounds, n_null, buckets, partitions

    @property
    def ranges(self) -> int:
        return len(self.bounds) + 1

    def visit(self, f: Callable, schema: str) -> DataFrame:
        """f(part, table of its blocks) -> Arrow table, for each part."""
        return self.table.groupBy("part").applyInArrow(partial(_one, f), schema)

    def visit_with(self, other: DataFrame, f: Callable, schema: str) -> DataFrame:
        """f(part, its blocks, rows of ``other`` with that part) -> Arrow table."""
        other = other.withColumn("_part", F.col("part").cast("int")).drop("part")  # may descend from this very table
        return self.table.groupBy("part").cogroup(other.groupBy("_part")).applyInArrow(partial(_two, f), schema)


def _one(f, key, table):
    out = f(key[0].as_py(), table)
    give_back()
    return out


def _two(f, key, left, right):
    out = f(key[0].as_py(), left, right)
    give_back()
    return out


def give_back() -> None:
    """Return freed memory to the system: workers are reused, and an idle one must not keep what its last part took."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # a C library without it
        pass


def _pack(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def unpack(blocks: pa.Table) -> pa.Table:
    """The rows of a part in ascending order of the id (rows of one id: by their text), null ids last."""
    table = pa.concat_tables([pa.ipc.open_stream(b.as_buffer()).read_all() for b in blocks["block"].combine_chunks()])
    return table.sort_by([("_id", "ascending"), ("_order", "ascending")])


def _slices(batches: Iterator[pa.RecordBatch], n_bytes: int) -> Iterator[pa.RecordBatch]:
    """Batches of DEAL_ROWS rows, or of more up to about ``n_bytes``."""
    held, size = [], 0
    for batch in (b.slice(i, DEAL_ROWS) for b in batches for i in range(0, b.num_rows, DEAL_ROWS)):
        if held and size + batch.nbytes > n_bytes:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield pa.concat_batches(held)


def _deal(items: Callable | None, after: Callable | None, id_col: str, text_col: str, bounds: list[int], n_null: int, batches: Iterator[pa.RecordBatch]):
    from riskloom.llm.words import text_buffer

    cuts, held, size = np.array(bounds, np.int64), {}, 0

    def flush():
        for p, rows in held.items():
            t = pa.concat_tables(rows)
            n_items = int(np.sum(t["_n"].to_numpy())) if "_n" in t.column_names else 0
            yield pa.RecordBatch.from_pylist(
                [{"part": p, "n_rows": len(t), "n_items": n_items, "block": _pack(t)}],
                schema=pa.schema([("part", pa.int32()), ("n_rows", pa.int64()), ("n_items", pa.int64()), ("block", pa.binary())]),
            )
        held.clear()

    for batch in _slices(batches, ITEM_BYTES if items is not None else 0):
        ids = batch.column(batch.schema.names.index(id_col)).cast(pa.int64())
        raw, offsets = text_buffer(batch.column(batch.schema.names.index(text_col)))
        data, at = memoryview(raw), offsets.tolist()
        name = np.array([xxhash.xxh3_64_intdigest(data[i:j]) for i, j in zip(at[:-1], at[1:])], np.uint64)
        missing = ids.is_null().to_numpy(zero_copy_only=False)
        part = np.searchsorted(cuts, ids.fill_null(0).to_numpy(), side="left").astype(np.int64)
        part[missing] = len(cuts) + 1 + (name[missing] % np.uint64(max(n_null, 1))).astype(np.int64)
        table = pa.Table.from_batches([batch]).rename_columns([f"c{k}" for k in range(batch.num_columns)])
        table = table.append_column("_id", ids).append_column("_order", pa.array(name.view(np.int64)))
        if items is not None:
            table = items(table, f"c{batch.schema.names.index(text_col)}")
        for p in np.unique(part):
            piece = table.take(pa.array(np.flatnonzero(part == p)))
            held.setdefault(int(p), []).append(piece)
        size += table.nbytes
        if size > HELD_BYTES:
            yield from flush()
            size = 0
    yield from flush()
    if after is not None:
        after()
    give_back()


def gather(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None,
           items: Callable | None = None, part_bytes: int = PART_BYTES, after: Callable | None = None) -> Parts:
    """Deal ``docs`` into parts by ranges of ``id_col``.

    The block of a part holds columns c0.. (``carry`` in order, default id and text), ``_id``, ``_order``
    (breaks ties of the id by the text), and what ``items`` adds in the map task, which may replace the
    text by something derived (its row counts in ``_n`` are summed in ``n_items``); ``after`` runs at the end of a
    map task, to free what ``items`` keeps. The ranges are
    approximate quantiles of the id, one number per part on the driver. All rows of an id share a part.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    carry = carry or [id_col, text_col]
    size = F.coalesce(F.octet_length(text_col), F.lit(0)) + 64
    total = docs.agg(F.sum(size).alias("bytes"), F.sum(F.when(F.col(id_col).isNull(), size)).alias("nulls")).first()
    n = max(1, math.ceil((total["bytes"] or 0) / part_bytes))
    n_null = math.ceil((total["nulls"] or 0) / part_bytes)
    bounds: list[int] = []
    if n > 1:
        probs = F.array(*[F.lit(i / n) for i in range(1, n)])
        found = docs.agg(F.percentile_approx(F.col(id_col).cast("long"), probs, F.lit(max(10_000, 20 * n))).alias("b")).first()["b"]
        bounds = sorted(set(found or []))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = docs.select(*[F.col(c) for c in carry]).mapInArrow(
        partial(_deal, items, after, id_col, text_col, bounds, n_null), BLOCK_SCHEMA
    )
    # a plan that AQE may change again does not tell its partitioning; the checkpoint is to keep it
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        table = blocks.repartition(partitions, "part").checkpoint()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    buckets = 1 << max(0, math.ceil(math.log2(max(n, 1))))
    return Parts(table, bounds, n_null, buckets, partitions)


# --- packed arrays ---------------------------------------------------------------------------

def pack_numbers(x: np.ndarray) -> bytes:
    """Fixed-width numbers, byte planes apart so that constant planes compress away."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack_numbers(data: bytes, dtype, n: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(np.dtype(dtype).itemsize, n)
    return np.ascontiguousarray(planes.T).view(dtype).reshape(n)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending unsigned keys as packed differences."""
    return pack_numbers(np.diff(keys, prepend=np.uint64(0)).astype(np.uint64))


def unpack_sorted(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpack_numbers(data, np.uint64, n), dtype=np.uint64)


def bucket_edges(keys: np.ndarray, buckets: int, bits: int) -> np.ndarray:
    """Where each of ``buckets`` (a power of two) equal ranges of ``bits``-bit keys begins in sorted keys."""
    step = bits - int(math.log2(buckets))
    return np.append(np.searchsorted(keys, np.arange(buckets, dtype=np.uint64) << np.uint64(step)), len(keys))


def running_totals(table: DataFrame, key: str, value: str, run: int = 4096) -> DataFrame:
    """(key, value, before): the sum of ``value`` over all smaller keys. Keys are distinct whole numbers.

    In two steps, so that no task sees more than ``run`` keys or one sum per ``run`` keys.
    """
    from pyspark.sql import Window as W

    rows = table.select(key, value, F.floor(F.col(key) / run).alias("_run"))
    sums = rows.groupBy("_run").agg(F.sum(value).alias("_sum"))
    earlier = F.sum("_sum").over(W.orderBy("_run").rowsBetween(W.unboundedPreceding, -1))
    within = F.sum(value).over(W.partitionBy("_run").orderBy(key).rowsBetween(W.unboundedPreceding, -1))
    out = rows.withColumn("_in", F.coalesce(within, F.lit(0))).join(sums.select("_run", F.coalesce(earlier, F.lit(0)).alias("_out")), "_run")
    return out.select(key, value, (F.col("_in") + F.col("_out")).cast("long").alias("before"))


# --- counts of keys over all parts ------------------------------------------------------------

_COUNT_ASK = "part int, bucket int, n long, keys binary, counts binary"
_COUNT_ANSWER = "part int, bucket int, n long, counts binary, known long, total long"
_COUNT_ASK_ARROW = pa.schema([("part", pa.int32()), ("bucket", pa.int32()), ("n", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
_COUNT_ANSWER_ARROW = pa.schema([("part", pa.int32()), ("bucket", pa.int32()), ("n", pa.int64()), ("counts", pa.binary()), ("known", pa.int64()), ("total", pa.int64())])


def _ask_counts(keys_of, buckets, part, blocks):
    keys, counts = keys_of(unpack(blocks))
    edges, rows = bucket_edges(keys, buckets, 64), []
    for k in range(buckets):
        i, j = int(edges[k]), int(edges[k + 1])
        if i < j:
            rows.append({"part": part, "bucket": k, "n": j - i, "keys": pack_sorted(keys[i:j]), "counts": pack_numbers(counts[i:j])})
    return pa.Table.from_pylist(rows, schema=_COUNT_ASK_ARROW)


def _answer_counts(key, table):
    rows = table.to_pylist()
    keys = np.concatenate([unpack_sorted(r["keys"], r["n"]) for r in rows])
    counts = np.concatenate([unpack_numbers(r["counts"], np.int64, r["n"]) for r in rows])
    order = np.argsort(keys, kind="stable")
    new = np.append(True, keys[order][1:] != keys[order][:-1])
    sums = np.add.reduceat(counts[order], np.flatnonzero(new))
    back = np.zeros(len(keys), np.int64)
    back[order] = sums[np.cumsum(new) - 1]
    out, at = [], 0
    for r in rows:
        out.append({"part": r["part"], "bucket": r["bucket"], "n": r["n"], "counts": pack_numbers(back[at : at + r["n"]]), "known": int((sums > 0).sum()), "total": int(sums.sum())})
        at += r["n"]
    del keys, counts, order, back
    give_back()
    return pa.Table.from_pylist(out, schema=_COUNT_ANSWER_ARROW)


def count_keys(dealt: Parts, keys_of: Callable) -> tuple[DataFrame, int, int]:
    """Sum counts of 64-bit keys over all parts, and tell every part the sums of its own keys.

    keys_of(table of a part) -> (ascending distinct keys, int64 counts). Returns the answers (for ``visit_with`` and
    ``read_counts``), the number of keys with a sum over 0, and the sum over all.
    """
    answers = dealt.visit(partial(_ask_counts, keys_of, dealt.buckets), _COUNT_ASK).groupBy("bucket").applyInArrow(_answer_counts, _COUNT_ANSWER).checkpoint()
    per_bucket = answers.groupBy("bucket").agg(F.max("known").alias("known"), F.max("total").alias("total"))
    r = per_bucket.agg(F.sum("known").alias("known"), F.sum("total").alias("total")).first()
    return answers, r["known"] or 0, r["total"] or 0


def read_counts(answers: pa.Table) -> np.ndarray:
    """The sums of a part's keys, in the order of its keys."""
    rows = sorted(answers.select(["bucket", "n", "counts"]).to_pylist(), key=lambda r: r["bucket"])
    return np.concatenate([unpack_numbers(r["counts"], np.int64, r["n"]) for r in rows]) if rows else np.zeros(0, np.int64)
