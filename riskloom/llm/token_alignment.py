"""Cross-tokenizer alignment: which ids of two tokenizers share bytes, and in how many documents each pair does.

A text is read by a byte-level BPE (A) and a piece BPE with byte fallback (B). Where tokens of both end at the
same byte, the text is cut into groups; within a group every A token is linked with every B token.

Pairs are counted over the corpus by external spill counting. Map tasks take blocks of documents, sort the block's
pairs A-major and spill them, radix-partitioned by (dealt) A id, as zstd runs of (pair, documents of the block) into a table of
the shared folder, beside the block's own pair-document records in the same order. One task per radix merges its
runs with heaps; as runs are sorted by A first, an A id's maximum is known when its last pair has passed,
and the counts go back run by run in the order of the run, so a block needs no keys to read them.
A pair, however frequent, is one entry per block.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import math
import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.parts import pack_numbers, pack_sorted, unpack_numbers, unpack_sorted
from riskloom.session import ensure_checkpoint_dir

#: Characters of a block, entries of a frame of a run, links of a group beyond which its ids are counted first.
BLOCK_BYTES, FRAME, WIDE = 4 << 20, 1 << 15, 4096
#: Fixed value: the split pattern of the byte-level tokenizer.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Text bytes for each radix, about (more radices where the session has more shuffle partitions).
RADIX_BYTES = 256 << 20

_SPILL = "kind int, block long, radix int, n long, data binary"
_SPILL_ARROW = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("radix", pa.int32()), ("n", pa.int64()), ("data", pa.binary())])
_ANSWER = "block long, radix int, n long, counts binary, best binary"
_ANSWER_ARROW = pa.schema([("block", pa.int64()), ("radix", pa.int32()), ("n", pa.int64()), ("counts", pa.binary()), ("best", pa.binary())])
_STATS = ["n_a", "n_b", "n_groups", "n_links"]
_OUT = "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_OUT_ARROW = pa.schema([("id", pa.int64()), *[(c, pa.int64()) for c in [*_STATS, "n_best", "count_sum"]], ("groups_sha256", pa.string())])


class Sides:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, byte_bpe: str, piece_bpe: str) -> None:
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.plain = Tokenizer.from_file(byte_bpe)
        self.plain.encode_special_tokens = True  # their strings in a text are ordinary text
        printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
        char = {chr(b): b for b in printable}
        char.update({chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in printable)})
        token = {i: bytes(char[c] for c in t) for t, i in self.plain.get_vocab(with_added_tokens=False).items() if all(c in char for c in t)}
        self.a_bytes = [token.get(i, b"") for i in range(max(token) + 1)]
        with open(byte_bpe) as f:
            model = json.load(f)["model"]
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        # merges in the order of the ids they make are a rank table, which the faster library reads
        self.ranked = None
        if merged == sorted(set(merged)) and len(merged) + 256 == len(set(token.values()) - {b""}) - (b"<|endoftext|>" in token.values()):
            ranks = {x: i for i, x in token.items() if x != b"<|endoftext|>"}
            self.ranked = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_bpe)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        n = max(len(self.a_bytes), len(self.b_bytes))
        self.b_bits = len(self.b_bytes).bit_length()
        #: Each id as text before another id of its group and side, and as the last one.
        self.inner, self.last_a, self.last_b = (np.array([b"%d%c" % (i, c) for i in range(n)], object) for c in b",|;")
        #: A fixed shuffle of the A ids, so that ranges of it hold common and rare ones alike.
        self.dealt = np.random.default_rng(13).permutation(len(self.a_bytes)).astype(np.int64)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of space + text on both sides; None where a side does not give back its bytes."""
        whole = " " + text
        try:
            a = self.ranked.encode_ordinary(whole) if self.ranked else None
        except BaseException as e:  # its regex engine gives up on very long runs of one kind of character
            if type(e).__name__ != "PanicException":
                raise
            a = None
        a = self.plain.encode(whole, add_special_tokens=False).ids if a is None else a
        b = self.b.encode(text)
        raw = whole.encode()
        if b"".join([self.a_bytes[i] for i in a]) != raw or b"".join([self.b_bytes[i] for i in b]) != raw:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)


_SIDES: dict[tuple, Sides] = {}


def _sides(*paths: str) -> Sides:
    if paths not in _SIDES:
        _SIDES[paths] = Sides(*paths)
    return _SIDES[paths]


class Groups:
    """Groups of some texts laid one after another: numbers of their tokens, groups and links per text."""

    def __init__(self, own: Sides, a: list[np.ndarray], b: list[np.ndarray]) -> None:
        self.own, self.n_texts = own, len(a)
        self.n_a, self.n_b = (np.array([len(x) for x in side], np.int64) for side in (a, b))
        self.a, self.b = (np.concatenate([np.zeros(0, np.int64), *side]) for side in (a, b))
        a_end, b_end = np.cumsum(own.a_sizes[self.a]), np.cumsum(own.b_sizes[self.b])
        cut = a_end[np.isin(a_end, b_end, assume_unique=True)]
        of_a, of_b = np.searchsorted(cut, a_end), np.searchsorted(cut, b_end)
        self.of_a = of_a
        self.size_a, self.size_b = np.bincount(of_a, minlength=len(cut)), np.bincount(of_b, minlength=len(cut))
        self.end_a, self.end_b = np.cumsum(self.size_a), np.cumsum(self.size_b)
        self.text_of_a = np.repeat(np.arange(self.n_texts), self.n_a)
        self.text = self.text_of_a[self.end_a - 1]  # a text's last bytes end a group
        self.n_groups = np.bincount(self.text, minlength=self.n_texts)
        self.n_links = np.zeros(self.n_texts, np.int64)
        np.add.at(self.n_links, self.text, self.size_a * self.size_b)

    def digests(self) -> list[str]:
        """SHA-256 of each text's ``a1,a2|b1;a3|b2,b3``."""
        own, n = self.own, len(self.a) + len(self.b)
        flat = np.empty(n, object)
        tail_a, tail_b = np.zeros(len(self.a), bool), np.zeros(len(self.b), bool)
        tail_a[self.end_a - 1] = tail_b[self.end_b - 1] = True
        place = np.arange(len(self.a)) + (self.end_b - self.size_b)[self.of_a]
        flat[place] = np.where(tail_a, own.last_a[self.a], own.inner[self.a])
        free = np.ones(n, bool)
        free[place] = False
        flat[free] = np.where(tail_b, own.last_b[self.b], own.inner[self.b])
        at = np.concatenate([[0], np.cumsum(self.n_a + self.n_b)]).tolist()
        return [hashlib.sha256(b"".join(flat[i:j].tolist())[:-1]).hexdigest() for i, j in zip(at[:-1], at[1:])]

    def records(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (pair, text) in ascending order, and the links of each: pairs are dealt A id << b_bits | B id."""
        own, many = self.own, self.size_a * self.size_b > WIDE
        n_b = self.size_b[self.of_a]
        narrow = np.flatnonzero(~many[self.of_a])
        n = n_b[narrow]
        first = (self.end_b - self.size_b)[self.of_a[narrow]]
        b = self.b[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        a, text = np.repeat(own.dealt[self.a[narrow]], n), np.repeat(self.text_of_a[narrow], n)
        keys, times = [((a << own.b_bits) | b) * self.n_texts + text], [np.ones(len(a), np.int64)]
        for g in np.flatnonzero(many).tolist():
            x, n_x = np.unique(self.a[self.end_a[g] - self.size_a[g] : self.end_a[g]], return_counts=True)
            y, n_y = np.unique(self.b[self.end_b[g] - self.size_b[g] : self.end_b[g]], return_counts=True)
            keys.append((((own.dealt[x] << own.b_bits)[:, None] | y) * self.n_texts + self.text[g]).ravel())
            times.append(np.outer(n_x, n_y).ravel())
        if len(keys) == 1:
            key, links = np.unique(keys[0], return_counts=True)
        else:
            key, at = np.unique(np.concatenate(keys), return_inverse=True)
            links = np.zeros(len(key), np.int64)
            np.add.at(links, at, np.concatenate(times))
        return key // max(self.n_texts, 1), key % max(self.n_texts, 1), links


def _pack_frames(keys: np.ndarray, counts: np.ndarray) -> pa.Array | bytes:
    """A run: frames of at most FRAME sorted entries, each (entries, key bytes, count bytes, keys, counts)."""
    out = []
    for i in range(0, len(keys), FRAME):
        k, c = pack_sorted(keys[i : i + FRAME]), pack_numbers(counts[i : i + FRAME].astype(np.uint32))
        out += [np.array([min(FRAME, len(keys) - i), len(k), len(c)], np.int64).tobytes(), k, c]
    return b"".join(out)


def _frames(data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    at = 0
    while at < len(data):
        n, k, c = np.frombuffer(data, np.int64, 3, at).tolist()
        at += 24
        yield unpack_sorted(data[at : at + k], n), unpack_numbers(data[at + k : at + k + c], np.uint32, n).astype(np.int64)
        at += k + c


def _block_rows(own: Sides, radices: int, block: int, ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
    """The rows that a block of documents spills: its records (kind 0) and its runs (kind 1)."""
    sides = [own.encode(t) if t else None for t in texts]
    good = np.array([i for i, x in enumerate(sides) if x is not None], np.int64)
    groups = Groups(own, [sides[i][0] for i in good], [sides[i][1] for i in good])
    del sides
    shas = [""] * len(texts)
    for i, sha in zip(good.tolist(), groups.digests()):
        shas[i] = sha
    stats = np.zeros((4, len(texts)), np.int64)
    stats[:, good] = groups.n_a, groups.n_b, groups.n_groups, groups.n_links
    pair, text, links = groups.records()
    first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])) if len(pair) else np.zeros(0, np.int64)
    pairs, per_pair = pair[first], np.diff(np.append(first, len(pair)))
    kept = pa.table({"id": ids, **{c: pa.array(stats[k]) for k, c in enumerate(_STATS)}, "groups_sha256": pa.array(shas, pa.string())})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, kept.schema) as out:
        out.write_table(kept)
    parts = [sink.getvalue().to_pybytes(), pack_numbers(per_pair.astype(np.uint32)), pack_numbers(good[text].astype(np.uint32)), pack_numbers(links)]
    head = np.array([len(pairs), len(pair), *[len(p) for p in parts]], np.int64).tobytes()
    rows = [{"kind": 0, "block": block, "radix": -1, "n": len(pairs), "data": zstandard.ZstdCompressor(level=1).compress(head + b"".join(parts))}]
    side = pairs >> own.b_bits
    radix = side * radices // len(own.dealt)  # rises with the pair
    keys = (side << 32 | pairs & ((1 << own.b_bits) - 1)).astype(np.uint64)
    edges = np.searchsorted(radix, np.arange(radices + 1))
    for r in np.unique(radix).tolist():
        i, j = int(edges[r]), int(edges[r + 1])
        rows.append({"kind": 1, "block": block, "radix": r, "n": j - i, "data": _pack_frames(keys[i:j], per_pair[i:j])})
    return pa.RecordBatch.from_pylist(rows, schema=_SPILL_ARROW)


def _spill(paths: tuple[str, str], radices: int, block_bytes: int, batches: Iterator[pa.RecordBatch]):
    own, context = _sides(*paths), TaskContext.get()
    block, ids, texts, held = (context.partitionId() if context else 0) << 32, [], [], 0
    for batch in (b.slice(i, 1024) for b in batches for i in range(0, b.num_rows, 1024)):
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids.append(i)
            texts.append(text)
            held += len(text or "") + 64
            if held > block_bytes:
                yield _block_rows(own, radices, block, pa.array(ids, pa.int64()), texts)
                block, ids, texts, held = block + 1, [], [], 0
    if ids:
        yield _block_rows(own, radices, block, pa.array(ids, pa.int64()), texts)
    pa.default_memory_pool().release_unused()


class _Run:
    """A sorted run read frame by frame, at least one whole A id ahead."""

    def __init__(self, data: bytes) -> None:
        self.frames, self.ended = _frames(data), False
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.totals, self.best = [], []
        self.fill()

    def fill(self) -> None:
        while not self.ended and (not len(self.keys) or self.keys[0] >> np.uint64(32) == self.keys[-1] >> np.uint64(32)):
            frame = next(self.frames, None)
            if frame is None:
                self.ended = True
            else:
                self.keys, self.counts = np.concatenate([self.keys, frame[0]]), np.concatenate([self.counts, frame[1]])

    def take(self, below: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Entries of A ids below ``below`` (None: all)."""
        n = len(self.keys) if below is None else int(np.searchsorted(self.keys, np.uint64(below << 32)))
        out = self.keys[:n], self.counts[:n]
        self.keys, self.counts = self.keys[n:], self.counts[n:]
        return out


def merge_runs(data: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each run its pairs' sums over all runs, and whether the sum is the highest of the pair's A id.

    One heap holds, of each run not read to its end, the last A id in sight: all runs are complete below the
    least of these. Another holds the next A id of each run, so that a step visits only runs that have such entries.
    """
    runs = [_Run(d) for d in data]
    sight = [(int(r.keys[-1] >> np.uint64(32)), i) for i, r in enumerate(runs) if not r.ended]
    heads = [(int(r.keys[0] >> np.uint64(32)), i) for i, r in enumerate(runs) if len(r.keys)]
    heapq.heapify(sight)
    heapq.heapify(heads)
    while heads:
        below, moved, taken = sight[0][0] if sight else None, [], []
        while heads and (below is None or heads[0][0] < below):
            i = heapq.heappop(heads)[1]
            moved.append(i)
            taken.append(runs[i].take(below))
        if moved:
            keys = np.concatenate([k for k, _ in taken])
            counts = np.concatenate([c for _, c in taken])
            pairs, at = np.unique(keys, return_inverse=True)
            sums = np.zeros(len(pairs), np.int64)
            np.add.at(sums, at, counts)
            side = pairs >> np.uint64(32)
            first = np.flatnonzero(np.append(True, side[1:] != side[:-1]))
            highest = np.repeat(np.maximum.reduceat(sums, first), np.diff(np.append(first, len(side))))
            total, best, k = sums[at], (sums == highest)[at], 0
            for i, (mine, _) in zip(moved, taken):
                runs[i].totals.append(total[k : k + len(mine)])
                runs[i].best.append(best[k : k + len(mine)])
                k += len(mine)
                if len(runs[i].keys):
                    heapq.heappush(heads, (int(runs[i].keys[0] >> np.uint64(32)), i))
        if sight:  # read on in the run that sets the bound
            run = runs[sight[0][1]]
            i = heapq.heappop(sight)[1]
            known = len(run.keys)
            run.fill()
            if not run.ended:
                heapq.heappush(sight, (int(run.keys[-1] >> np.uint64(32)), i))
            if not known and len(run.keys):
                heapq.heappush(heads, (int(run.keys[0] >> np.uint64(32)), i))
    return [(np.concatenate(r.totals), np.concatenate(r.best)) for r in runs]


def _merge(key, table):
    rows = table.select(["block", "n"]).to_pylist()
    merged = merge_runs([d.as_buffer().to_pybytes() for d in table["data"].combine_chunks()])
    return pa.Table.from_pylist([
        {"block": r["block"], "radix": key[0].as_py(), "n": r["n"], "counts": pack_numbers(t), "best": np.packbits(b).tobytes()}
        for r, (t, b) in zip(rows, merged)
    ], schema=_ANSWER_ARROW)


def _finish(key, records, answers):
    raw = zstandard.ZstdDecompressor().decompress(records["data"][0].as_py())
    n_pairs, n_records, *sizes = np.frombuffer(raw, np.int64, 6).tolist()
    at = np.cumsum([48, *sizes]).tolist()
    parts = [raw[at[k] : at[k + 1]] for k in range(4)]
    kept = pa.ipc.open_stream(parts[0]).read_all()
    per_pair = unpack_numbers(parts[1], np.uint32, n_pairs).astype(np.int64)
    doc, links = unpack_numbers(parts[2], np.uint32, n_records).astype(np.int64), unpack_numbers(parts[3], np.int64, n_records)
    rows = sorted(answers.select(["radix", "n", "counts", "best"]).to_pylist(), key=lambda r: r["radix"])
    count = np.concatenate([np.zeros(0, np.int64), *[unpack_numbers(r["counts"], np.int64, r["n"]) for r in rows]])
    best = np.concatenate([np.zeros(0, np.uint8), *[np.unpackbits(np.frombuffer(r["best"], np.uint8), count=r["n"]) for r in rows]])
    n_best, count_sum = np.zeros(len(kept), np.int64), np.zeros(len(kept), np.int64)
    np.add.at(count_sum, doc, links * np.repeat(count, per_pair))
    np.add.at(n_best, doc, links * np.repeat(best.astype(np.int64), per_pair))
    out = kept.append_column("n_best", pa.array(n_best)).append_column("count_sum", pa.array(count_sum))
    return out.select(_OUT_ARROW.names).cast(_OUT_ARROW)


def align(docs: DataFrame, byte_bpe: str, piece_bpe: str, id_col: str = "doc_id", text_col: str = "text",
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: its id, tokens of both sides, groups, links, links whose count is the highest of
    their A id (``n_best``), the sum of the links' counts and the digest of the groups.

    ``byte_bpe`` is a file of the tokenizers library without special tokens, ``piece_bpe`` a sentencepiece model.

    Defined cases: null and empty texts, and texts that either side cannot give back byte for byte (the piece side
    reads U+2581 as a space), have zeros and an empty digest, and count nowhere; rows of one id, equal or not, are documents of
    their own; null ids are kept; an empty table gives an empty one; further columns are ignored. What a
    task holds is a block of about ``block_bytes`` characters, or one longer text.
    """
    spark = docs.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/alignment-{uuid.uuid4().hex}"
    rows = docs.select(F.col(id_col).cast("long").alias("c0"), F.col(text_col).cast("string").alias("c1"))
    size = rows.agg(F.sum(F.octet_length("c1"))).first()[0] or 0
    radices = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / RADIX_BYTES))
    rows.mapInArrow(partial(_spill, (byte_bpe, piece_bpe), radices, block_bytes), _SPILL).write.partitionBy("kind").option("compression", "uncompressed").parquet(folder)
    spilled = spark.read.schema(_SPILL).parquet(folder)
    answers = spilled.where("kind = 1").select("radix", "block", "n", "data").groupBy("radix").applyInArrow(_merge, _ANSWER)
    records = spilled.where("kind = 0").select("block", "data")
    out = records.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_finish, _OUT)
    return out.withColumnRenamed("id", id_col)


def op13_token_alignment(spark, sf_dir: str) -> DataFrame:
    """Alignment of the byte-level and the piece tokenizer over all documents."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
