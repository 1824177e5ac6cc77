"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding with separate control bytes.

An id is written as its rank by corpus frequency, in 1 to 4 bytes; the 2-bit byte counts of four ids share
a control byte, and controls and data are separate streams. Decoding is table lookup: a control byte gives
four lengths, running sums of lengths give where each value begins, and a mask per length drops what
lies beyond. The container is Parquet (any store that Spark reaches): one folder per id range in ascending
order, in it frames of whole documents with their index, and beside it the rank table.
"""

from __future__ import annotations

import uuid
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import parts as P
from riskloom.llm.tokens import encode_column, forget_pieces, id_arrays
from riskloom.session import ensure_checkpoint_dir

END_ID = 1
#: Ids of a frame, about: whole documents are added until a frame has as many.
FRAME_IDS = 1 << 19

#: For each control byte the lengths of its four values, and for each length the bits that count.
_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.int64) + 1
_MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)

_FRAME = "shard int, frame int, first long, n_ids long, doc_ids array<long>, counts array<long>, control binary, data binary"
_FRAME_ARROW = pa.schema([
    ("shard", pa.int32()), ("frame", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("control", pa.binary()), ("data", pa.binary()),
])


def encode_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """Unsigned 32-bit values -> (control bytes, data bytes)."""
    v = np.ascontiguousarray(values, dtype="<u4")
    length = 1 + (v > 0xFF).astype(np.int64) + (v > 0xFFFF) + (v > 0xFFFFFF)
    codes = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    codes[: len(v)] = length - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    return control.tobytes(), v.view(np.uint8).reshape(-1, 4)[np.arange(4) < length[:, None]].tobytes()


def decode_values(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The inverse of encode_values."""
    length = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    at = np.cumsum(length) - length
    raw = np.append(np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)).astype(np.uint32)
    value = raw[at] | raw[at + 1] << np.uint32(8) | raw[at + 2] << np.uint32(16) | raw[at + 3] << np.uint32(24)
    return value & _MASKS[length]


def _counts(part, blocks):
    flat, _ = id_arrays(P.unpack(blocks))
    found = np.bincount(flat)
    token = np.flatnonzero(found)
    return pa.table({"token": pa.array(token, pa.int64()), "n": pa.array(found[token], pa.int64())})


def _frames(rank, part, blocks, totals):
    table = P.unpack(blocks)
    flat, at = id_arrays(table)
    rank = np.frombuffer(rank, np.uint32)
    ids, first, rows, i, n = table["_id"].to_pylist(), totals["before"][0].as_py(), [], 0, len(table)
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(at, at[i] + FRAME_IDS, side="right")) - 1))
        control, data = encode_values(rank[flat[at[i] : at[j]]])
        rows.append({
            "shard": part, "frame": len(rows), "first": first + int(at[i]), "n_ids": int(at[j] - at[i]),
            "doc_ids": ids[i:j], "counts": np.diff(at[i : j + 1]).tolist(), "control": control, "data": data,
        })
        i = j
    return pa.Table.from_pylist(rows, schema=_FRAME_ARROW)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, keeps_space: bool, id_col: str = "doc_id",
                      text_col: str = "text", end_id: int = END_ID, part_bytes: int = P.PART_BYTES) -> None:
    """Encode whole texts and write ``folder``/ranks and ``folder``/frames in ascending id order.

    The rank table has a row per token id that occurs: bounded by the tokenizer's vocabulary, so it
    goes to every task. Equal frequencies rank by token id.

    Defined cases: a null or empty text is the end id alone; rows of one id stay separate, in order of a hash of their
    text; rows with a null id come last; an empty table writes empty tables; further columns are ignored.
    """
    own = (tokenizer, keeps_space, end_id)
    dealt = P.gather(docs, id_col, text_col, items=partial(encode_column, *own), part_bytes=part_bytes, after=partial(forget_pieces, *own))
    found = dealt.visit(_counts, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    order = [r["token"] for r in sorted(found, key=lambda r: (-r["n"], r["token"]))]
    spark = docs.sparkSession
    spark.createDataFrame(list(enumerate(order)), "rank long, token long").coalesce(1).write.parquet(f"{folder}/ranks")
    rank = np.zeros(max(order, default=0) + 1, np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    totals = P.running_totals(dealt.table.groupBy("part").agg(F.sum("n_items").alias("n")), "part", "n")
    frames = dealt.visit_with(totals, partial(_frames, rank.tobytes()), _FRAME)
    frames.write.partitionBy("shard").option("compression", "zstd").parquet(f"{folder}/frames")


def _decode(tokens, batches):
    tokens = np.frombuffer(tokens, np.uint32)
    for batch in batches:
        for r in batch.to_pylist():
            ids = tokens[decode_values(r["control"], r["data"], r["n_ids"])].astype("<u4").tobytes()
            at = np.concatenate([[0], np.cumsum(r["counts"])]).astype(np.int64)
            texts = [ids[4 * i : 4 * j] for i, j in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(r["doc_ids"], pa.int64()), pa.array(at[:-1] + r["first"]), pa.array(r["counts"], pa.int64()), pa.array(texts, pa.binary())],
                names=["doc_id", "start", "n_tokens", "ids"],
            )


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document; start: ids of all documents before it; ids: little-endian uint32."""
    ranks = spark.read.parquet(f"{folder}/ranks").collect()  # bounded by the vocabulary
    tokens = np.zeros(len(ranks), np.uint32)
    for r in ranks:
        tokens[r["rank"]] = r["token"]
    frames = spark.read.schema(_FRAME).parquet(f"{folder}/frames").select("first", "n_ids", "doc_ids", "counts", "control", "data")
    return frames.mapInArrow(partial(_decode, tokens.tobytes()), "doc_id long, start long, n_tokens long, ids binary")


def op1_token_files(spark, sf_dir: str) -> DataFrame:
    """Ids of every document, written to files and read back."""
    import public_tokenizers

    folder = f"{ensure_checkpoint_dir(spark)}/tokens-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    write_token_files(docs, folder, public_tokenizers.path("word_bpe_49k.json"), keeps_space=False)
    return read_token_files(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
