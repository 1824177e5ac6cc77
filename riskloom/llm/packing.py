"""Packing by concatenate and cut: all documents end to end in id order, cut every ``length`` tokens.

Pass one deals the token ids into id ranges and adds up each range. Prefix sums of those totals place
every range, hence every document, in the global stream without moving a token; pass two cuts each
document where a window ends. A document across a boundary gets a piece (a boundary record) on either side.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import parts as P
from riskloom.llm.tokens import encode_column, forget_pieces, id_arrays

LENGTH = 2048
END_ID = 1
_PIECE = "id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def _pieces(length, part, blocks, totals):
    table = P.unpack(blocks)
    flat, at = id_arrays(table)
    n = np.diff(at)
    begin = at[:-1] + totals["before"][0].as_py()
    first, last = begin // length, (begin + n - 1) // length
    doc = np.repeat(np.arange(len(n)), last - first + 1)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(last - first + 1) - (last - first + 1), last - first + 1)
    sequence = first[doc] + nth
    lo = np.maximum(sequence * length, begin[doc])
    hi = np.minimum((sequence + 1) * length, begin[doc] + n[doc])
    data, shift = flat.tobytes(), begin[0] if len(begin) else 0
    ids = [data[4 * i : 4 * j] for i, j in zip((lo - shift).tolist(), (hi - shift).tolist())]
    columns = [table["_id"].combine_chunks().take(pa.array(doc)), lo - begin[doc], hi - lo, n[doc], sequence, lo - sequence * length]
    names = ["id", "start", "length", "doc_tokens", "sequence_id", "offset"]
    return pa.Table.from_arrays([*map(pa.array, columns), pa.array(ids, pa.binary())], names=[*names, "ids"])


def pack(docs: DataFrame, tokenizer: str, keeps_space: bool = True, id_col: str = "doc_id", text_col: str = "text",
         length: int = LENGTH, end_id: int = END_ID, part_bytes: int = P.PART_BYTES) -> DataFrame:
    """One row per piece: ``id_col``, start (the document's ids before it), length, doc_tokens, sequence_id, offset (the
    piece's place in its sequence) and ids (little-endian unsigned 32-bit).

    Every sequence but the last is full, so at most one is to be padded.

    Defined cases: a null or empty text is the end id alone; rows of one id stay separate, next to
    each other in order of a hash of their text; rows with a null id come last; an empty table gives an empty
    one; further columns are ignored.
    """
    own = (tokenizer, keeps_space, end_id)
    dealt = P.gather(docs, id_col, text_col, items=partial(encode_column, *own), part_bytes=part_bytes, after=partial(forget_pieces, *own))
    totals = P.running_totals(dealt.table.groupBy("part").agg(F.sum("n_items").alias("n")), "part", "n")
    return dealt.visit_with(totals, partial(_pieces, length), _PIECE).withColumnRenamed("id", id_col)


def op9_concat_and_cut(spark, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    import public_tokenizers

    out = pack(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
