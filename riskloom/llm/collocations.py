"""Phrase collocations by dynamic itemset counting over a corpus.

Texts are encoded once into blocks (a dictionary of the block's words and codes with breaks between pieces), dealt to a
few shards and written to the shared folder. The shards are scanned in a circle, one a step. Words count from
the first step on; a longer phrase counts from the step after both of its subphrases (without the last and
without the first word) have reached the threshold, whatever step that is, until each shard has been seen
once since. So lengths interleave: most long phrases are complete long before the last word is.

What a step's tasks know of earlier steps is a fixed array: for each slot of a hash, the first step after which
some phrase of that slot had reached the threshold; a phrase takes it from the step in which it starts itself, so that a longer
one never starts before its parts are counted. Phrases that share a slot can only start a phrase
that needs not be counted, in the same step everywhere; its count is complete like any other and it falls
out at the end. Counts are exact, per phrase itself.
"""

from __future__ import annotations

import uuid
from array import array
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.llm.skew import join_spread
from riskloom.llm.words import mix
from riskloom.session import ensure_checkpoint_dir

#: Text bytes of a block, bytes split into words at a time, shards of the circle, slots of the array (a byte each).
BLOCK_BYTES, SLICE_BYTES, SHARDS, SLOTS = 8 << 20, 1 << 20, 3, 1 << 24
#: Words of the longest phrase; a slot that no phrase has reached.
LONGEST, NEVER = 4, 255

_BREAKS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytearray(range(256))
for _b in _BREAKS:
    _TABLE[_b] = ord(".")
_TABLE[ord("\t")] = ord(" ")
for _b in range(ord("A"), ord("Z") + 1):
    _TABLE[_b] += 32
_TABLE = bytes(_TABLE)

_BLOCK = "lang string, n_words long, words binary, names binary, codes binary, shard int"
_BLOCK_ARROW = pa.schema([("lang", pa.string()), ("n_words", pa.int64()), ("words", pa.binary()), ("names", pa.binary()), ("codes", pa.binary()), ("shard", pa.int32())])
_COUNT = "lang string, phrase string, start int, n long"
_COUNT_ARROW = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("start", pa.int32()), ("n", pa.int64())])
_STATE = "lang string, phrase string, start int, n long, done boolean"


class _Codes(dict):
    """Words in order of first sight; code 0 is a break."""

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self)
        return code


def _slices(text: bytes) -> Iterator[bytes]:
    """A translated text in slices that end at a blank or a break."""
    i = 0
    while len(text) - i > SLICE_BYTES:
        j = max(text.rfind(b" ", i, i + SLICE_BYTES), text.rfind(b".", i, i + SLICE_BYTES))
        if j <= i:
            j = min((k for k in (text.find(b" ", i + 1), text.find(b".", i + 1)) if k > 0), default=len(text))
        yield text[i:j]
        i = j
    yield text[i:]


def _word_names(lang: str, words: list[bytes]) -> np.ndarray:
    seed = lang.encode() + b"\0"
    return np.array([xxhash.xxh3_64_intdigest(seed + w) for w in words], np.uint64)


def _block(lang: str, texts: list[bytes], shard: int) -> dict:
    codes, out = _Codes({b".": 0}), array("i")
    for text in texts:
        for piece in _slices(text.translate(_TABLE)):
            out.extend(map(codes.__getitem__, piece.replace(b".", b" . ").split()))
        out.append(0)
    words = list(codes)[1:]
    names = _word_names(lang, words)
    flat = np.frombuffer(out, np.int32)
    pack = zstandard.ZstdCompressor(level=1).compress
    return {"lang": lang, "n_words": int((flat > 0).sum()), "words": pack(b" ".join(words)), "names": names.tobytes(), "codes": pack(flat.tobytes()), "shard": shard}


def _encode(shards: int, block_bytes: int, batches: Iterator[pa.RecordBatch]):
    context, held, sizes = TaskContext.get(), {}, {}
    nth = context.partitionId() if context else 0

    def flush(langs):
        nonlocal nth
        for lang in langs:
            yield pa.RecordBatch.from_pylist([_block(lang, held.pop(lang), nth % shards)], schema=_BLOCK_ARROW)
            sizes.pop(lang)
            nth += 1

    for batch in (b.slice(i, 1024) for b in batches for i in range(0, b.num_rows, 1024)):
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            raw = text.encode()
            held.setdefault(lang, []).append(raw)
            sizes[lang] = sizes.get(lang, 0) + len(raw) + 64
            if sizes[lang] > block_bytes:
                yield from flush([lang])
        if sum(sizes.values()) > 3 * block_bytes:
            yield from flush(sorted(held))
    yield from flush(sorted(held))


def _join_names(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Name of a phrase from the names of all but its last word and of its last word."""
    return mix(left * np.uint64(0x9E3779B97F4A7C15) + right)


def _count_block(step: int, shards: int, known: np.ndarray, block: dict) -> Iterator[pa.RecordBatch]:
    """What the block adds to each phrase that counts in this step."""
    unpack, mask = zstandard.ZstdDecompressor().decompress, np.uint64(len(known) - 1)
    words = [b"", *unpack(block["words"]).split(b" ")]
    names = np.append(np.zeros(1, np.uint64), np.frombuffer(block["names"], np.uint64))
    code = np.frombuffer(unpack(block["codes"]), np.int32)
    strings = pa.array(words[: len(names)], pa.binary())

    def rows(k, at, start, n):
        parts = [strings.take(pa.array(code[at + j])) for j in range(k)]
        phrase = parts[0] if k == 1 else pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary()))
        return pa.RecordBatch.from_arrays([
            pa.repeat(pa.scalar(block["lang"]), len(at)), phrase.cast(pa.string()), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int64)),
        ], schema=_COUNT_ARROW)

    if step < shards:
        n = np.bincount(code, minlength=len(names))[1:]
        first = np.zeros(len(names), np.int64)
        first[code[::-1]] = np.arange(len(code))[::-1]
        yield rows(1, first[1:], np.zeros(len(n)), n)
    hot = known[names & mask].astype(np.int64)
    hot[0] = NEVER
    at, reach, name = np.arange(len(code)), hot[code], None  # where phrases of k - 1 words start, and since when they count as reached
    pair, n_pairs = None, 0
    for k in range(2, LONGEST + 1):
        # phrases of k - 1 words at neighbouring places, both reached
        full = np.full(len(code) + 1, NEVER, np.int64)
        full[at] = reach
        start = np.maximum(full[at], full[at + 1]) + 1
        ok = start <= step
        if not ok.any():
            return
        at, start = at[ok], start[ok]
        name = _join_names(names[code[at]] if k == 2 else name[ok], names[code[at + k - 1]])
        if k == 2:
            found, number = np.unique(code[at].astype(np.int64) * len(names) + code[at + 1], return_inverse=True)
            pair, n_pairs = np.zeros(len(code), np.int64), len(found)
            pair[at] = number
        now = np.flatnonzero(step < start + shards)
        if len(now):
            place = at[now]
            key = pair[place] if k == 2 else pair[place] * len(names) + code[place + 2] if k == 3 else pair[place] * n_pairs + pair[place + 2]
            _, first, n = np.unique(key, return_index=True, return_counts=True)
            yield rows(k, place[first], start[now[first]], n)
        # no phrase is reached before it counts: an earlier step in its slot is that of another phrase
        reach = np.maximum(known[name & mask].astype(np.int64), start)


def _count(step: int, shards: int, known, batches: Iterator[pa.RecordBatch]):
    table = np.frombuffer(known.value, np.uint8)
    for batch in batches:
        for k in range(batch.num_rows):
            yield from _count_block(step, shards, table, batch.slice(k, 1).to_pylist()[0])


def _slots(slots: int, batches: Iterator[pa.RecordBatch]):
    """The distinct slots of some phrases, packed, and the last step in which one of them started."""
    found, last = [np.zeros(0, np.uint64)], 0
    for batch in batches:
        last = max(last, pc.max(batch.column(2)).as_py() or 0)
        by_kind: dict[tuple, list] = {}
        for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = phrase.encode().split(b" ")
            by_kind.setdefault((lang, len(words)), []).append(words)
        for (lang, _), phrases in by_kind.items():
            columns = [_word_names(lang, list(x)) for x in zip(*phrases)]
            name = columns[0]
            for word in columns[1:]:
                name = _join_names(name, word)
            found.append(np.unique(name & np.uint64(slots - 1)))
    distinct = np.unique(np.concatenate(found))
    data = zstandard.ZstdCompressor(level=1).compress(np.diff(distinct, prepend=np.uint64(0)).astype(np.uint32).tobytes())
    yield pa.RecordBatch.from_pydict({"slots": pa.array([data], pa.binary()), "last": pa.array([last], pa.int32())})


def _words_of(phrase: str) -> Column:
    return F.length(phrase) - F.length(F.replace(F.col(phrase), F.lit(" "), F.lit(""))) + 1


def count_phrases(docs: DataFrame, threshold: int, lang_col: str = "lang", text_col: str = "text", shards: int = SHARDS,
                  slots: int = SLOTS, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """(lang, k, phrase, n) of every word and every phrase of up to LONGEST words with ``threshold`` occurrences or more
    inside pieces, and (lang, n) with the number of all words. A null language is ``und``, a null text empty."""
    spark = docs.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/phrases-{uuid.uuid4().hex}"
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("c0"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("c1"))
    rows.mapInArrow(partial(_encode, shards, block_bytes), _BLOCK).write.partitionBy("shard").parquet(f"{folder}/blocks")
    blocks = spark.read.schema(_BLOCK).parquet(f"{folder}/blocks")

    known = np.full(slots, NEVER, np.uint8)
    state = spark.createDataFrame([], _STATE)
    step, last = 0, 0
    while step < max(shards, last + shards + 1):
        sent = spark.sparkContext.broadcast(known.tobytes())  # as large as the fixed array
        shard = blocks.where(F.col("shard") == step % shards).select("lang", "words", "names", "codes")
        counted = shard.mapInArrow(partial(_count, step, shards, sent), _COUNT)
        sums = state.select("lang", "phrase", "start", "n").unionAll(counted).groupBy("lang", "phrase").agg(F.max("start").alias("start"), F.sum("n").alias("n"))
        sums = sums.withColumn("done", F.col("start") + F.lit(shards - 1) <= F.lit(step)).where((F.col("n") >= threshold) | ~F.col("done"))
        sums.write.partitionBy("done").parquet(f"{folder}/state/step={step}")
        sent.destroy()
        written = spark.read.schema(_STATE).parquet(f"{folder}/state/step={step}")
        fresh = written.where((F.col("n") >= threshold) & (_words_of("phrase") < LONGEST)).select("lang", "phrase", "start")
        # slots of the fixed array, distinct in each task: bounded by it
        for r in fresh.mapInArrow(partial(_slots, slots), "slots binary, last int").collect():
            last = max(last, r["last"])  # of a phrase whose slot another one had taken
            found = np.cumsum(np.frombuffer(zstandard.ZstdDecompressor().decompress(r["slots"]), np.uint32), dtype=np.int64)
            found = found[known[found] == NEVER]
            if len(found):
                known[found] = step
                last = step
        state = written.where(~F.col("done"))
        step += 1
    counts = spark.read.schema(f"{_STATE}, step int").parquet(f"{folder}/state").where("done").select("lang", _words_of("phrase").alias("k"), "phrase", "n")
    return counts, blocks.groupBy("lang").agg(F.sum("n_words").alias("n"))


def _exact(x: str) -> Column:
    return F.col(x).cast("decimal(20,0)")


def collocations(docs: DataFrame, threshold: int = 30, scale: int = 2_000_000, covered: int = 80, top: int = 2000, lang_col: str = "lang",
                 text_col: str = "text", shards: int = SHARDS, slots: int = SLOTS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``top`` phrases of 2 to 4 words of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase with a >= ``threshold`` occurrences is cut after its first k words into parts with l and r occurrences; the cut
    of least score floor(scale * a / (l + r)) counts, the smallest k of equal ones. Phrases inside a longer
    candidate that has ``covered`` percent of their occurrences or more are left out. Order: score and a descending, phrase.

    Defined cases: null languages are ``und``, null and empty texts have no words; repeated rows count each; equal
    scores go by a, then by the phrase's UTF-8 bytes; a text of any length is split slice by slice and kept as 4 bytes a word; an
    empty table gives an empty one; further columns are ignored.
    """
    counts, totals = count_phrases(docs, threshold, lang_col, text_col, shards, slots, block_bytes)
    spark = docs.sparkSession
    found = counts.where("k >= 2").withColumnRenamed("n", "a")
    w = F.split("phrase", " ", -1)
    at = F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")
    cuts = found.select("lang", "phrase", "a", "k", at)
    cuts = cuts.select("lang", "phrase", "a", "cut", F.array_join(F.slice(w, 1, F.col("cut")), " ").alias("first"),
                       F.array_join(F.slice(w, F.col("cut") + 1, F.col("k")), " ").alias("rest"))
    folder = f"{ensure_checkpoint_dir(spark)}/cuts-{uuid.uuid4().hex}"
    by_phrase = counts.select("lang", "phrase", "n")
    cuts = join_spread(cuts, by_phrase.toDF("lang", "first", "l"), ["lang", "first"], F.concat_ws(" ", "phrase", "cut"))
    cuts.write.parquet(folder)
    cuts = spark.read.parquet(folder)
    cuts = join_spread(cuts, by_phrase.toDF("lang", "rest", "r"), ["lang", "rest"], F.concat_ws(" ", "phrase", "cut"))
    cuts = cuts.withColumn("score", F.expr(f"cast({scale} as decimal(10,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"))
    least = cuts.groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.min(F.struct("score", "cut", "l", "r")).alias("x"))

    size = F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("size")
    inner = found.where("k >= 3").select("lang", "phrase", "a", "k", size)
    inner = inner.select("lang", "phrase", "a", "size", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)).alias("at"))
    inner = inner.select("lang", F.array_join(F.slice(w, F.col("at"), F.col("size")), " ").alias("phrase"), F.col("a").alias("longer"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = least.join(inner, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * _exact("longer") < covered * _exact("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("x.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "x.l", "x.r", "n", F.col("x.score").cast("long").alias("score")
    )


def op12_collocations(spark, sf_dir: str) -> DataFrame:
    """Collocations of each language over all documents."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text"))


OP12_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
c AS (SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS n
      FROM w, unnest([1, 2, 3, 4]) AS ks(k), unnest(range(1, len(w) - k + 2)) AS u(i) GROUP BY ALL),
t AS (SELECT lang, sum(n)::BIGINT AS n FROM c WHERE k = 1 GROUP BY lang),
f AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM c WHERE k >= 2 AND n >= 30),
x AS (SELECT f.lang, f.phrase, f.a, f.k, cut, l.n AS l, r.n AS r, (2000000::HUGEINT * f.a) // (l.n + r.n) AS score
      FROM f, unnest(range(1, f.k)) AS cs(cut)
      JOIN c l ON l.lang = f.lang AND l.phrase = array_to_string(f.w[1 : cut], ' ')
      JOIN c r ON r.lang = f.lang AND r.phrase = array_to_string(f.w[cut + 1 : f.k], ' ')),
m AS (SELECT lang, phrase, a, l, r, score FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
s AS (SELECT f.lang, array_to_string(f.w[i : i + z - 1], ' ') AS phrase, max(f.a) AS longer
      FROM f, unnest(range(2, f.k)) AS zs(z), unnest(range(1, f.k - z + 2)) AS u(i) GROUP BY ALL),
k AS (SELECT m.* FROM m LEFT JOIN s USING (lang, phrase) WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM k)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM o JOIN t USING (lang) WHERE rank <= 2000
"""
