"""Substring dedup by recompression.

Rounds rename runs of equal tokens, then pairs of neighbours, to new symbols. A run's symbol is a
function of (token, length); whether two neighbours merge depends on the classes (left or right) of
their symbols alone, and the pair's symbol is a function of the two. So equal substrings get equal
symbols in their interior wherever they occur, whichever task reads them: names are content hashes
and need no exchange of dictionaries. After one run round and two pair rounds a symbol can differ
between two occurrences of a window only within four run symbols of either end.

1. Every part sends its distinct top-level symbols, each with the one that follows it; a bucket
   marks those of two or more documents (one bit per symbol comes back).
2. A window that occurs twice shares every interior symbol, so windows with an unmarked one are out.
   Which symbols are interior follows from the classes at the window's ends. Windows with fewer than two
   interior symbols (long runs of one word) give no evidence and stay in.
3. The candidates are verified as windows: parts send their names (96 bits of two independent
   hashes of the whole word sequence); a bucket finds which occur in a part before. Parts are ranges of
   ascending ids, so no ids are sent. Repeats inside a part are found there. Windows are equal by hash: of n
   different ones, two share their 96 bits with odds of about n * n / 2^97 (1 in 10^9 for 10^10 windows, the words
   of some 60 GB).

Nothing is broadcast or collected; a window, symbol or passage of any frequency is one entry per part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import parts as P
from riskloom.llm.words import Words, chunks, mix, text_buffer, window_names

WINDOW = 13
#: Salts of the pair rounds; each decides the classes of its round.
PAIR_ROUNDS = (0x51, 0xA7)
#: Bits of a symbol's name in round 1. Equal names of different symbols only add candidates.
SYMBOL_BITS = 48

#: Seeds of two independent names of words, and of windows.
_WORD_A, _WORD_B, _WINDOW_A, _WINDOW_B = 11, 23, 37, 53
_ASK = "part int, bucket int, n long, order int, keys binary, more binary"
_ANSWER = "part int, bucket int, round int, n long, bits binary"
_ANSWER_ARROW = pa.schema([("part", pa.int32()), ("bucket", pa.int32()), ("round", pa.int32()), ("n", pa.int64()), ("bits", pa.binary())])
_ASK_ARROW = pa.schema([("part", pa.int32()), ("bucket", pa.int32()), ("n", pa.int64()), ("order", pa.int32()), ("keys", pa.binary()), ("more", pa.binary())])


def run_round(names: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of an equal name within a text -> (names of runs, first index of each)."""
    new = heads.copy()
    new[1:] |= names[1:] != names[:-1]
    at = np.flatnonzero(new)
    length = np.diff(at, append=len(names)).astype(np.uint64)
    out = names[at]
    many = length > 1
    out[many] = mix(out[many] * np.uint64(0x9E3779B97F4A7C15) + length[many])
    return out, at


def pair_round(names: np.ndarray, heads: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge each left-class symbol with a right-class one that follows it -> (names, first index of each, class)."""
    left = (mix(names + np.uint64(salt)) >> np.uint64(63)).astype(bool)
    merged = np.flatnonzero(left[:-1] & ~left[1:] & ~heads[1:])
    out = names.copy()
    out[merged] = mix(mix(names[merged] + np.uint64(salt)) * np.uint64(3) + names[merged + 1])
    kept = np.ones(len(names), bool)
    kept[merged + 1] = False
    at = np.flatnonzero(kept)
    return out[at], at, left


class Parsed:
    """Top-level symbols and windows of some texts."""

    def __init__(self, words: Words, window: int) -> None:
        self.words, self.window = words, window
        self.name_a = words.names(_WORD_A)
        heads, n = words.heads(), len(words)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # class, and index one level up, of each symbol
        if not n:
            self.run_of, self.begin = np.zeros(0, np.int64), np.zeros(0, np.int64)
            self.symbols = np.zeros(0, np.uint64)
            return
        names, at = run_round(self.name_a, heads)
        self.run_of = np.cumsum(np.bincount(at, minlength=n)) - 1
        for salt in PAIR_ROUNDS:
            size = len(names)
            names, keep, left = pair_round(names, heads[at], salt)
            self.levels.append((left, np.cumsum(np.bincount(keep, minlength=size)) - 1))
            at = at[keep]
        following = np.append(names[1:], np.uint64(0))
        self.begin = at  # first word of each symbol
        self.symbols = mix(names * np.uint64(5) + following) >> np.uint64(64 - SYMBOL_BITS)

    def candidates(self, shared: np.ndarray) -> np.ndarray:
        """Starts of windows that may occur elsewhere; shared: a truth value for each symbol with its follower."""
        n, w = len(self.words), self.window
        if n < w:
            return np.zeros(0, np.int64)
        text_end = np.repeat(self.words.of_text[1:], self.words.counts())[: n - w + 1]
        start = np.flatnonzero(np.arange(w, n + 1) <= text_end)
        lo, hi = self.run_of[start] + 1, self.run_of[start + w - 1]  # without the runs at the ends
        some = lo < hi
        for left, above in self.levels:
            # the first may be merged into one before it, the last with one after it
            lo = np.where(some, lo + ~left[np.where(some, lo, 0)], 0)
            hi = np.where(some, hi - left[np.where(some, hi - 1, 0)], 0)
            some &= lo < hi
            lo, hi = np.where(some, above[np.where(some, lo, 0)], 0), np.where(some, above[np.where(some, hi, 0)], 0)
        missing = np.append(0, np.cumsum(~shared))
        last = np.maximum(hi - 1, lo)
        return start[~some | (missing[last] == missing[lo])]

    def window_names(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(at):
            return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        a = window_names(self.name_a, self.window, _WINDOW_A)[at]
        b = window_names(self.words.names(_WORD_B), self.window, _WINDOW_B)[at]
        return a, (b >> np.uint64(32)).astype(np.uint32)


def _parsed(table: pa.Table, window: int):
    raw, offsets = text_buffer(table["c1"])
    for i, j in chunks(offsets):
        yield i, j, Parsed(Words(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]), window)


def _ranks(table: pa.Table) -> np.ndarray:
    """Dense rank of the id within a part; rows without id share one."""
    ids = table["_id"].combine_chunks()
    values, missing = ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
    new = np.zeros(len(values), np.int64)
    new[1:] = (values[1:] != values[:-1]) & ~missing[1:] | (missing[1:] != missing[:-1])
    return np.cumsum(new)


def _ask(part, buckets, bits, order, keys, more) -> pa.Table:
    """Rows for the non-empty buckets of sorted keys; more(i, j): a second packed array."""
    edges, rows = P.bucket_edges(keys, buckets, bits), []
    for k in range(buckets):
        i, j = int(edges[k]), int(edges[k + 1])
        if i < j:
            rows.append({"part": part, "bucket": k, "n": j - i, "order": order, "keys": P.pack_sorted(keys[i:j]), "more": more(i, j)})
    return pa.Table.from_pylist(rows, schema=_ASK_ARROW)


def _symbol_keys(parsed: Iterator[Parsed]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct symbols of a part, and whether two or more of its texts have each."""
    keys = []
    for p in parsed:
        text = np.searchsorted(p.words.of_text, p.begin, side="right")
        order = np.argsort(p.symbols, kind="stable")
        s, t = p.symbols[order], text[order]
        first = np.ones(len(s), bool)
        first[1:] = (s[1:] != s[:-1]) | (t[1:] != t[:-1])
        keys.append(s[first])
    keys = np.sort(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)
    if not len(keys):
        return keys, np.zeros(0, bool)
    at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[at], np.diff(at, append=len(keys)) > 1


def _ask_symbols(buckets, window, part, blocks):
    keys, many = _symbol_keys(p for _, _, p in _parsed(P.unpack(blocks), window))
    return _ask(part, buckets, SYMBOL_BITS, 0, keys, lambda i, j: np.packbits(many[i:j]).tobytes())


def _bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def _answer(key, table, decide, round_no) -> pa.Table:
    rows = table.to_pylist()
    keys = [P.unpack_sorted(r["keys"], r["n"]) for r in rows]
    found, at, out = decide(rows, keys), 0, []
    for r in rows:
        out.append({"part": r["part"], "bucket": r["bucket"], "round": round_no, "n": r["n"], "bits": np.packbits(found[at : at + r["n"]]).tobytes()})
        at += r["n"]
    del keys, found
    P.give_back()
    return pa.Table.from_pylist(out, schema=_ANSWER_ARROW)


def _decide_shared(rows, keys) -> np.ndarray:
    """Symbols of two or more parts, or of two texts of a part."""
    many = np.concatenate([_bits(r["more"], r["n"]) for r in rows])
    allk = np.concatenate(keys)
    order = np.argsort(allk, kind="stable")
    s = allk[order]
    same = s[1:] == s[:-1]
    shared = many[order]
    shared[1:] |= same
    shared[:-1] |= same
    # a symbol of one part only is decided by its own mark; with two parts all its entries are marked above
    out = np.zeros(len(allk), bool)
    out[order] = shared
    return out


def _decide_before(rows, keys) -> np.ndarray:
    """Windows that a part before in order has too."""
    more = np.concatenate([P.unpack_numbers(r["more"], np.uint32, r["n"]) for r in rows])
    allk = np.concatenate(keys)
    order_of = np.repeat(np.array([r["order"] for r in rows]), [r["n"] for r in rows])
    order = np.lexsort((order_of, more, allk))
    a, b, o = allk[order], more[order], order_of[order]
    new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
    least = o[np.flatnonzero(new)][np.cumsum(new) - 1]
    out = np.zeros(len(allk), bool)
    out[order] = o > least
    return out


def _read_answers(answers: pa.Table, round_no: int) -> np.ndarray:
    rows = sorted((r for r in answers.to_pylist() if r["round"] == round_no), key=lambda r: r["bucket"])
    return np.concatenate([_bits(r["bits"], r["n"]) for r in rows]) if rows else np.zeros(0, bool)


def _windows(table: pa.Table, answers: pa.Table, window: int):
    """Candidate windows of a part: (chunk, start, rank of the text, name). Texts are parsed twice, chunk by chunk:
    a chunk's levels take ten times its bytes, so those of a whole part are never held."""
    keys, _ = _symbol_keys(p for _, _, p in _parsed(table, window))
    shared = _read_answers(answers, 1)
    rank = _ranks(table).astype(np.int32)
    found = [[np.zeros(0, t)] for t in (np.int32, np.int64, np.int32, np.uint64, np.uint32)]
    for c, (i, _, p) in enumerate(_parsed(table, window)):
        starts = p.candidates(shared[np.searchsorted(keys, p.symbols)] if len(keys) else np.zeros(0, bool))
        if not len(starts):
            continue
        text = np.searchsorted(p.words.of_text, starts, side="right") - 1
        for column, x in zip(found, (np.full(len(starts), c, np.int32), starts, rank[i + text], *p.window_names(starts))):
            column.append(x)
    out = []
    while found:
        out.append(np.concatenate(found.pop(0)))
    return out


def _grouped(rank, a, b):
    """Sort order of windows by name then rank, and where a new name begins in it."""
    order = np.lexsort((rank, b, a))
    x, y = a[order], b[order]
    new = np.ones(len(order), bool)
    new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    return order, new


def _ask_windows(buckets, window, ranges, part, blocks, answers):
    _, _, rank, a, b = _windows(P.unpack(blocks), answers, window)
    order, new = _grouped(rank, a, b)
    at = order[new]
    ka, kb = a[at], b[at]
    return _ask(part, buckets, 64, min(part, ranges), ka, lambda i, j: P.pack_numbers(kb[i:j]))


def _repeats(table: pa.Table, answers: pa.Table, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(chunk, start) of the windows that a document before has, ascending by chunk."""
    chunk, at, rank, a, b = _windows(table, answers, window)
    order, new = _grouped(rank, a, b)
    del a, b
    repeat = np.zeros(len(order), bool)
    if len(order):
        group = np.cumsum(new) - 1
        ranked = rank[order]
        repeat[order] = _read_answers(answers, 2)[group] | (ranked > ranked[np.flatnonzero(new)][group])
    return chunk[repeat], at[repeat]


def _remove(window, carried, text_at, part, blocks, answers):
    table = P.unpack(blocks)
    chunk, at = _repeats(table, answers, window)
    n_words, n_removed, kept = [], [], []
    raw, offsets = text_buffer(table["c1"])
    for c, (i, j) in enumerate(chunks(offsets)):
        w = Words(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        n = len(w)
        s = at[np.searchsorted(chunk, c) : np.searchsorted(chunk, c, side="right")]
        cover = np.cumsum(np.bincount(s, minlength=n + 1) - np.bincount(s + window, minlength=n + 1)[: n + 1])[:n] > 0
        per_text = np.add.reduceat(np.append(cover, False), w.of_text[:-1]) if n else np.zeros(j - i, np.int64)
        per_text = np.where(w.counts() > 0, per_text, 0)
        n_words.append(w.counts())
        n_removed.append(per_text)
        data, texts = raw[offsets[i] : offsets[j]].tobytes(), []
        base, keep = offsets[i], (~cover)
        for k in range(i, j):
            words = data[offsets[k] - base : offsets[k + 1] - base].split()
            if per_text[k - i]:
                w0 = w.of_text[k - i]
                words = list(compress(words, keep[w0 : w0 + len(words)].tolist()))
            texts.append(b" ".join(words))
        kept.append(pa.array(texts, pa.binary()).cast(pa.string()))
    columns = [table[f"c{k}"] for k in range(carried)]
    ints = lambda x: pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64())
    names = [f"c{k}" for k in range(carried)] + ["n_words", "n_removed", "kept_text"]
    return pa.Table.from_arrays([*columns, ints(n_words), ints(n_removed), pa.chunked_array(kept, pa.string())], names=names)


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                     part_bytes: int = P.PART_BYTES) -> DataFrame:
    """Remove each word covered by a ``window``-word sequence that also starts in a document with a smaller id.

    Returns the columns of ``docs`` and ``n_words``, ``n_removed`` (long) and ``kept_text``: the kept words joined by
    one space. Windows are judged on the input, not on what is left. ``window`` is 13 or more (shorter windows
    have no certain common symbol after two pair rounds).

    Defined cases: null text counts as empty (no words, kept text empty); texts of under ``window``
    words lose nothing; rows that share an id are one document and never remove each other's words; a null id
    counts as larger than any other, and rows without id never remove each other's words; an empty table
    gives an empty table; further columns are carried unchanged, whatever their names (those of the three
    results excepted, which are replaced).
    """
    if window < WINDOW:
        raise ValueError(f"window must be at least {WINDOW}")
    results = {"n_words", "n_removed", "kept_text"}
    carry = [id_col, text_col] + [c for c in docs.columns if c not in (id_col, text_col) and c not in results]
    dealt = P.gather(docs, id_col, text_col, carry, part_bytes=part_bytes)
    buckets = dealt.buckets
    asked = dealt.visit(partial(_ask_symbols, buckets, window), _ASK)
    shared = asked.groupBy("bucket").applyInArrow(_answer_shared, _ANSWER).checkpoint()
    asked = dealt.visit_with(shared, partial(_ask_windows, buckets, window, dealt.ranges), _ASK)
    before = asked.groupBy("bucket").applyInArrow(_answer_before, _ANSWER).checkpoint()
    fields = ", ".join(f"c{k} {docs.schema[c].dataType.simpleString()}" for k, c in enumerate(carry))
    out = dealt.visit_with(
        shared.unionByName(before), partial(_remove, window, len(carry), 1), f"{fields}, n_words long, n_removed long, kept_text string"
    )
    back = [F.col(f"c{carry.index(c)}").alias(c) for c in docs.columns if c not in results]
    return out.select(*back, "n_words", "n_removed", "kept_text")


def _answer_shared(key, table):
    return _answer(key, table, _decide_shared, 1)


def _answer_before(key, table):
    return _answer(key, table, _decide_before, 2)


def op8_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Kept words of every document (13-word windows), as a digest."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = dedup_substrings(docs)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), pos AS (
  SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS p FROM w WHERE len(ws) >= 13
), win AS (
  SELECT doc_id, p, array_to_string(list_slice(ws, p, p + 12), ' ') AS k FROM pos
), firsts AS (
  SELECT k, min(doc_id) AS first_doc FROM win GROUP BY k
), hit AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS q FROM win JOIN firsts USING (k) WHERE first_doc < doc_id
), hits AS (
  SELECT doc_id, list(q) AS qs FROM hit GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(qs), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(CASE WHEN qs IS NULL THEN ws ELSE
         [ws[i] FOR i IN range(1, len(ws) + 1) IF NOT list_contains(qs, i)] END, ' '), '')) AS kept_sha256
FROM w LEFT JOIN hits USING (doc_id)
"""
