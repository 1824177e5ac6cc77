"""Language-model scores by a probabilistic suffix tree, beside a word unigram base.

The tree's symbols are the bytes of a text's words, joined by one space, and an end symbol, so the model
is a distribution over whole word sequences with no unknown words. Contexts are the up to DEPTH symbols before
a position (before a text's start: the end symbol again).

* Gathering: a gram is a context of full depth and its next symbol, exact in 64 bits, the latest symbol on top, so
  that the contexts that end alike are neighbours in sorted order. A part sends its distinct grams with their
  training counts, cut into ranges of the last NEAR symbols; the counts of contexts up to NEAR - 1 symbols are
  summed before and go to the ranges below them. No task and no driver holds the whole tree.
* Growing: a range holds whole subtrees. A context that occurs at least ``min_count`` times, an absolute number, is a
  candidate; it is kept if its next-symbol distribution diverges from its parent's (the context one symbol
  shorter): count times Kullback-Leibler divergence above a threshold, or if a kept context extends it.
  Candidates of fewer than NEAR symbols are all kept. So the model grows with what the corpus attests.
* Smoothing: a context's distribution is its counts and ``weight`` counts spread as the parent predicts; the
  root mixes with the uniform distribution over all 257 symbols.
* Scoring: a range answers each gram of a part with the probability after the longest kept suffix.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import parts as P
from riskloom.llm.words import Words, chunks, text_buffer

DEPTH = 7
#: Symbols of a context that choose its range; shorter contexts are counted apart.
NEAR = 4
#: Least count of a kept context.
MIN_COUNT = 4
#: Least count times divergence (in bits) of a kept context.
MIN_DIVERGENCE = 16.0
#: Counts that the parent's prediction is worth.
PARENT_WEIGHT = 4.0
#: Folds by crc32 of the id; this one is held out.
FOLDS, HELD_OUT = 7, 2

_BITS = 9  # a symbol: byte + 1, or 0 for the end
_SYMBOLS = 257
_END = 0x0A  # in grams: a byte that no word has
_WORD = 71  # seed of the names of words
#: Bytes of text whose symbols are expanded at a time (a longer text is taken whole).
_STEP_BYTES = 1 << 18
#: Ranges of contexts for each range of ids: a range's levels take some hundred bytes a gram.
RANGES_PER_BUCKET = 2
#: Texts, and characters of each, whose grams balance the ranges (they steer cost only).
SAMPLE_TEXTS, SAMPLE_CHARS = 1000, 4096


def _held_out(ids: pa.ChunkedArray) -> np.ndarray:
    import zlib

    return np.array([i is not None and zlib.crc32(str(i).encode()) % FOLDS == HELD_OUT for i in ids.to_pylist()], bool)


def _words(table: pa.Table):
    raw, offsets = text_buffer(table["c1"])
    for i, j in chunks(offsets, _STEP_BYTES):
        yield i, j, Words(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], lower=True)


def _totals(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[at], np.add.reduceat(counts, at) if len(at) else counts


def _training_words(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words of a part (by name) with their counts in its training texts."""
    out, keys, counts = _held_out(table["_id"]), [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for i, j, w in _words(table):
        k, c = _totals(w.names(_WORD), np.repeat(~out[i:j], w.counts()).astype(np.int64))
        keys.append(k), counts.append(c)
    return _totals(np.concatenate(keys), np.concatenate(counts))


def _codes(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the texts' words joined by one space, each text after DEPTH ends and closed by one -> (bytes, position of each text's first, symbols of each with its end)."""
    edge = np.zeros(len(w.raw) + 1, np.int8)
    edge[w.starts] += 1
    edge[w.ends] -= 1
    keep = np.cumsum(edge[:-1], dtype=np.int8).view(bool)
    between = w.ends[:-1][~w.heads()[1:]]  # the byte after a word that its text has another after
    raw = w.raw.copy()
    raw[between], keep[between] = 0x20, True
    bytes_before = np.concatenate([[0], np.cumsum(w.ends - w.starts)])
    length = np.diff(bytes_before[w.of_text]) + np.maximum(w.counts(), 1)  # spaces between words, and the end
    begin = np.cumsum(length + DEPTH) - length
    out, inner = np.full(int(length.sum()) + DEPTH * len(length), _END, np.uint8), _predicted(begin, length)
    inner[begin + length - 1] = False
    out[inner] = raw[keep]
    return out, begin, length


def _predicted(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """True at positions that are predicted: every symbol of every text, the end too."""
    out = np.ones(int(length.sum()) + DEPTH * len(length), bool)
    out[(begin[:, None] - np.arange(1, DEPTH + 1)).ravel()] = False
    return out


def _grams(w: Words, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Context and symbol of each predicted position, and how many each text has.

    A gram has a byte for each, the symbol lowest, the symbol before it on top: the 8 bytes up to a position, turned by one.
    """
    codes, begin, length = _codes(w)
    if not len(codes):
        return np.zeros(0, np.uint64), length
    eight = np.ndarray(len(codes) - DEPTH, "<u8", codes, strides=(1,))[_predicted(begin, length)[DEPTH:]]
    out = eight << np.uint64(8)
    if depth < DEPTH:
        out >>= np.uint64(8 * (DEPTH - depth))
        out &= ~np.uint64(0xFF)
    out |= eight >> np.uint64(56)
    return out, length


def _runs(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of an ascending array, and how often each occurs."""
    if not len(sorted_keys):
        return sorted_keys, np.zeros(0, np.int64)
    first = np.flatnonzero(np.append(True, sorted_keys[1:] != sorted_keys[:-1]))
    return sorted_keys[first], np.diff(first, append=len(sorted_keys))


def _distinct(table: pa.Table, depth: int, train_only: bool) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct grams of a part with their counts in its training texts.

    All grams of the part (8 bytes a position) are sorted at once, in place: smaller than merging the distinct
    ones of its chunks, which keep most of their number.
    """
    out, raw_bytes = _held_out(table["_id"]), len(text_buffer(table["c1"])[0])
    # no text has more symbols than bytes and an end; short grams sort faster as 32 bits
    grams = np.empty(raw_bytes + len(table), np.uint64 if depth > 3 else np.uint32)
    i_train, i_rest = 0, len(grams)  # training grams from the front, the others from the back
    for i, j, w in _words(table):
        new, length = _grams(w, depth)
        rest = np.zeros(0, np.uint64)
        if out[i:j].any():
            held = np.repeat(out[i:j], length)
            new, rest = new[~held], new[held]
        grams[i_train : i_train + len(new)] = new
        i_train += len(new)
        if not train_only and len(rest):
            i_rest -= len(rest)
            grams[i_rest : i_rest + len(rest)] = rest
    grams[:i_train].sort()
    grams[i_rest:].sort()
    keys, counts = _runs(grams[:i_train])
    other, _ = _runs(grams[i_rest:])
    del grams
    keys, other = keys.astype(np.uint64, copy=False), other.astype(np.uint64, copy=False)
    if not len(other):
        return keys, counts
    at = np.searchsorted(keys, other)
    fresh = at == len(keys)
    fresh[~fresh] = keys[at[~fresh]] != other[~fresh]
    return np.insert(keys, at[fresh], other[fresh]), np.insert(counts, at[fresh], 0)


def _count_near(part, blocks):
    gram, n = _distinct(P.unpack(blocks), NEAR - 1, True)
    return pa.table({"gram": pa.array(gram.astype(np.int64)), "n": pa.array(n)})


def _deal_near(bounds, batches):
    """Counts of a short context go to all ranges that hold extensions of it."""
    for batch in batches:
        d, gram = (np.asarray(batch.column(k).to_numpy(), np.int64) for k in (0, 1))
        open_bits = 8 * (NEAR - d)
        low = gram >> 8 << open_bits
        first = np.searchsorted(bounds, low, side="right")
        last = np.searchsorted(bounds, low + (np.int64(1) << open_bits) - 1, side="right")
        times = last - first + 1
        row = np.repeat(np.arange(len(d)), times)
        bucket = np.repeat(first - (np.cumsum(times) - times), times) + np.arange(len(row))
        yield pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int32)), *(c.take(pa.array(row)) for c in batch.columns)], names=["bucket", "d", "gram", "n"])


_ASK = "part int, bucket int, n long, keys binary, counts binary"
_ASK_ARROW = pa.schema([("part", pa.int32()), ("bucket", pa.int32()), ("n", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
_ANSWER = "part int, bucket int, n long, log10p binary"
_ANSWER_ARROW = pa.schema([("part", pa.int32()), ("bucket", pa.int32()), ("n", pa.int64()), ("log10p", pa.binary())])


def _ask_grams(bounds, part, blocks):
    gram, n = _distinct(P.unpack(blocks), DEPTH, False)
    edges = [0, *np.searchsorted(gram, bounds.astype(np.uint64) << np.uint64(8 * (DEPTH + 1 - NEAR))).tolist(), len(gram)]
    rows = [{"part": part, "bucket": k, "n": j - i, "keys": P.pack_sorted(gram[i:j]), "counts": P.pack_numbers(n[i:j])}
            for k, (i, j) in enumerate(zip(edges[:-1], edges[1:])) if i < j]
    return pa.Table.from_pylist(rows, schema=_ASK_ARROW)


def gram_scores(keys: np.ndarray, n: np.ndarray, near: list[tuple[np.ndarray, np.ndarray]], min_count: int, weight: float, min_divergence: float) -> np.ndarray:
    """log10 probability of each gram's symbol after the longest kept suffix of its context.

    keys: ascending distinct grams, all training grams of their last NEAR symbols among them, with training counts n;
    near[d]: ascending (context of d < NEAR symbols, symbol) and counts, of all that the grams' contexts need.
    """
    symbol = keys & np.uint64(0xFF)
    pairs, rows = [], [None] * (DEPTH + 1)  # (context, symbol) of each depth; of a pair, the pair one symbol shorter
    below = keys
    for d in range(DEPTH, -1, -1):
        if d < DEPTH:
            shorter = below >> np.uint64(16) << np.uint64(8) | below & np.uint64(0xFF)
            below, rows[d + 1] = np.unique(shorter, return_inverse=True)
        pairs.append(below)
    pairs.reverse()
    counts = [None] * DEPTH + [n]
    for d in range(DEPTH - 1, NEAR - 1, -1):
        counts[d] = np.bincount(rows[d + 1], counts[d + 1], len(pairs[d])).astype(np.int64)
    every = int(near[0][1].sum())
    at = np.searchsorted(near[0][0], pairs[0])
    at = np.minimum(at, max(len(near[0][0]) - 1, 0))
    n_root = np.where(near[0][0][at] == pairs[0], near[0][1][at], 0) if len(near[0][0]) else np.zeros(len(pairs[0]), np.int64)
    p = [(n_root + 0.5) / (every + 0.5 * _SYMBOLS)]
    kept, groups = [np.ones(len(pairs[0]), bool)], [None]
    for d in range(1, DEPTH + 1):
        context = pairs[d] >> np.uint64(8)
        above = p[d - 1][rows[d]]
        new = np.append(True, context[1:] != context[:-1])
        group = np.cumsum(new) - 1
        if d < NEAR:
            k, c = near[d]
            names, sums = _totals(k >> np.uint64(8), c)
            total, c_own = np.zeros(int(new.sum()), np.int64), np.zeros(len(context), np.int64)
            if len(k):
                i = np.minimum(np.searchsorted(names, context[new]), len(names) - 1)
                total = np.where(names[i] == context[new], sums[i], 0)
                i = np.minimum(np.searchsorted(k, pairs[d]), len(k) - 1)
                c_own = np.where(k[i] == pairs[d], c[i], 0)
            keep = total >= min_count
        else:
            c_own = counts[d]
            total = np.bincount(group, c_own, int(new.sum())).astype(np.int64)
            with np.errstate(divide="ignore", invalid="ignore"):
                bits = np.where(c_own > 0, c_own * np.log2(c_own / (total[group] * above)), 0.0)
            keep = (total >= min_count) & (np.bincount(group, bits, len(total)) > min_divergence)
        p.append((c_own + weight * above) / (total[group] + weight))
        kept.append(keep), groups.append(group)
    for d in range(DEPTH, NEAR, -1):  # a kept context keeps its suffixes
        up = groups[d - 1][rows[d]]
        kept[d - 1][up[kept[d][groups[d]]]] = True
    best = p[0]
    for d in range(1, DEPTH + 1):
        best = np.where(kept[d][groups[d]], p[d], best[rows[d]])
    return np.log10(best)


def _answer_grams(min_count, weight, min_divergence, key, asks, near):
    rows = asks.to_pylist()
    if not rows:
        return pa.Table.from_pylist([], schema=_ANSWER_ARROW)
    keys = np.concatenate([P.unpack_sorted(r["keys"], r["n"]) for r in rows])
    counts = np.concatenate([P.unpack_numbers(r["counts"], np.int64, r["n"]) for r in rows])
    distinct, sums = _totals(keys, counts)
    del counts
    d, gram, n = (np.asarray(near[c].to_numpy(), np.int64) for c in ("d", "gram", "n"))
    levels = [_totals(gram[d == k].astype(np.uint64), n[d == k]) for k in range(NEAR)]
    found = gram_scores(distinct, sums, levels, min_count, weight, min_divergence).astype(np.float32)
    out, at = [], 0
    for r in rows:
        mine = keys[at : at + r["n"]]
        out.append({"part": r["part"], "bucket": r["bucket"], "n": r["n"], "log10p": P.pack_numbers(found[np.searchsorted(distinct, mine)])})
        at += r["n"]
    del keys, distinct, found
    P.give_back()
    return pa.Table.from_pylist(out, schema=_ANSWER_ARROW)


class SuffixTree:
    """The model of a few counts in memory. Kept contexts as nodes; child[node, class] one symbol further back (0: none), log10p[node, class]."""

    def __init__(self, depth: np.ndarray, context: np.ndarray, symbol: np.ndarray, n: np.ndarray,
                 weight: float = PARENT_WEIGHT, min_divergence: float = MIN_DIVERGENCE) -> None:
        root = np.zeros(_SYMBOLS)
        at = depth == 0
        root[symbol[at]] = n[at]
        seen = np.flatnonzero(root)
        k = len(seen) + 1  # the last class: any symbol not seen
        self.class_of = np.full(_SYMBOLS, k - 1, np.int64)
        self.class_of[seen] = np.arange(len(seen))
        spread = (root + 0.5) / (root.sum() + 0.5 * _SYMBOLS)
        levels = [(np.zeros(1, np.int64), np.append(spread[seen], 0.5 / (root.sum() + 0.5 * _SYMBOLS))[None, :], np.ones(1, bool), np.zeros(1, np.int64))]
        for d in range(1, int(depth.max(initial=0)) + 1):
            at = depth == d
            names, row = np.unique(context[at], return_inverse=True)
            counts = np.zeros((len(names), k))
            counts[row, self.class_of[symbol[at]]] = n[at]
            up = np.searchsorted(levels[-1][0], names & ((1 << _BITS * (d - 1)) - 1))
            above, total = levels[-1][1][up], counts.sum(1, keepdims=True)
            share = counts / np.maximum(total, 1)
            with np.errstate(divide="ignore", invalid="ignore"):
                bits = np.where(counts > 0, share * np.log2(share / above), 0.0).sum(1)
            levels.append((names, (counts + weight * above) / (total + weight), total[:, 0] * bits > min_divergence, up))
        keep = [x[2].copy() for x in levels]
        for d in range(len(levels) - 1, 0, -1):  # a kept context keeps its suffixes
            keep[d - 1][levels[d][3][keep[d]]] = True
        number, first = [], 0
        for x in keep:
            number.append(np.where(x, first + np.cumsum(x) - 1, 0))
            first += int(x.sum())
        self.child = np.zeros((first, k), np.int32)
        self.log10p = np.log10(np.concatenate([x[1][y] for x, y in zip(levels, keep)])).astype(np.float32)
        for d in range(1, len(levels)):
            names, _, _, up = levels[d]
            oldest = self.class_of[names >> (_BITS * (d - 1))]
            own = keep[d]
            self.child[number[d - 1][up[own]], oldest[own]] = number[d][own]
        self.depth = len(levels) - 1

    def __len__(self) -> int:
        return len(self.child)

    def scores(self, stream: np.ndarray, at: np.ndarray) -> np.ndarray:
        """log10 probability of the symbol at each position."""
        symbols = self.class_of[stream]
        node, alive = np.zeros(len(at), np.int64), np.arange(len(at))
        for d in range(1, self.depth + 1):
            further = self.child[node[alive], symbols[at[alive] - d]]
            alive, further = alive[further > 0], further[further > 0]
            node[alive] = further
        return self.log10p[node, symbols[at]].astype(np.float64)


def _range_bounds(docs: DataFrame, text_col: str, n_rows: int, buckets: int) -> np.ndarray:
    """First last-NEAR-symbols of each range but the first, from the distinct grams of a bounded sample."""
    if buckets < 2 or not n_rows:
        return np.zeros(0, np.int64)
    drawn = docs.select(F.substring(F.col(text_col).cast("string"), 1, SAMPLE_CHARS).alias("t")).sample(min(1.0, 2 * SAMPLE_TEXTS / n_rows), 7).limit(SAMPLE_TEXTS).toArrow()
    raw, offsets = text_buffer(drawn["t"])
    near = np.unique(_grams(Words(raw, offsets, lower=True))[0]) >> np.uint64(8 * (DEPTH + 1 - NEAR))
    if not len(near):
        return np.zeros(0, np.int64)
    return np.unique(near[np.arange(1, buckets) * len(near) // buckets].astype(np.int64))


def ask_model(docs: DataFrame, dealt: P.Parts, text_col: str, min_count: int = MIN_COUNT, weight: float = PARENT_WEIGHT, min_divergence: float = MIN_DIVERGENCE) -> DataFrame:
    """The model's answers to the grams of every part, for ``visit_with``."""
    n_rows = dealt.table.agg(F.sum("n_rows").alias("n")).first()["n"] or 0
    bounds = _range_bounds(docs, text_col, n_rows, RANGES_PER_BUCKET * dealt.buckets if dealt.buckets > 1 else 1)
    longest = dealt.visit(_count_near, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    by = F.explode(F.sequence(F.lit(0), F.lit(NEAR - 1))).alias("d")
    near = longest.select("gram", "n", by).select(
        "d", F.expr(f"shiftright(gram, 8 * ({NEAR} - d)) * 256 + (gram & 255)").alias("gram"), "n"
    ).groupBy("d", "gram").agg(F.sum("n").alias("n"))
    near = near.mapInArrow(partial(_deal_near, bounds), "bucket int, d int, gram long, n long")
    asked = dealt.visit(partial(_ask_grams, bounds), _ASK)
    return asked.groupBy("bucket").cogroup(near.groupBy("bucket")).applyInArrow(partial(_answer_grams, min_count, weight, min_divergence), _ANSWER)


def _score(n_train_texts, known, total, part, blocks, answers):
    table = P.unpack(blocks)
    grams, at = np.empty(len(text_buffer(table["c1"])[0]) + len(table), np.uint64), 0
    names, sizes = [np.zeros(0, np.uint64)], []  # sizes of a step's texts: words, and symbols
    for _, _, w in _words(table):
        new, length = _grams(w)
        grams[at : at + len(new)] = new
        at += len(new)
        names.append(w.names(_WORD)), sizes.append((w.counts(), length))
    grams = grams[:at]
    distinct = grams.copy()
    distinct.sort()
    distinct, _ = _runs(distinct)
    _, word = np.unique(np.concatenate(names), return_inverse=True)
    del names
    of_words = pc.is_valid(answers["counts"])
    counts = P.read_counts(answers.filter(of_words))
    found = sorted(answers.filter(pc.invert(of_words)).select(["bucket", "n", "log10p"]).to_pylist(), key=lambda r: r["bucket"])
    log10p = np.concatenate([P.unpack_numbers(r["log10p"], np.float32, r["n"]) for r in found])  # every text has an end
    del found
    n, v = total + n_train_texts, known + (n_train_texts > 0)
    rows = {"n_tokens": [], "n_known": [], "base_score": [], "score": []}
    log_all = np.log10(n + v + 1.0)
    at_word = at_gram = 0
    for n_words, length in sizes:
        c = counts[word[at_word : at_word + int(n_words.sum())]]
        at_word += len(c)
        texts = np.cumsum(n_words) - n_words

        def add(x, end):
            sums = np.add.reduceat(np.append(x, 0), texts) if len(texts) else np.zeros(0)
            return np.where(n_words > 0, sums, 0) + end

        rows["n_tokens"].append(n_words + 1)
        rows["n_known"].append(add((c > 0).astype(np.int64), int(n_train_texts > 0)))
        rows["base_score"].append(add(np.log10(c + 1.0) - log_all, np.log10(n_train_texts + 1.0) - log_all))
        gram = grams[at_gram : at_gram + int(length.sum())]
        at_gram += len(gram)
        order = np.argsort(gram)  # each gram is looked up once, and ascending ones stay near each other in memory
        asked, times = _runs(gram[order])
        x = np.empty(len(gram))
        x[order] = np.repeat(log10p[np.searchsorted(distinct, asked)], times)
        rows["score"].append(np.add.reduceat(x, np.cumsum(length) - length))
    join = lambda x, t: pa.array(np.concatenate(x) if x else np.zeros(0), t)
    columns = [table["_id"].combine_chunks(), pa.array(_held_out(table["_id"])), join(rows["n_tokens"], pa.int64()), join(rows["n_known"], pa.int64()),
               pa.array(np.full(len(table), n), pa.int64()), join(rows["base_score"], pa.float64()), join(rows["score"], pa.float64())]
    return pa.Table.from_arrays(columns, names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


_SCORE = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_count: int = MIN_COUNT, part_bytes: int = P.PART_BYTES) -> DataFrame:
    """Per row: held_out, n_tokens, n_known, train_tokens, base_score (word unigram) and score (suffix tree), both log10.

    A row is held out if crc32 of its id as text leaves 2 modulo 7; all others train.

    Defined cases: null, empty and wordless texts are the end token alone; a null id is never held out; repeated rows
    train as often as they occur; without training rows the base score is 0 for every text and the tree
    predicts uniformly; an empty table gives an empty one; further columns are ignored.
    """
    dealt = P.gather(docs, id_col, text_col, part_bytes=part_bytes)
    answers, known, total = P.count_keys(dealt, _training_words)
    model = ask_model(docs, dealt, text_col, min_count)
    answers = answers.select("part", "bucket", "n", "counts", F.lit(None).cast("binary").alias("log10p")).unionAll(
        model.select("part", "bucket", "n", F.lit(None).cast("binary").alias("counts"), "log10p")
    )
    crc = F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(FOLDS))
    n_train_texts = docs.where(F.col(id_col).isNull() | (crc != HELD_OUT)).count()
    return dealt.visit_with(answers, partial(_score, n_train_texts, known, total), _SCORE).withColumnRenamed("id", id_col)


def op7_suffix_tree(spark, sf_dir: str) -> DataFrame:
    """Base and suffix-tree scores of every document."""
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
