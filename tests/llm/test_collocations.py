"""Phrase collocations against brute force."""

import re
from collections import Counter

import numpy as np
import pytest

from riskloom.llm import collocations as C

SCHEMA = "doc_id long, text string, lang string, phrase string, n long, k int, shard int"


def brute(rows, threshold=30, top=2000):
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und" if lang is None else lang
        low = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, 5):
                f.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    cand = {p: n for p, n in f.items() if len(p) > 2 and n >= threshold}
    inside = Counter()
    for p, n in cand.items():
        w = p[1:]
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                q = (p[0], *w[i : i + k])
                inside[q] = max(inside[q], n)
    out = {}
    for p, a in cand.items():
        if p in inside and 100 * inside[p] >= 80 * a:
            continue
        cuts = []
        for k in range(1, len(p) - 1):
            l, r = f[p[: 1 + k]], f[(p[0], *p[1 + k :])]
            cuts.append((2_000_000 * a // (l + r), k, l, r))
        score, _, l, r = min(cuts)
        out.setdefault(p[0], []).append((-score, -a, " ".join(p[1:]).encode(), l, r))
    return sorted((lang, i + 1, p.decode(), -a, l, r, total[lang], -s)
                  for lang, rows in out.items() for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top]))


def ours(df, **more):
    got = C.collocations(df, **more)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in got.collect())


def edge_rows():
    rng = np.random.default_rng(2)
    vocab = ["the", "The", "of", "new", "york", "city", "ça", "\x1c", "x\x00y", "a-b", "　", "don't"]
    texts = [" ".join(rng.choice(vocab, n)) for n in rng.integers(0, 40, 200)]
    texts += ["new york city, the new\tyork city. of the", "the" * 3_000, " ".join(rng.choice(vocab, 60_000)), None, "", " \t ", ".,;", "one"]
    texts += ["late bird sings loud"] * 40 + ["aa bb cc dd ee"] * 31
    langs = [None, "en", "fr", ""]
    rows = [(i, t, langs[int(k)], "p", 1, 2, 3) for i, (t, k) in enumerate(zip(texts, rng.integers(0, 4, len(texts))))]
    return rows + rows[:5] + [(None, "new york city", None, None, None, None, None)]


@pytest.mark.parametrize("shards, slots, block_bytes, threshold", [(1, 1 << 24, 1 << 23, 30), (3, 1 << 10, 2_000, 12), (4, 8, 30_000, 30)])
def test_collocations_equal_brute_force(spark, shards, slots, block_bytes, threshold):
    rows = edge_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = brute([(r[2], r[1]) for r in rows], threshold, 50)
    assert len(want) > 20
    assert ours(df, threshold=threshold, top=50, shards=shards, slots=slots, block_bytes=block_bytes) == want


@pytest.mark.parametrize("seed, n_words, shards, slots, threshold", [(5, 8, 3, 16, 4), (49, 7, 1, 8, 19)])
def test_phrases_that_share_a_slot_lose_no_occurrence(spark, seed, n_words, shards, slots, threshold):
    rng = np.random.default_rng(seed)
    share = 1 / np.arange(1, n_words + 1)
    texts = [" ".join(rng.choice([f"w{i}" for i in range(n_words)], 20, p=share / share.sum())) for _ in range(30)]
    want = Counter(" ".join(w[i : i + k]) for w in map(str.split, texts) for k in range(1, 5) for i in range(len(w) - k + 1))
    df = spark.createDataFrame([("en", t) for t in texts], "lang string, text string").coalesce(1)
    got, _ = C.count_phrases(df, threshold, shards=shards, slots=slots, block_bytes=300)
    assert sorted((r.phrase, r.n) for r in got.collect()) == sorted((p, n) for p, n in want.items() if n >= threshold)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = brute([(r.lang, r.text) for r in docs.select("lang", "text").collect()])
    assert sorted(tuple(r) for r in C.op12_collocations(spark, "/root/testdata/sf0.001").collect()) == want


def test_long_text_is_sliced_between_words(monkeypatch):
    text = (b"ab cd. ef" * 50).translate(C._TABLE)
    monkeypatch.setattr(C, "SLICE_BYTES", 7)
    pieces = list(C._slices(text))
    assert b"".join(pieces) == text
    assert [t for p in pieces for t in p.replace(b".", b" . ").split()] == text.replace(b".", b" . ").split()


def test_empty_table(spark):
    assert ours(spark.createDataFrame([], SCHEMA)) == []
