"""Cross-tokenizer alignment against plain library calls on whole texts."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from riskloom.llm import token_alignment as T

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, id long, n_a string, block string, kind int"


def brute(rows):
    """Rows of the contract, sorted, from whole-text calls of both libraries."""
    own = Tokenizer.from_file(A)
    own.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    char = {chr(b): b for b in printable}
    char.update({chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in printable)})
    found, count = [], Counter()
    for doc_id, text in rows:
        groups = []
        if text:
            e = own.encode(" " + text, add_special_tokens=False)
            a = [(i, bytes(char[c] for c in own.id_to_token(i))) for i in e.ids]
            b = []
            for i in sp.encode(text):
                p = sp.id_to_piece(i)
                b.append((i, bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()))
            whole = (" " + text).encode()
            if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b):
                ends = [set(np.cumsum([len(x) for _, x in side]).tolist()) for side in (a, b)]
                cut = sorted(ends[0] & ends[1])
                sides = []
                for side in (a, b):
                    at, out, k = 0, [[] for _ in cut], 0
                    for i, x in side:
                        at += len(x)
                        out[k].append(i)
                        k += at == cut[k]
                    sides.append(out)
                groups = list(zip(*sides))
        links = Counter((x, y) for g in groups for x in g[0] for y in g[1])
        count.update(links.keys())
        found.append((doc_id, groups, links))
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for doc_id, groups, links in found:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc_id, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(links.values()),
                    sum(n for p, n in links.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in links.items()),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=str)


def ours(df, **more):
    return sorted([tuple(r) for r in T.align(df, A, B, **more).collect()], key=str)


def edge_rows():
    rng = np.random.default_rng(3)
    long = " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, n)) for n in rng.integers(1, 12, 20_000))
    texts = [None, "", " ", "  ", "\n", " \r\n x", "a\tb\n  c   d  ", "x; \r\ny();\r\n}\r\n\r\n", "x▁y", "x ▁ y", "<s> hi </s> <unk> <0x41>", "say <|endoftext|> now",
             "café 中文 \U0001f600 q 　 z\x1c \x85", "é ﬁx ① \x00 end", "Hello  world", "Hello  world", "don't'll 12345 --- !!! ", "\r", "a\r", " a", long, long + " tail",
             "​﻿ zero", "=" * 500, "ab" * 400, "\t\tint main() {\n\t\treturn 0;\n\t}\n", "a" + " " * 30_000 + "b"]
    ids = [*range(len(texts) - 3), None, None, 5]
    return [(i, t, 7, "n", "b", 1) for i, t in zip(ids, texts)] + [(14, "Hello  world", 7, "n", "b", 1)]


@pytest.mark.parametrize("block_bytes", [200, 8 << 20])
def test_alignment_equals_plain_calls(spark, block_bytes):
    rows = edge_rows()
    got = ours(spark.createDataFrame(rows, SCHEMA).repartition(3), block_bytes=block_bytes)
    assert got == brute([r[:2] for r in rows])


def test_query_equals_plain_calls(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = T.op13_token_alignment(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute([tuple(r) for r in docs])


def test_empty_table(spark):
    assert ours(spark.createDataFrame([], SCHEMA)) == []


@pytest.mark.parametrize("frame", [3, 40, 10_000])
def test_runs_merge_frame_by_frame(monkeypatch, frame):
    monkeypatch.setattr(T, "FRAME", frame)
    rng = np.random.default_rng(frame)
    runs, sums, best = [], Counter(), defaultdict(int)
    for n in [0, 1, 5, 300, 1000, 37, 300]:
        keys = np.unique(rng.integers(0, 9, n).astype(np.uint64) << np.uint64(32) | rng.integers(0, 200, n).astype(np.uint64))
        runs.append((keys, rng.integers(1, 50, len(keys))))
    runs = [r for r in runs if len(r[0])]
    for keys, counts in runs:
        sums.update(dict(zip(keys.tolist(), counts.tolist())))
    for k, n in sums.items():
        best[k >> 32] = max(best[k >> 32], n)
    for (keys, _), (total, top) in zip(runs, T.merge_runs([T._pack_frames(k, c) for k, c in runs])):
        assert total.tolist() == [sums[k] for k in keys.tolist()]
        assert top.tolist() == [sums[k] == best[k >> 32] for k in keys.tolist()]


def test_wide_groups_are_counted_alike(monkeypatch):
    own = T.Sides(A, B)
    sides = [x for x in (own.encode(r[1]) for r in edge_rows() if r[1]) if x is not None]
    groups = T.Groups(own, [a for a, _ in sides], [b for _, b in sides])
    plain = [x.tolist() for x in groups.records()]
    monkeypatch.setattr(T, "WIDE", 1)
    assert [x.tolist() for x in groups.records()] == plain
