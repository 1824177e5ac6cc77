"""Operators of riskloom.llm against brute force, on whole small tables and on a table of edge cases."""

import hashlib
import math
import re
import uuid
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.llm import mixing, packing, quality_rules, registry, sharding, simhash_dedup, substring_dedup, suffix_tree_lm, token_files, topk_search, warc
from riskloom.llm.components import components
from riskloom.session import ensure_checkpoint_dir

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, part int, block string, fp string, shard int, kept string"


def words(text, lower=True):
    text = text or ""
    if lower:
        text = re.sub("[A-Z]+", lambda m: m[0].lower(), text)
    return re.findall(r"[^\x20\x09-\x0D]+", text)


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls everywhere, empty, wordless and very long texts, repeated ids and rows, clashing column names."""
    rng = np.random.default_rng(5)
    long = " ".join(f"w{i}" for i in rng.integers(0, 400, 30_000))
    shared = " ".join(f"s{i}" for i in range(40))
    texts = [None, "", " \t\n", "one", "a b c", shared, f"x y {shared} z", f"Q {shared}", "be " * 60, "be " * 30, long, long + " tail", shared, shared,
             "don't  <|endoftext|>\r\n café   end \x1c\n", "ȩ́ Å ΣΑΣ \U0001f600"]
    ids = [1, 2, 3, 4, 5, 6, 7, None, 9, 10, 11, 12, 6, 6, None, 16]
    rows = [(i, t, None, None if k % 3 else f"src{k % 2}", None, k, "b", "f", k, "k") for k, (i, t) in enumerate(zip(ids, texts))]
    rows += [rows[5]]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# --- substring dedup ----------------------------------------------------------------------------

def brute_substrings(rows, w=13):
    least = {}
    key = lambda i: math.inf if i is None else i
    for i, t in rows:
        ws = words(t, False)
        for p in range(len(ws) - w + 1):
            x = tuple(ws[p : p + w])
            least[x] = min(least.get(x, math.inf), key(i))
    out = []
    for i, t in rows:
        ws = words(t, False)
        gone = set()
        for p in range(len(ws) - w + 1):
            if least[tuple(ws[p : p + w])] < key(i):
                gone.update(range(p, p + w))
        out.append((i, len(ws), len(gone), " ".join(x for k, x in enumerate(ws) if k not in gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize("part_bytes", [4_000, 1 << 23])
def test_substrings_equal_brute_force(documents, edge, part_bytes):
    for table in (documents, edge):
        got = substring_dedup.dedup_substrings(table, part_bytes=part_bytes)
        assert got.columns == [*table.columns, "n_words", "n_removed", "kept_text"]
        found = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got.collect()), key=str)
        assert found == brute_substrings(rows_of(table))


def thue_morse(n, first="a", second="b"):
    """Two different words of n bytes that every polynomial modulo 2^64 with an odd base confuses for n >= 1024."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join((first, second)[x] for x in bits), "".join((second, first)[x] for x in bits)


@pytest.mark.parametrize("size", [8, 16, 128, 129, 1024, 4096])
def test_words_that_polynomials_confuse_stay_apart(spark, size):
    x, y = thue_morse(size)
    rows = [(1, " ".join(["u"] * 6 + [x] + ["v"] * 6)), (2, " ".join(["u"] * 6 + [y] + ["v"] * 6)), (3, " ".join(["u"] * 6 + [x] + ["v"] * 6))]
    got = substring_dedup.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id, r.n_removed) for r in got.collect()) == [(1, 0), (2, 0), (3, 13)]
    hits = topk_search.search(spark.createDataFrame([(1, x), (2, y)], "doc_id long, text string"), spark.createDataFrame([(7, x)], "q long, t string"))
    assert [(r.query_id, r.doc_id) for r in hits.collect()] == [(7, 1)]


def test_recompression_of_runs_and_pairs(spark):
    # long runs and periodic passages, whose windows have few interior symbols
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(["a", "b", "a", "a"], int(n))) for n in rng.integers(5, 120, 60)]
    texts += ["a " * 40, "a " * 20, "a b " * 30, "b a " * 12]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = substring_dedup.dedup_substrings(table, part_bytes=1_000)
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got.collect()), key=str) == brute_substrings(rows_of(table))


# --- SimHash ------------------------------------------------------------------------------------

def brute_fingerprint(text, n=4):
    ws = [x.encode() for x in words(text)]
    if not ws:
        return 0
    shingles = [b" ".join(ws[i : i + n]) for i in range(max(1, len(ws) - n + 1))]
    h = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("leaf_rows", [16, 4096])
def test_simhash_components_equal_brute_force(documents, edge, leaf_rows):
    for table in (documents, edge):
        rows = [(i, brute_fingerprint(t)) for i, t in rows_of(table)]
        fps = sorted({f for _, f in rows})
        root = {f: f for f in fps}
        changed = True
        while changed:
            changed = False
            for a in fps:
                m = min(root[b] for b in fps if (a ^ b).bit_count() <= 4)
                changed, root[a] = changed or m < root[a], m
        least = {}
        for i, f in rows:
            if i is not None:
                least[root[f]] = min(least.get(root[f], i), i)
        want = sorted(((i, f, least.get(root[f])) for i, f in rows), key=str)
        got = simhash_dedup.simhash_components(table, leaf_rows=leaf_rows)
        assert sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got.collect()), key=str) == want


def test_dense_ball_is_one_forest():
    rng = np.random.default_rng(2)
    center = rng.integers(0, 1 << 63, dtype=np.uint64)
    ball = np.unique(np.array([center ^ np.uint64(1 << int(a)) ^ np.uint64(1 << int(b)) for a, b in rng.integers(0, 64, (900, 2))], np.uint64))
    links = simhash_dedup._Links(len(ball))
    every = np.arange(len(ball))
    simhash_dedup._within(ball, every, every, 4, links)
    links.merge()
    assert sum(len(a) for a, _ in links.edges) == len(ball) - 1


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 30)] + [(5000, 5000), (7, 3)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    groups = defaultdict(set)
    for r in got:
        groups[r.root].add(r.node)
    assert sorted(map(sorted, groups.values())) == [list(range(61)), list(range(1000, 1030))]


# --- quality rules ------------------------------------------------------------------------------

def test_statistics_equal_brute_force(documents, edge):
    for table in (documents, edge):
        got = sorted((str(r.text), *[r[c] for c in quality_rules.COUNTS]) for r in quality_rules.with_statistics(table.select("text")).collect())
        want = []
        for _, t in rows_of(table):
            w = words(t, False)
            wins = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
            seen, cover = Counter(wins), set()
            for k, x in enumerate(wins):
                if seen[x] > 1:
                    cover |= {k, k + 1, k + 2}
            lines = [x for x in (t or "").split("\n") if words(x)]
            want.append((str(t), len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(cover)))
        assert got == sorted(want)


def test_rules_are_learned_and_reject_no_clean_row(spark):
    rng = np.random.default_rng(3)
    rows = [(float(a), float(b), bool(a > 0.7 and b < 0.4)) for a, b in rng.random((3000, 2))]
    table = spark.createDataFrame(rows, "x double, y double, bad boolean")
    ensure_checkpoint_dir(spark)
    rules = quality_rules.learn_rules(table, "bad", ["x", "y"])
    judged = table.withColumn("kept", quality_rules.decision_list(rules)).collect()
    assert rules and sum(not r.kept and not r.bad for r in judged) <= 15
    assert sum(not r.kept and r.bad for r in judged) > 0.8 * sum(r.bad for r in judged)
    assert quality_rules.learn_rules(table.where("not bad"), "bad", ["x", "y"]) == []


def test_verdicts_and_kept_rows_agree(spark, documents, edge, empty):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out, _ = quality_rules.quality_verdicts(documents, labels)
    kept = {r.doc_id for r in out.where("kept").collect()}
    assert {r.doc_id for r in quality_rules.keep_good(documents, labels).collect()} == kept
    odd = spark.createDataFrame([(6, None, 0), (None, 0, 0), (9, 0, 0), (9, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality_rules.quality_verdicts(edge, odd)[0].count() == edge.count()
    assert quality_rules.keep_good(empty, labels.limit(0)).count() == 0


# --- tokens: files and packing --------------------------------------------------------------------

def brute_ids(rows, name):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(name))
    return [np.array([*t.encode(x or "", add_special_tokens=False).ids, 1], "<u4") for _, x in rows]


def in_order(table):
    return sorted(rows_of(table), key=lambda r: math.inf if r[0] is None else r[0])


@pytest.mark.parametrize("part_bytes", [4_000, 1 << 23])
def test_token_files_round_trip(spark, documents, edge, part_bytes):
    import public_tokenizers

    for table in (documents, edge):
        folder = f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4().hex}"
        token_files.write_token_files(table, folder, public_tokenizers.path("word_bpe_49k.json"), False, part_bytes=part_bytes)
        got = sorted(token_files.read_token_files(spark, folder).collect(), key=lambda r: r.start)
        rows = in_order(table)
        assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1]]
        assert [r.doc_id for r in got] == [i for i, _ in rows]
        assert Counter((r.doc_id, bytes(r.ids)) for r in got) == Counter((i, x.tobytes()) for (i, _), x in zip(rows, brute_ids(rows, "word_bpe_49k.json")))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300)))
def test_variable_length_coding_round_trip(values):
    v = np.array(values, np.uint32)
    control, data = token_files.encode_values(v)
    assert len(control) == -(-len(v) // 4)
    assert token_files.decode_values(control, data, len(v)).tolist() == values


@pytest.mark.parametrize("part_bytes", [4_000, 1 << 23])
def test_packing_covers_every_id_once(documents, edge, part_bytes):
    import public_tokenizers

    for table in (documents, edge):
        got = packing.pack(table, public_tokenizers.path("byte_bpe_50k.json"), part_bytes=part_bytes).collect()
        got.sort(key=lambda r: (r.sequence_id, r.offset))
        stream, at = b"".join(bytes(r.ids) for r in got), 0
        for r in got:
            assert r.sequence_id * 2048 + r.offset == at and 0 < r.length <= 2048 - r.offset and len(r.ids) == 4 * r.length
            at += r.length
        docs, at = [], 0
        for r in got:
            if r.start == 0:
                docs.append((r.doc_id, stream[4 * at : 4 * (at + r.doc_tokens)]))
            at += r.length
        rows = in_order(table)
        assert [i for i, _ in docs] == [i for i, _ in rows]
        assert Counter(docs) == Counter((i, x.tobytes()) for (i, _), x in zip(rows, brute_ids(rows, "byte_bpe_50k.json")))


# --- sharding -----------------------------------------------------------------------------------

def test_rendezvous_moves_rows_only_to_the_new_shard(spark, documents, edge, empty):
    ensure_checkpoint_dir(spark)
    for table in (documents, edge, empty):
        got = sharding.shard(table.select("doc_id", "text"), "doc_id", [1.0] * 24, ["text"]).collect()
        assert len(got) == table.count() and all(r.grown_shard in (r.shard, 24) for r in got)
        slots = defaultdict(list)
        for r in got:
            slots[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        assert len({(r.doc_id, r.shard) for r in got}) == len({r.doc_id for r in got})


def test_rendezvous_follows_weights(spark):
    got = spark.range(40_000).select(sharding.rendezvous(sharding.F.col("id"), [1.0, 2.0, 5.0]).alias("s")).groupBy("s").count().collect()
    assert {r.s: round(r["count"] / 40_000, 1) for r in got} == {0: 0.1, 1: 0.2, 2: 0.6} or all(
        abs(r["count"] / 40_000 - [0.125, 0.25, 0.625][r.s]) < 0.02 for r in got
    )


# --- archives -----------------------------------------------------------------------------------

def test_archives_round_trip(spark):
    page = "<p>" + "x" * 120 + "</p>\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n"
    rows = [(3, "http://a b/\n", page), (1, None, page), (2, "http://c", page), (None, "http://d", page), (5, "u", None), (6, "u", ""), (7, "u", "short"),
            (8, "u", "short"), (1, "http://e", page), (9, "http://f", "é" * 300_000), (10, "http://f", "\n\n")]
    table = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, path string").repartition(3)
    base = f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    warc.write_arc(table, f"{base}/arc", "page_id", "url", "html", "20200102030405")
    warc.convert_arc(spark, f"{base}/arc", f"{base}/warc")
    got = warc.read_warc(spark, f"{base}/warc").collect()
    want = Counter()
    for i, _, x in rows:
        data = (x or "").encode()
        again = x == page and i in (2, 3)
        want[(i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", 1 if again else None, None if again else data)] += 1
    assert Counter((r.key, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got) == want
    assert all(r.date == "2020-01-02T03:04:05Z" and r.record_id.startswith("<urn:uuid:") for r in got)
    none = f"{base}/none"
    warc.write_arc(table.limit(0), f"{none}/arc", "page_id", "url", "html", "20200102030405")
    warc.convert_arc(spark, f"{none}/arc", f"{none}/warc")
    assert warc.read_warc(spark, f"{none}/warc").count() == 0


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions_parse(version):
    body = b"HTTP/1.1 200 OK\r\n\r\nhi\n"
    block = f"{version} 0 x\n{warc.ARC_FIELDS[version]}\n\n"
    lines = [warc._arc_line(version, "http://u v", "20200101000000", "text/html", len(body)).encode() + b"\n" + body + b"\n"] * 2
    head = warc._arc_line(version, "filedesc://f", "20200101000000", "text/plain", len(block)) + "\n" + block + "\n"
    got = list(warc.parse_arc(head.encode() + b"".join(lines)))
    assert [(f["URL"], f["Archive-length"], c) for f, c in got] == [("http://u v", str(len(body)), body)] * 2
    with pytest.raises(ValueError):
        list(warc.parse_arc((head.encode() + lines[0])[:-4]))


# --- search -------------------------------------------------------------------------------------

def brute_bm25(rows, queries, k=10):
    docs = [(i, Counter(words(t))) for i, t in rows]
    n, mean = len(docs), sum(sum(w.values()) for _, w in docs) / len(docs)
    df = Counter(x for _, w in docs for x in w)
    out = {}
    for q, t in queries:
        hits = []
        for i, w in docs:
            s = sum(c * math.log(1 + (n - df[x] + 0.5) / (df[x] + 0.5)) * w[x] * 2.2 / (w[x] + 1.2 * (0.25 + 0.75 * sum(w.values()) / mean))
                    for x, c in Counter(words(t)).items() if x in w)
            if s > 0 and i is not None:
                hits.append((-round(s, 6), i))
        out[q] = [(i, -s) for s, i in sorted(hits)[:k]]
    return out


@pytest.mark.parametrize("part_bytes", [20_000, 1 << 23])
def test_search_equals_brute_force(documents, part_bytes):
    queries = documents.where("doc_id % 25 = 0").select("doc_id", "text")
    got = defaultdict(list)
    for r in topk_search.search(documents, queries, part_bytes=part_bytes).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.doc_id, r.score))
    want = brute_bm25(rows_of(documents), rows_of(queries))
    for q, hits in want.items():
        assert [i for i, _ in got[q]] == [i for i, _ in hits]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in hits], abs=2e-6)


def test_search_edges(edge, empty):
    assert topk_search.search(edge, edge.select("doc_id", "text").where("doc_id in (1, 2, 3, 5)")).where("query_id <> 5").count() == 0
    assert topk_search.search(empty, edge.select("doc_id", "text")).count() == 0
    assert topk_search.search(edge, empty.select("doc_id", "text")).count() == 0


def test_every_query_row_has_its_own_ranking(spark):
    docs = spark.createDataFrame([(1, "red"), (2, "green"), (3, "red red")], "doc_id long, text string")
    asked = spark.createDataFrame([(None, "red"), (5, "red"), (5, "green"), (None, "green")], "q long, t string")
    got = sorted(((r.query_id, r["rank"], r.doc_id) for r in topk_search.search(docs, asked, part_bytes=70).collect()), key=str)
    assert got == sorted([(q, rank, i) for q in (None, 5) for rank, i in ((1, 3), (2, 1), (1, 2))], key=str)


def test_search_starts_at_a_floor():
    """With the k-th best score as its floor a shard returns the same documents, ties included."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{i}" for i in rng.zipf(1.3, 30) % 200) for _ in range(700)] + ["w1 w2 w3"] * 200
    table = pa.table({"c1": pa.array(texts)})
    terms, df = topk_search._document_counts(table)
    index = topk_search.Index(table, df, len(texts), 25.0)
    for k in (1, 10, 50):
        for size in (1, 3, 40):
            query = np.sort(rng.choice(terms, size, replace=False))
            ids, scores = index.search(query, np.ones(size), len(texts))
            top, found = index.search(query, np.ones(size), k)
            assert top.tolist() == ids[:k].tolist() and found.tolist() == scores[:k].tolist()
            floor = found.min(initial=np.inf) if len(found) == k else 0.0
            assert index.search(query, np.ones(size), k, floor)[0].tolist() == top.tolist()


def test_search_of_many_queries_reads_few_postings_of_frequent_terms(monkeypatch):
    """A shard answers many queries at a time, with the rankings of each alone; frequent terms' postings are read for the documents left only."""
    import pyarrow as pa

    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 40, 30)) + f" r{i % 97} s{i % 331}" for i in range(2000)]
    texts += texts[:300]
    table = pa.table({"c1": pa.array(texts)})
    terms, df = topk_search._document_counts(table)
    index = topk_search.Index(table, df, len(texts), 32.0)
    asked = [np.sort(rng.choice(terms, size, replace=False)) for size in (1, 2, 40, 100, 300) * 70]
    weights = [rng.integers(1, 4, len(q)).astype(float) for q in asked]
    read, spans = [], topk_search._spans
    monkeypatch.setattr(topk_search, "_spans", lambda begin, end: (read.append(int((end - begin).sum())), spans(begin, end))[1])
    alone = [index.search(q, w, 10) for q, w in zip(asked, weights)]
    held = dict(zip(terms.tolist(), df.tolist()))
    assert sum(read) < 0.5 * sum(held[t] for q in asked for t in q.tolist())
    edges = np.cumsum([0, *map(len, asked)])
    for floors in (np.zeros(len(asked)), np.array([s[4] if len(s) > 4 else 0.0 for _, s in alone])):
        query, docs, scores = index.search_all(index.locate(np.concatenate(asked)), np.concatenate(weights), edges, 10, floors)
        for i, (d, s) in enumerate(alone):
            keep = s >= floors[i]
            assert docs[query == i].tolist() == d[keep].tolist() and scores[query == i].tolist() == s[keep].tolist()
    postings = {t: {} for t in terms.tolist()}
    for t, i, j in zip(index.term.tolist(), index.first[:-1], index.first[1:]):
        postings[t] = dict(zip(index.doc[i:j].tolist(), index.impact[i:j].tolist()))
    for (d, s), q, w in list(zip(alone, asked, weights))[::17]:
        whole = Counter()
        for t, c in zip(q.tolist(), w.tolist()):
            whole.update({i: c * x for i, x in postings[t].items()})
        best = sorted((-round(x, 9), i) for i, x in whole.items())[:10]
        assert d.tolist() == [i for _, i in best] and s.tolist() == pytest.approx([-x for x, _ in best])


@pytest.mark.parametrize("part_bytes", [20_000, 1 << 23])
def test_search_on_the_edge_table_equals_brute_force(spark, edge, part_bytes):
    asked = [(100 + k, t) for k, t in enumerate(sorted({t or "" for _, t in rows_of(edge)}))]
    got = defaultdict(list)
    for r in topk_search.search(edge, spark.createDataFrame(asked, "doc_id long, text string"), part_bytes=part_bytes).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.doc_id, r.score))
    want = brute_bm25(rows_of(edge), asked)
    assert sum(map(len, want.values())) > len(asked)
    for q, hits in want.items():
        assert [i for i, _ in got[q]] == [i for i, _ in hits]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in hits], rel=1e-6, abs=2e-6)


# --- mixing -------------------------------------------------------------------------------------

def test_mixture_meets_its_target(documents, edge, empty):
    taken, weights = mixing.mixture(documents, max_repeat=1.25)
    w = {r._source: r for r in weights.collect()}
    total = sum(r.tokens for r in w.values())
    a = next(iter(w.values())).exponent
    powers = {s: (r.tokens / total) ** a for s, r in w.items()}
    for s, r in w.items():
        assert r.weight == pytest.approx(powers[s] / sum(powers.values()))
    assert max(r.weight * total / r.tokens for r in w.values()) == pytest.approx(1.25, abs=1e-3)
    got = Counter()
    for r in mixing.mix(documents, max_repeat=1.25).collect():
        got["=" + r.source] += len(words(r.text))
    longest = max(len(words(t)) for _, t in rows_of(documents))
    assert all(0 <= got[s] - r.budget < longest for s, r in w.items())
    starts = taken.groupBy("_k1", "_epoch").count().where("count > 1").count()
    assert starts == 0
    _, flat = mixing.mixture(documents, entropy=math.log(len(w)) - 1e-4)
    ws = [r.weight for r in flat.collect()]
    assert -sum(x * math.log(x) for x in ws) == pytest.approx(math.log(len(w)) - 1e-4, abs=1e-4)
    same = mixing.mix(edge, max_repeat=100.0)
    assert set(same.columns) == {*edge.columns, "epoch", "position"} and same.count() > 0
    assert mixing.mix(empty, max_repeat=2.0).count() == 0


def test_a_document_of_two_sources_is_taken_in_each(spark):
    rows = [(i, f"t{i} words here", "a", i) for i in range(120)] + [(i if i < 10 else i + 1000, f"t{i} words here" if i < 10 else f"u{i}", "b", i) for i in range(120)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string, _k1 long"), max_repeat=1.0)
    assert sorted((r.doc_id, r.text, r.source, r._k1) for r in out.collect()) == sorted(rows)


# --- language model -----------------------------------------------------------------------------

def test_base_scores_equal_brute_force(documents, edge):
    for table in (documents, edge):
        rows = [(i, [*words(t), None]) for i, t in rows_of(table)]
        out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
        c = Counter(w for i, ws in rows if not out(i) for w in ws)
        n, v = sum(c.values()), len(c)
        want = sorted((str(i), out(i), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)) for i, ws in rows)
        got = suffix_tree_lm.score_documents(table, part_bytes=20_000).collect()
        assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
        assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def brute_tree_scores(rows, min_count, weight=4.0, divergence=16.0):
    """Every context counted in dictionaries, no share of the corpus, no limit on contexts."""
    depth, near, end = suffix_tree_lm.DEPTH, suffix_tree_lm.NEAR, 256
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    texts = [(i, [*" ".join(words(t)).encode(), end]) for i, t in rows]
    counts = {}
    for i, s in texts:
        if not out(i):
            line = [end] * depth + s
            for k in range(depth, len(line)):
                for d in range(depth + 1):
                    counts.setdefault(tuple(line[k - d : k]), Counter())[line[k]] += 1
    total = {c: x.total() for c, x in counts.items()}
    root = counts.get((), Counter())
    memo = {}

    def p(c, x):
        if (c, x) not in memo:
            if not c:
                memo[c, x] = (root[x] + 0.5) / (total.get((), 0) + 0.5 * 257)
            else:
                memo[c, x] = (counts.get(c, Counter())[x] + weight * p(c[1:], x)) / (total.get(c, 0) + weight)
        return memo[c, x]

    kept = {()}
    for c, x in counts.items():
        if total[c] >= min_count and (len(c) < near or sum(n * math.log2(n / total[c] / p(c[1:], b)) for b, n in x.items()) > divergence):
            kept.update(c[k:] for k in range(len(c) + 1))
    scores = []
    for i, s in texts:
        line, score = [end] * depth + s, 0.0
        for k in range(depth, len(line)):
            c = tuple(line[k - depth : k])
            while c not in kept:
                c = c[1:]
            score += math.log10(p(c, line[k]))
        scores.append((str(i), len(s), score))
    return sorted(scores), kept


@pytest.mark.parametrize("part_bytes", [20_000, 1 << 24])
def test_suffix_tree_scores_equal_brute_force(documents, edge, part_bytes):
    for table in (documents.limit(60), edge):
        table = table.checkpoint()
        want, kept = brute_tree_scores(rows_of(table), suffix_tree_lm.MIN_COUNT)
        assert table.columns == edge.columns or max(map(len, kept)) == suffix_tree_lm.DEPTH
        got = sorted((str(r.doc_id), r.score) for r in suffix_tree_lm.score_documents(table, part_bytes=part_bytes).collect())
        want = sorted((i, x) for i, _, x in want)
        assert [i for i, _ in got] == [i for i, _ in want]
        assert [x for _, x in got] == pytest.approx([x for _, x in want], rel=1e-5)


@pytest.mark.parametrize("step", [1, 1 << 18])
def test_suffix_tree_scores_a_part_in_one_pass_over_its_texts(monkeypatch, step):
    import pyarrow as pa
    from riskloom.llm import parts

    texts = [None, "", " \t\n", "a", " b ", "ab ab ab", "A B  C\r\nD", "\x0bcc\x0c", "é ü", "q\x00r \x01", "ab", "x" * 5000] * 2
    ids = pa.array([None if i == 5 else i for i in range(len(texts))], pa.int64())
    table = pa.table({"_id": ids, "c1": pa.array(texts), "_order": pa.array(range(len(texts)))})
    table = table.sort_by([("_id", "ascending"), ("_order", "ascending")])
    block = pa.table({"block": pa.array([parts._pack(table)], pa.binary())})
    grams, _ = suffix_tree_lm._distinct(table, suffix_tree_lm.DEPTH, False)
    words_, counts = suffix_tree_lm._training_words(table)
    log10p = -np.arange(1, len(grams) + 1, dtype=np.float32)
    answers = pa.table({"bucket": pa.array([0, 0]), "n": pa.array([len(counts), len(grams)]), "counts": pa.array([parts.pack_numbers(counts), None], pa.binary()),
                        "log10p": pa.array([None, parts.pack_numbers(log10p)], pa.binary())})
    monkeypatch.setattr(suffix_tree_lm, "_STEP_BYTES", step)
    parsed, plain = [], suffix_tree_lm._words
    monkeypatch.setattr(suffix_tree_lm, "_words", lambda t: (parsed.append(x[1] - x[0]) or x for x in plain(t)))
    got = suffix_tree_lm._score(3, len(counts), int(counts.sum()), 0, block, answers).to_pylist()
    assert sum(parsed) == len(texts)
    value = dict(zip(grams.tolist(), log10p.tolist()))
    for r, text in zip(got, table["c1"].to_pylist()):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode()
        symbols = b"\n" * 7 + b" ".join(re.findall(rb"[^\x20\x09-\x0D]+", low)) + b"\n"
        mine = [int.from_bytes(symbols[i - 7 : i][::-1] + symbols[i : i + 1], "big") for i in range(7, len(symbols))]
        assert r["score"] == pytest.approx(sum(value[g] for g in mine)) and r["n_tokens"] == len(words(text)) + 1


def test_suffix_tree_keeps_a_context_however_large_the_corpus():
    # "qqqqqqqz" 50 times among 10^10 positions that never have a z otherwise
    q, z, e = (np.uint64(ord(c)) for c in "qze")
    context = sum(int(q) << 8 * k for k in range(suffix_tree_lm.DEPTH))
    keys = np.array([context << 8 | int(e), context << 8 | int(z)], np.uint64)
    near = [(np.array([context & ((1 << 8 * d) - 1) if d else 0], np.uint64) << np.uint64(8) | np.array([e, z]), np.array([10**10, 50])) for d in range(suffix_tree_lm.NEAR)]
    scores = suffix_tree_lm.gram_scores(keys, np.array([0, 50]), near, suffix_tree_lm.MIN_COUNT, 4.0, 16.0)
    assert 10.0 ** scores[1] > 0.9 and 10.0 ** scores[0] < 0.1


def test_suffix_tree_is_a_distribution_and_uses_the_longest_suffix():
    # "ab" repeated: after b an a, after a a b
    depth = np.array([0, 0, 1, 1])
    context, symbol = np.array([0, 0, 98, 99]), np.array([98, 99, 99, 98])
    tree = suffix_tree_lm.SuffixTree(depth, context, symbol, np.array([500, 500, 500, 500]))
    p = 10.0 ** tree.log10p.astype(float)
    unseen = 257 - 2
    assert p[:, :-1].sum(1) + unseen * p[:, -1] == pytest.approx(np.ones(len(tree)), rel=1e-5)
    stream = np.array([0, 0, 0, 0, 0, 98, 99, 98, 0])
    scores = 10.0 ** tree.scores(stream, np.array([6, 7]))
    assert scores.min() > 0.95


# --- everything on an empty table; queries and pipeline ---------------------------------------------

def test_empty_tables(empty):
    import public_tokenizers

    assert substring_dedup.dedup_substrings(empty).count() == 0
    assert simhash_dedup.simhash_components(empty).count() == 0
    assert suffix_tree_lm.score_documents(empty).count() == 0
    assert packing.pack(empty, public_tokenizers.path("byte_bpe_50k.json")).count() == 0


def test_token_files_of_an_empty_table(spark, empty):
    import public_tokenizers

    folder = f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    token_files.write_token_files(empty, folder, public_tokenizers.path("word_bpe_49k.json"), False)
    assert token_files.read_token_files(spark, folder).count() == 0


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, name):
    import os
    import sys

    sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))
    from compare import compare, duck

    message, ok = compare(spark, duck(SF), SF, name, registry.QUERIES[name], registry.ORACLES[name])
    assert ok, message


def test_pipeline_stages(spark, documents):
    """Each stage against brute force over its own input."""
    import corpus_pipeline as C

    base, docs = f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4().hex}", documents
    tables = {"input": documents}
    for name, stage in C.STAGES:
        stage(spark, docs, SF).write.parquet(f"{base}/{name}")
        tables[name] = docs = spark.read.parquet(f"{base}/{name}")
    assert [name for name, _ in C.STAGES] == list(tables)[1:]
    assert all(tables[n].columns == documents.columns for n in list(tables)[1:-1])
    good, near, cut, mixed = (tables[n] for n in list(tables)[1:5])
    fps = {i: brute_fingerprint(t) for i, t in rows_of(good)}
    root = {i: min(j for j in fps if (fps[i] ^ fps[j]).bit_count() <= 4) for i in fps}
    while any(root[root[i]] != root[i] for i in root):
        root = {i: root[root[i]] for i in root}
    assert {r.doc_id for r in near.collect()} == {i for i in fps if root[i] == i}
    assert {(i, " ".join(words(t, False))) for i, t in rows_of(cut)} == {(i, kept) for i, _, _, kept in brute_substrings(rows_of(near))}
    whole = set(rows_of(cut))
    assert set(rows_of(mixed)) <= whole
    pieces = tables["packing"].collect()
    assert Counter(r.doc_id for r in pieces if r.start == 0) == Counter(i for i, _ in rows_of(mixed))


def test_near_duplicate_stage_keeps_one_row_per_component(spark, edge):
    """Null ids, repeated ids with equal and with other texts, and equal rows."""
    import corpus_pipeline as C

    near = " ".join(f"n{i}" for i in range(300))
    extra = [(None, "no id at all"), (None, "no id at all"), (None, "no ID at all"), (20, near), (20, near), (None, near), (20, "other text of the id"),
             (21, "other text of the id"), (20, near + " "), (30, "x y"), (30, "x  y"), (None, "x y")]
    columns = ["doc_id", "text"]
    table = edge.select(*columns).unionAll(spark.createDataFrame(extra, "doc_id long, text string")).checkpoint()
    fps = [brute_fingerprint(t) for _, t in rows_of(table)]
    root = {f: f for f in fps}
    for _ in root:
        root = {f: min(root[g] for g in root if (f ^ g).bit_count() <= 4) for f in root}
    groups = {}
    for (i, t), f in zip(rows_of(table), fps):
        groups.setdefault(root[f], []).append((i is None, i or 0, t))
    for got in (C.near_duplicates(spark, table, SF), C.near_duplicates(spark, table.repartition(5), SF)):
        got = got.collect()
        assert Counter(root[brute_fingerprint(r.text)] for r in got) == dict.fromkeys(groups, 1)
        for r in got:
            group = groups[root[brute_fingerprint(r.text)]]
            assert (r.doc_id is None, r.doc_id or 0, r.text) in group and (r.doc_id is None, r.doc_id or 0) == min(group, key=lambda x: x[:2])[:2]
        texts = {(r.doc_id, r.text) for r in got}
        kept = kept if "kept" in locals() else texts
        assert texts == kept  # whatever the partitions
    wide = C.near_duplicates(spark, edge, SF)  # columns that clash with names inside
    assert wide.columns == edge.columns and wide.count() == len({root[brute_fingerprint(t)] for _, t in rows_of(edge)})
    assert C.near_duplicates(spark, edge.limit(0), SF).count() == 0


@pytest.mark.parametrize("name, keeps_space", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_piecewise_ids_are_the_whole_text_ids(name, keeps_space):
    import public_tokenizers
    from tokenizers import Tokenizer

    from riskloom.llm.tokens import Encoder

    texts = ["", " ", "a", "A b,", "don't 's 'tis it's.", "Gr\u00f6\u00dfe, \u00c4RGER! \u00d7\u00f7 \u00e9t\u00e9... \u00ffy", "e\u0301 cafe\u0301, \u00c5\u030a",
             "x<|endoftext|>, <|startoftext|>", "  two  spaces\n\nlines \t", "a1b2 33 a_b (c) [d]; \"q\" `z`~", "\u0130stanbul \u03a3\u03a3 \u4e2d\u6587,", "\u00a0nb \u2003em",
             "w" * 3000 + "," * 50, "end\u00ad soft \u00b5\u00aa\u00ba"]
    library = Tokenizer.from_file(public_tokenizers.path(name))
    got = Encoder(public_tokenizers.path(name), keeps_space, 1).encode([t.encode() for t in texts])
    assert [np.frombuffer(g, np.uint32).tolist() for g in got] == [[*library.encode(t, add_special_tokens=False).ids, 1] for t in texts]


def test_pieces_outlive_a_generation_of_the_cache(documents, monkeypatch):
    """Ids are those of a plain call, whatever the size of the cache and whichever library learns a piece."""
    import public_tokenizers
    from tokenizers import Tokenizer

    from riskloom.llm import tokens

    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    odd = ["", "\n\n  a", "it's we'LL don't", "é" * 3000 + " x²½", "a" * 9000, "Ωmega слово 漢字 \u0370\u2c2f", "a<|endoftext|>b", "\t\tx\r\ny  "]
    texts = odd + [r["text"] or "" for r in documents.select("text").collect()] + odd
    want = [np.array([*plain.encode(t, add_special_tokens=False).ids, 1], np.uint32).tobytes() for t in texts]
    assert tokens.rank_table(path) is not None
    assert tokens.rank_table(public_tokenizers.path("word_bpe_49k.json")) is None
    for entries in (1, 50, 300_000):
        monkeypatch.setattr(tokens, "CACHE_ENTRIES", entries)
        own = tokens.Encoder(path, True, 1)
        assert own.encode([t.encode() for t in texts]) == want


@pytest.mark.parametrize("name, keeps_space", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_a_piece_of_a_step_is_looked_up_once(name, keeps_space):
    """However often texts repeat it: the merge model gets a word once, the rank table all new pieces in a few calls."""
    import public_tokenizers

    from riskloom.llm.tokens import Encoder

    own, calls = Encoder(public_tokenizers.path(name), keeps_space, 1), Counter()
    words = [a + b + c for a in ("in", "er", "th", "qu") for b in ("on", "at", "ét", "x") for c in ("s", "ed", "ing", "zz")]
    texts = [("a " + " ".join(words[k:] + words[:k]) + ".").encode() for k in range(64)]
    want = own.encode(texts)
    if keeps_space:
        ranked = own.ranked.encode_ordinary
        own.ranked.encode_ordinary = lambda text: calls.update(["call"]) or ranked(text)
    else:
        merge = own.merge
        own.merge = lambda word: calls.update([word]) or merge(word)
    own.cache.forget()
    assert own.encode(texts) == want
    assert calls["call"] <= 2 if keeps_space else len(calls) == len(words) + 1 and set(calls.values()) == {1}
    own.cache.forget()
    calls.clear()
    own.encode([b"a b, B. " + "Bé".encode()])
    assert calls["call"] <= 2 if keeps_space else len(calls) == 3 and set(calls.values()) == {1}  # lower-cased before


def test_joined_pieces_are_the_whole_text_ids(monkeypatch):
    """Odd characters between pieces that are learned together, in steps and calls of any size."""
    import random

    import public_tokenizers
    import pyarrow as pa
    from tokenizers import Tokenizer

    from riskloom.llm import tokens

    units = [" ", " ", " ", "\n", "\t", "\r\n", "  ", "a", "b", "The", "é", "É", "ß", "×", "'s", "'ll", "’s", "1", "23", ".", ",", "<|endoftext|>", "<|",
             " ", "\u0085", " ", "\x1c", "\x00", "­", "¿", "ɏ", "ɐ", "中", "é", "İ", "_", "²", "\x0b"]
    draw = random.Random(7)
    texts = ["".join(draw.choices(units, k=draw.choice([0, 1, 2, 5, 12, 40]))) for _ in range(1500)]
    for name, keeps_space in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        path = public_tokenizers.path(name)
        library = Tokenizer.from_file(path)
        want = [[*library.encode(t, add_special_tokens=False).ids, 1] for t in texts]
        for step, learn in ((1 << 24, 1 << 20), (300, 40)):
            monkeypatch.setattr(tokens, "STEP_BYTES", step)
            monkeypatch.setattr(tokens, "LEARN_BYTES", learn)
            got = tokens.encode_column(path, keeps_space, 1, pa.table({"text": texts}), "text")
            assert [np.frombuffer(x, np.uint32).tolist() for x in got["ids"].to_pylist()] == want
            assert got["_n"].to_pylist() == [len(x) for x in want]
