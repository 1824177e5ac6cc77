"""URL filter against a per-row reading of the contract and a tree built in Python."""

import math
import re
from collections import defaultdict

import pytest

from riskloom.llm import url_filter as U

SCHEMA = "page_id long, url string, html string, host string, path string, rule string, shape string, node string, bad boolean, n long"
ROW = ("h", "x", "p", "r", "s", "n", None, 1)


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
    return re.sub("[A-Z]+", lambda m: m[0].lower(), host), path


def ruled(host, path, rules):
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: (len(r.name), len(r.host)), default=None)


def brute(rows, rules, labels=None, tree=U.Tree()):
    """The tree as nested Python groups: a second reading of the method, row by row."""
    items = []
    for page_id, url in rows:
        host, path = parts(url)
        r = ruled(host, path, rules)
        bad = (labels or {}).get(page_id, None)
        bad = (r.block if r else None) if bad is None else bad
        shape = [re.sub("[0-9]+", "#", s) for s in path.split("/") if s]
        shape = shape[: tree.depth] + ["**"] if len(shape) > tree.depth else shape
        items.append((page_id, host, path, r, bad, shape))
    marks = [x[4] for x in items if x[4] is not None]
    base_all = sum(marks) / len(marks) if marks else 0.0
    template = {}

    def grow(host, node, members, k):
        ended = [m for m in members if len(m[1][5]) <= k]
        for i, _ in ended:
            template[i] = node
        rest = [m for m in members if len(m[1][5]) > k]
        by = defaultdict(list)
        for m in rest:
            by[m[1][5][k]].append(m)
        lab = [m[1][4] for m in rest if m[1][4] is not None]
        base = sum(lab) / len(lab) if lab else 0.0
        rare = [s for s, ms in by.items() if len(ms) < tree.own_pages and s != "**"]
        branches, cells = defaultdict(list), defaultdict(list)
        for s, ms in by.items():
            marks = [m[1][4] for m in ms if m[1][4] is not None]
            if s in rare and len(rare) >= tree.wild_values:
                branches["*"] += ms
            elif len(marks) >= tree.merge_labels and s != "**":
                share = (sum(marks) + tree.prior * base) / (len(marks) + tree.prior)
                cells[min(math.floor(share * tree.cells), tree.cells - 1)].append((s, ms, sum(marks), len(marks)))
            else:
                branches[s] += ms
        group, last = [], None

        def close():
            if group:
                names = sorted(s for s, _, _, _ in group)
                name = names[0] if len(names) == 1 else f"({names[0]}|+{len(names) - 1})"
                for _, ms, _, _ in group:
                    branches[name] += ms

        for c in sorted(cells):
            b, t = sum(x[2] for x in cells[c]), sum(x[3] for x in cells[c])
            if last is not None:
                p = (b + last[0]) / (t + last[1])
                if abs(b / t - last[0] / last[1]) > tree.alike * math.sqrt(p * (1 - p) * (1 / t + 1 / last[1])):
                    close()
                    group = []
            group += cells[c]
            last = (b, t)
        close()
        for name, ms in branches.items():
            grow(host, f"{node}/{name}", ms, k + 1)

    hosts = defaultdict(list)
    for i, x in enumerate(items):
        hosts[x[1]].append((i, x))
    for host, ms in hosts.items():
        grow(host, "", ms, 0)
    sums = defaultdict(lambda: [0, 0])
    for i, x in enumerate(items):
        if x[4] is not None:
            sums[x[1], template[i]][0] += x[4]
            sums[x[1], template[i]][1] += 1
    out = []
    for i, (page_id, host, path, r, _, _) in enumerate(items):
        b, t = sums[host, template[i]]
        reject = t >= tree.reject_labels and (b + tree.prior * base_all) / (t + tree.prior) >= tree.reject_share
        block = r.block if r else reject
        out.append((page_id, host, path, r.name if r else None, "block" if block else "allow", template[i]))
    return sorted(out, key=str)


def ours(df, rules, labels=None, tree=U.Tree()):
    got = U.judge_urls(df, rules, labels, tree=tree)
    return sorted([(r.page_id, r.host, r.path, r.rule, r.verdict, r.template) for r in got.collect()], key=str)


def edge_rows():
    urls = [None, "", "no scheme/path", "://", "http://", "HTTP://WWW.Example.COM", "http://com/", "http://acom/x", "http://x.com?q=/en/", "http://x.com#/en/",
            "http://a.example.com/en/1", "http://www.example.com/en/1", "http://sub.www.example.com/en/", "http://example.com/EN/", "http://b.net/es/x?y=1", "http://b.net/es",
            "http://ÀB.net/fr/\n/z", "http://u@h.net:80//fr/", "x://y://z/w", "http://deep.org/" + "/".join(f"s{i}" for i in range(400)), "http://long.org/" + "q" * 50_000]
    return [(i if i % 7 else None, u) for i, u in enumerate(urls)] + [(3, urls[3])] * 2


def site_rows():
    """A shop whose spam lives under two sections with many slugs, and clean ones beside them."""
    rows, labels = [], {}
    for i in range(1500):
        kind = i % 5
        word = "".join(chr(97 + (i * 7 + j * j * (i + 3)) % 26) for j in range(8))
        path = ["/spam/deal-{0}/{1}", "/promo/{1}", "/news/{0}/{1}.html", "/about", "/docs/v2/{1}/x"][kind].format(i, word)
        host = "Shop.org" if i % 3 else "other.org"
        rows.append((i, f"https://{host}{path}?a={i}"))
        if i % 2:
            labels[i] = kind in (0, 1) and i % 225 != 1
    return rows, labels


def test_edges_equal_brute_force(spark):
    rows = edge_rows()
    df = spark.createDataFrame([(*r, *ROW) for r in rows], SCHEMA).repartition(3)
    assert ours(df, U.RULES) == brute(rows, U.RULES)


@pytest.mark.parametrize("tree", [U.Tree(), U.Tree(depth=2, own_pages=40, wild_values=3, merge_labels=3, reject_labels=5, reject_share=0.8)])
def test_tree_equals_brute_force_and_finds_the_spam(spark, tree):
    rows, labels = site_rows()
    df = spark.createDataFrame([(*r, *ROW) for r in rows], SCHEMA).repartition(3)
    marks = spark.createDataFrame([(i, b) for i, b in labels.items()] + [(None, True), (1, None)], "page_id long, bad boolean")
    got = ours(df, U.RULES, marks, tree)
    assert got == brute(rows, U.RULES, labels, tree)
    blocked = {r[0] for r in got if r[4] == "block"}
    assert blocked == {i for i in range(1500) if i % 5 in (0, 1)}  # unlabelled and mislabelled rows of the sections too
    assert any("(promo|+1)" in r[5] for r in got) and any(r[5].endswith("/*") for r in got)


def test_query_equals_brute_force(spark):
    for sf in ("0.001", "0.01"):
        pages = spark.read.parquet(f"/root/testdata/sf{sf}/pages.parquet").select("page_id", "url").collect()
        got = sorted([tuple(r) for r in U.op11_url_filter(spark, f"/root/testdata/sf{sf}").collect()], key=str)
        assert got == [r[:5] for r in brute([tuple(p) for p in pages], U.RULES)]


def test_empty_table(spark):
    assert ours(spark.createDataFrame([], SCHEMA), U.RULES) == []


def test_hot_host_joins_alike(spark, monkeypatch):
    from riskloom.llm import skew

    rows, labels = site_rows()
    df = spark.createDataFrame([(*r, *ROW) for r in rows], SCHEMA)
    monkeypatch.setattr(skew, "SPREAD", 3)
    assert ours(df, U.RULES) == brute(rows, U.RULES)
