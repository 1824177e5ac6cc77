"""Leaf-wise boosting: an in-memory twin split by split, and the leaves counted again with SQL over the frozen rows."""

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from riskloom.operators import boosting as B

SCHEMA = "k int, features array<double>, y int"


def rows(n=1500, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)).round(2)
    x[:, 2] = rng.integers(0, 3, n)
    x[rng.random(n) < 0.1, 1] = np.nan
    y = (x[:, 0] + (x[:, 2] == 1) * np.nan_to_num(x[:, 1]) + rng.normal(size=n) * 0.5 > 0).astype(int)
    return x, y


def twin(x, y, cuts, p):
    """One split at a time, over all rows in one place."""
    b, score, out = B.binned(x, cuts), np.full(len(y), np.log(y.sum() / (len(y) - y.sum()))), []
    rng = np.random.default_rng(p.seed)
    for _ in range(p.rounds):
        columns = np.sort(rng.permutation(x.shape[1])[: max(1, int(round(p.column_share * x.shape[1])))])
        g, h = B.gradients(score, y)
        leaf = np.zeros(len(y), int)

        def best(k):
            top = (1e-9, None)
            at = leaf == k
            lam = p.reg_lambda * B.POINT
            for f in columns:
                for cut in range(int(b[:, f].max())):
                    left, right = at & (b[:, f] <= cut), at & (b[:, f] > cut)
                    if min(left.sum(), right.sum()) < p.min_rows or min(h[left].sum(), h[right].sum()) < p.min_hessian * B.POINT:
                        continue
                    gain = (g[left].sum() ** 2 / (h[left].sum() + lam) + g[right].sum() ** 2 / (h[right].sum() + lam) - g[at].sum() ** 2 / (h[at].sum() + lam)) / B.POINT
                    if gain > top[0] * (1 + 1e-12):
                        top = (gain, (f, cut))
            return top

        known = {0: best(0)}
        while len(known) < p.leaves:
            k = max(known, key=lambda i: known[i][0])
            if known[k][1] is None:
                break
            f, cut = known[k][1]
            new = len(known)
            leaf[(leaf == k) & (b[:, f] > cut)] = new
            known[k], known[new] = best(k), best(new)
        values = [-p.learning_rate * g[leaf == k].sum() / (h[leaf == k].sum() + p.reg_lambda * B.POINT) for k in known]
        score = score + np.array(values)[leaf]
        out.append(sorted(zip([int((leaf == k).sum()) for k in known], np.round(values, 12))))
    return out, 1 / (1 + np.exp(-score))


def frame(spark, x, y, parts):
    data = [(i, [None if np.isnan(v) else float(v) for v in r], int(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, SCHEMA).repartition(parts, "k")


@pytest.mark.parametrize("leaves, share", [(5, 1.0), (9, 0.75)])
def test_trees_equal_one_split_at_a_time(spark, leaves, share):
    x, y = rows()
    p = B.LeafwiseParams(rounds=4, leaves=leaves, max_bins=16, column_share=share)
    model = B.fit_leafwise(frame(spark, x, y, 3), "y", params=p)
    want, prob = twin(x, y, model.cuts, p)
    assert [sorted(zip(t.rows, np.round(t.values, 12))) for t in model.trees] == want
    scored = frame(spark, x, y, 5).withColumn("features", B.F.transform("features", lambda v: B.F.coalesce(v, B.F.lit(float("nan")))))
    got = {r.k: r.p for r in model.score(scored).collect()}
    assert np.allclose([got[i] for i in range(len(y))], prob, atol=1e-12)


def test_fit_does_not_depend_on_partitions_or_kept_scores(spark, monkeypatch):
    x, y = rows(900, 2)
    p = B.LeafwiseParams(rounds=30, leaves=7, max_bins=31)
    a, b = (B.fit_leafwise(frame(spark, x, y, n), "y", params=p) for n in (1, 6))
    assert [t.rows for t in a.trees] == [t.rows for t in b.trees] and [t.gradients for t in a.trees] == [t.gradients for t in b.trees]


def test_leaf_sums_equal_sql_over_frozen_rows(spark, tmp_path):
    x, y = rows()
    p = B.LeafwiseParams(rounds=3, leaves=8, max_bins=32)
    df = frame(spark, x, y, 4)
    model = B.fit_leafwise(df, "y", params=p)
    b, score, frozen = B.binned(x, model.cuts), np.full(len(y), model.start), []
    for t, tree in enumerate(model.trees):
        leaf, (g, h) = tree.assign(b), B.gradients(score, y)
        frozen += [(t, int(k), int(u), int(v)) for k, u, v in zip(leaf, g, h)]
        score = score + np.array(tree.values)[leaf]
    path = str(tmp_path / "frozen")
    spark.createDataFrame(frozen, "tree int, leaf int, g long, h long").write.parquet(path)
    want = duckdb.sql(f"SELECT tree, leaf, count(*), sum(g)::BIGINT, sum(h)::BIGINT FROM '{path}/*.parquet' GROUP BY ALL ORDER BY ALL").fetchall()
    fitted = [(r.tree, r.leaf, r.n, r.gradient, r.hessian) for r in model.leaf_table(spark).orderBy("tree", "leaf").collect()]
    again = [tuple(r) for r in model.leaf_sums(df, "features", "y").select("tree", "leaf", "n", "gradient", "hessian").orderBy("tree", "leaf").collect()]
    assert fitted == want == again


def test_degenerate_inputs(spark):
    for data in ([], [(1, [1.0], 1), (2, [2.0], 1)], [(1, [1.0], None)]):
        model = B.fit_leafwise(spark.createDataFrame(data, SCHEMA), "y")
        assert model.trees == []
    one = B.fit_leafwise(spark.createDataFrame([(i, [1.0], i % 2) for i in range(50)], SCHEMA), "y", params=B.LeafwiseParams(column_share=1.0))
    assert [t.values for t in one.trees] == [[0.0]]


def test_blocks_are_full_and_one_hot_columns_add_up_their_rare_rows_only(monkeypatch):
    monkeypatch.setattr(B, "BLOCK_ROWS", 64)
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(size=150), np.eye(10)[rng.integers(0, 10, 150)]])
    y = rng.integers(0, 2, 150)
    cuts = [np.linspace(-1, 1, 5), *[np.array([0.0])] * 10]
    batches = [pa.RecordBatch.from_arrays([pa.array(x[i : i + 20].tolist()), pa.array(y[i : i + 20])], names=["x", "y"]) for i in range(0, 150, 20)]
    blocks = [r for b in B._blocks(cuts, iter(batches)) for r in b.to_pylist()]
    assert [r["n"] for r in blocks] == [64, 64, 22]
    offsets = np.cumsum([0, *[len(c) + 2 for c in cuts]])
    bins = np.concatenate([np.frombuffer(r["x"], np.uint8).reshape(r["n"], -1) for r in blocks])
    assert (bins == B.binned(x, cuts)).all()
    block = B._Block(bins, y.astype(np.uint8), 0.3, offsets)
    block.catch_up([])
    block.expand([(0, 0, 3, 1)])
    assert block.at.shape[1] < 4
    for k, hist in zip([2, 1], block.histograms([2, 1], int(offsets[-1]))):
        rows = block.node == k
        for f in range(x.shape[1]):
            for b in range(len(cuts[f]) + 2):
                at = rows & (bins[:, f] == b)
                assert hist[offsets[f] + b].tolist() == [block.g[at].sum(), block.h[at].sum(), at.sum()]
