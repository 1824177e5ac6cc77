"""Metamorphic and cross-path properties of the metrics."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskloom.operators import drift, features, governance, metrics, ranks, weights

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(7)
    n = 3000
    y = rng.integers(0, 2, n)
    # many ties: scores on a coarse grid, plus a hot value shared by a third of the rows
    s = np.round(rng.normal(0.3 * y, 1.0, n), 1)
    s[: n // 3] = 0.5
    rows = [(int(i), float(a), int(b)) for i, (a, b) in enumerate(zip(s, y))]
    return spark.createDataFrame(rows, "id long, score double, y int")


def brute_auc(df):
    pdf = df.toPandas()
    pos, neg = pdf[pdf.y == 1].score.values, pdf[pdf.y == 0].score.values
    gt = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return gt / (len(pos) * len(neg))


def brute_ks(df):
    pdf = df.toPandas()
    pos, neg = np.sort(pdf[pdf.y == 1].score.values), np.sort(pdf[pdf.y == 0].score.values)
    grid = np.unique(pdf.score.values)
    f1 = np.searchsorted(pos, grid, side="right") / len(pos)
    f0 = np.searchsorted(neg, grid, side="right") / len(neg)
    return np.max(np.abs(f1 - f0))


def test_auc_and_ks_equal_brute_force(scored):
    assert metrics.auc_exact(scored, "score", "y").first().auc == pytest.approx(brute_auc(scored), abs=1e-9)
    assert metrics.ks_exact(scored, "score", "y").first().ks == pytest.approx(brute_ks(scored), abs=1e-9)


def test_monotone_remap_keeps_auc_ks(scored):
    remapped = scored.withColumn("score", F.exp(F.col("score") * 3) + 7)
    for fn, col in [(metrics.auc_exact, "auc"), (metrics.ks_exact, "ks")]:
        assert fn(scored, "score", "y").first()[col] == pytest.approx(fn(remapped, "score", "y").first()[col], abs=1e-9)


@pytest.mark.parametrize("parts", [1, 3, 8, 17])
def test_distributed_ntile_equals_window(scored, parts):
    order = [F.col("score").desc(), F.col("id").asc()]
    a = ranks.with_ntile(scored, order, 10, num_partitions=parts)
    b = scored.withColumn("tile", F.ntile(10).over(Window.orderBy(*order)))
    assert sorted(a.select("id", "tile").collect()) == sorted(b.select("id", "tile").collect())


def test_positions_are_a_permutation(scored):
    pos = ranks.with_positions(scored, [F.col("score").asc(), F.col("id").asc()], num_partitions=5)
    got = sorted(r.pos for r in pos.select("pos").collect())
    assert got == list(range(scored.count()))


def test_exact_quantiles_equal_numpy(scored):
    probs = [0, 0.1, 0.33, 0.5, 0.9, 1]
    vals = scored.toPandas().score.values
    assert ranks.exact_quantiles(scored, "score", probs, 4) == pytest.approx(list(np.quantile(vals, probs)), abs=1e-12)
    g = ranks.grouped_quantiles(scored, ["y"], "score", probs).collect()
    pdf = scored.toPandas()
    for r in g:
        assert r.cuts == pytest.approx(list(np.quantile(pdf[pdf.y == r.y].score.values, probs)), abs=1e-12)


def test_psi_of_known_bin_counts(spark):
    # expected: 1..100, ten per decile bin; actual: 28 values in the first bin, 8 in each of the nine others
    expected = spark.createDataFrame([(float(i),) for i in range(1, 101)], "score double")
    values = [5.0] * 28 + [10.0 * k + 5.5 for k in range(1, 10) for _ in range(8)]
    actual = spark.createDataFrame([(v,) for v in values], "score double")
    row = drift.psi(expected, actual, "score").first()
    # (0.28 - 0.1) ln 2.8 + 9 (0.08 - 0.1) ln 0.8, worked out by hand: 0.1853315 + 0.0401658
    assert row.psi == pytest.approx(0.2254973, abs=1e-6)
    assert (row.n_expected, row.n_actual) == (100, 100)


def test_psi_is_zero_on_itself(scored):
    e = scored.where("y = 0")
    assert drift.psi(e, e, "score").first().psi == pytest.approx(0.0, abs=1e-12)


def test_weights_of_training_rows_only(spark):
    rows = [(0, "train")] * 6 + [(1, "train")] * 2 + [(1, "valid")] * 20
    df = spark.createDataFrame(rows, "y int, split string")
    w = weights.with_class_weight(df, "y", "balanced", "w", fit_on=df.where("split = 'train'"))
    assert {r.y: r.w for r in w.distinct().collect()} == {0: pytest.approx(8 / 12), 1: pytest.approx(2.0)}


def test_ks_bounds_and_balanced_weights(scored):
    ks = metrics.ks_exact(scored, "score", "y").first()
    assert 0 <= ks.ks <= 1 and 0 <= ks.p_value <= 1
    w = weights.with_class_weight(scored, "y", "majority", "w")
    sums = {r.y: r.s for r in w.groupBy("y").agg(F.sum("w").alias("s")).collect()}
    assert sums[0] == pytest.approx(sums[1])
    bal = weights.with_class_weight(scored, "y", "balanced", "w").agg(F.sum("w")).first()[0]
    assert bal == pytest.approx(scored.count())


def test_partition_count_does_not_change_results(spark):
    from riskloom.plans.registry import all_queries

    q = all_queries()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        out = []
        for parts in ("3", "11"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            out.append((sorted(q["ev4_ks_decile"](spark, SF_SMALL).collect()),
                        q["ev3_auc_exact"](spark, SF_SMALL).collect()))
        assert out[0] == out[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_hot_value_is_one_counted_row(spark):
    # one value holds a third of the rows: it is one row of the table that is sorted
    n = 6000
    rows = [(float(5.0 if i < n // 3 else i),) for i in range(n)]
    df = spark.createDataFrame(rows, "v double").repartition(6)
    frozen = ranks.freeze_counts(df, [], "v", {"n": F.count(F.lit(1))}, 6)
    sizes = [r["count"] for r in frozen.groupBy("_pid").count().collect()]
    assert max(sizes) < n / 4 and frozen.where("v = 5").first().n == n // 3
    assert ranks.exact_quantiles(df, "v", [0.1, 0.5]) == pytest.approx(list(np.quantile([r[0] for r in rows], [0.1, 0.5])))


def test_grouped_auc_equals_per_group(scored):
    stacked = scored.withColumn("g", F.when(F.col("id") % 3 == 0, "a").otherwise("b"))
    by = {r.g: r.auc for r in metrics.auc_exact_by(stacked, ["g"], "score", "y").collect()}
    for g in ("a", "b"):
        one = metrics.auc_exact(stacked.where(F.col("g") == g), "score", "y").first().auc
        assert by[g] == pytest.approx(one, abs=1e-12)


def test_grouped_ks_equals_per_group(scored):
    stacked = scored.withColumn("g", F.when(F.col("id") % 3 == 0, "a").otherwise("b"))
    by = {r.g: (r.ks, r.p_value) for r in metrics.ks_exact_by(stacked, ["g"], "score", "y").collect()}
    for g in ("a", "b"):
        one = metrics.ks_exact(stacked.where(F.col("g") == g), "score", "y").first()
        assert by[g] == pytest.approx((one.ks, one.p_value), abs=1e-12)


def test_combined_auc_ks_pass(scored):
    both = metrics.auc_ks_exact(scored, "score", "y").first()
    assert both.auc == metrics.auc_exact(scored, "score", "y").first().auc
    assert (both.ks, both.p_value) == tuple(metrics.ks_exact(scored, "score", "y").first()[:2])


def test_approx_psi_close_to_exact(scored):
    e, a = scored.where("y = 0"), scored.where("y = 1").withColumn("score", F.col("score") + 0.3)
    exact = drift.psi(e, a, "score").first().psi
    approx = drift.psi(e, a, "score", method="approx").first().psi
    assert approx == pytest.approx(exact, rel=0.05, abs=1e-3)


def test_approx_qcut_close_to_exact(scored):
    exact = metrics.ks_qcut(scored, "score", "y", 20).first().ks_qcut
    approx = metrics.ks_qcut(scored, "score", "y", 20, method="approx").first().ks_qcut
    assert approx == pytest.approx(exact, abs=0.01)


@pytest.mark.parametrize("parts", [1, 5, 16])
def test_quantiles_do_not_depend_on_the_ranges(scored, parts):
    probs = [0, 0.05, 0.25, 0.5, 0.77, 1]
    pdf = scored.toPandas()
    for r in ranks.grouped_quantiles(scored, ["y"], "score", probs, num_partitions=parts).collect():
        assert r.cuts == pytest.approx(list(np.quantile(pdf[pdf.y == r.y].score.values, probs)), abs=1e-12)


def test_encoders_take_many_levels_and_new_ones(spark):
    n = 50_000
    fit = spark.range(n).select(F.format_string("v%06d", F.col("id")).alias("c"), F.lit("a").alias("d"))
    rows = fit.unionByName(spark.createDataFrame([("new", "b"), (None, None)], "c string, d string"))
    enc = features.CategoryEncoder(["c", "d"]).fit(fit)
    got = {r.c: (r.c_idx, r.d_idx) for r in enc.transform_index(rows).collect()}
    assert len(got) == n + 2 and all(got[f"v{i:06d}"] == (i, 0) for i in range(n))
    assert got["new"] == got[None] == (n, 1)
    idx = features.FrequencyIndexer("c").fit(fit.unionByName(fit.where("c = 'v000500'"))).transform(rows)
    index = {r.c: r.c_index for r in idx.collect()}
    assert (index["v000500"], index["v000000"], index["v000501"], index["new"], index[None]) == (0, 1, 501, n, n)


def test_encoder_vectors(spark):
    fit = spark.range(300).select(F.format_string("v%06d", F.col("id")).alias("c"), F.lit("a").alias("d"))
    rows = fit.unionByName(spark.createDataFrame([("new", "b"), (None, None)], "c string, d string"))
    got = {r.c: r for r in features.CategoryEncoder(["c", "d"]).fit(fit).transform_vector(rows).collect()}
    assert got["v000077"].c_vec.indices.tolist() == [77] and got["v000077"].d_vec.toArray().tolist() == [1.0]
    for new in ("new", None):
        assert got[new].c_vec.size == 300 and got[new].c_vec.numNonzeros() == got[new].d_vec.numNonzeros() == 0


def test_response_document_of_repeated_applicants(spark):
    rows = [("r", "m", "a", 0.2, ["X"]), ("r", "m", "a", 0.9, ["Y"]), ("r", "m", "a", 0.9, ["Y"]), ("r", "m", "b", 0.1, []), ("r", "m", None, 0.5, [])]
    df = spark.createDataFrame(rows, "request_id string, model_version string, customer_id string, score double, reason_codes array<string>")
    doc = governance.decision_document(df, "request_id", "customer_id").first()
    assert doc.scores == {"a": 0.9, "b": 0.1} and doc.reason_codes == {"a": ["Y"], "b": []}
