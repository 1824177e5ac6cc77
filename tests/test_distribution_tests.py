"""Exact KS p-values against full enumeration, the normal CDF, and the thinned AUC against spark.ml."""

import math
from itertools import combinations

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.stat import KolmogorovSmirnovTest
from pyspark.sql import functions as F

from riskloom.operators import distribution_tests as T


@pytest.mark.parametrize("n1, n0", [(1, 1), (3, 5), (6, 4), (7, 7), (2, 9)])
def test_exact_pvalues_equal_full_enumeration(n1, n0):
    seen = {"two": [], "greater": [], "less": []}
    for ones in combinations(range(n1 + n0), n1):
        i = j = up = down = 0
        for t in range(n1 + n0):
            i, j = (i + 1, j) if t in ones else (i, j + 1)
            up, down = max(up, i * n0 - j * n1), max(down, j * n1 - i * n0)
        seen["two"].append(max(up, down))
        seen["greater"].append(up)
        seen["less"].append(down)
    for side, values in seen.items():
        for d in sorted(set(values)):
            want = sum(v >= d for v in values) / len(values) if d > 0 else 1.0
            assert T.ks_pvalue(d, n1, n0, side) == pytest.approx(want, rel=1e-12)


def test_exact_and_limit_law_meet():
    n1, n0 = 1500, 1700
    for share in (0.02, 0.05, 0.08):
        d = int(share * n1 * n0)
        for side in ("two", "greater", "less"):
            assert T.ks_pvalue(d, n1, n0, side) == pytest.approx(T.ks_pvalue(d, n1, n0, side, exact_rows=10), rel=0.15, abs=1e-3)
    assert T.ks_pvalue(30 * 30, 30, 30, "two") == pytest.approx(2 / math.comb(60, 30), rel=1e-12)


def test_two_sample_by_group(spark):
    rng = np.random.default_rng(4)
    rows = [("a" if k % 2 else "b", float(rng.integers(0, 40)), int(k % 3 == 0)) for k in range(400)] + [("c", 1.0, 1), ("c", None, 0), ("d", None, None)]
    out = {r.g: r for r in T.ks_two_sample_by(spark.createDataFrame(rows, "g string, s double, y int"), ["g"], "s", "y").collect()}
    for g in "ab":
        x, y = (np.sort([s for h, s, t in rows if h == g and t == c]) for c in (1, 0))
        at = np.unique(np.concatenate([x, y]))
        diff = np.searchsorted(x, at, "right") / len(x) - np.searchsorted(y, at, "right") / len(y)
        assert out[g].ks_greater == pytest.approx(max(diff.max(), 0)) and out[g].ks_less == pytest.approx(max(-diff.min(), 0))
        d = round(out[g].ks * len(x) * len(y))
        assert out[g].p_value == pytest.approx(T.path_exit_probability(d, len(x), len(y), "two"))
    assert out["c"].ks is None and out["c"].p_value is None and "d" not in out


def test_normal_cdf_and_one_sample_statistic(spark):
    zs = [*np.linspace(-9, 9, 181).tolist(), 0.0, None]
    df = spark.createDataFrame([(z,) for z in zs], "z double")
    for z, p in df.select("z", T.normal_cdf(F.col("z"))).collect():
        assert p is None if z is None else p == pytest.approx(0.5 * math.erfc(-z / math.sqrt(2)), abs=1e-14)
    sample = spark.createDataFrame([(float(z),) for z in np.random.default_rng(1).normal(0.1, 1.1, 700).round(1)], "z double")
    ml, own = KolmogorovSmirnovTest.test(sample, "z", "norm", 0.0, 1.0).first(), T.ks_normal(sample, "z").first()
    assert own.statistic == pytest.approx(ml.statistic, abs=1e-12) and own.n == 700
    assert T.ks_normal(sample.where("z > 99"), "z").first().n == 0


@pytest.mark.parametrize("bins", [7, 100, 5000])
def test_thinned_auc_equals_the_evaluator(spark, bins):
    rng = np.random.default_rng(6)
    rows = [(float(s), float(rng.random() < 1 / (1 + math.exp(-s)))) for s in rng.normal(size=3000).round(2)]
    df = spark.createDataFrame(rows, "s double, y double")
    want = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", numBins=bins).evaluate(df.coalesce(1))
    got = T.auc_binned(df.repartition(5), "s", "y", bins).first()
    assert got.auc == pytest.approx(want, abs=2e-3 if bins == 7 else 1e-4 if bins == 100 else 1e-12)
    assert got.n_points < 2 * bins + 1
