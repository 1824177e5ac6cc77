"""Trees grown level by level: those of spark.ml without drawn rows and columns, and the draws themselves."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array

from riskloom.operators import forests as R
from riskloom.plans import modeling

SCHEMA = "k long, features array<double>, y int"


@pytest.fixture(scope="module")
def df(spark):
    rng = np.random.default_rng(5)
    n = 1500
    x = np.column_stack([rng.integers(0, 20, n) / 7, rng.integers(0, 30, n) / 3, np.eye(4)[rng.integers(0, 4, n)], rng.integers(0, 5, n)])
    y = (x[:, 0] + x[:, 2] * x[:, 1] + rng.normal(size=n) * 3 > 3).astype(int)
    return spark.createDataFrame([(i, r.tolist(), int(t)) for i, (r, t) in enumerate(zip(x, y))], SCHEMA).repartition(3, "k").cache()


def fitted(df, params):
    rows = R.bin_rows(df, "y", "k")
    try:
        return R.fit_trees(rows, params)
    finally:
        rows.release()


@pytest.mark.parametrize("estimator, params", [
    (lambda: GBTClassifier(labelCol="y", maxIter=8, maxDepth=4), R.TreeParams(8, 4, False, row_share=1.0, column_share=1.0)),
    (lambda: RandomForestClassifier(labelCol="y", numTrees=1, maxDepth=5, bootstrap=False, featureSubsetStrategy="all"),
     R.TreeParams(1, 5, True, row_share=1.0, column_share=1.0, bootstrap=False))], ids=["boosted", "forest"])
def test_probabilities_equal_spark_ml(df, estimator, params):
    v = df.withColumn("features", array_to_vector("features"))
    want = {r.k: r.p for r in estimator().fit(v).transform(v).select("k", vector_to_array("probability")[1].alias("p")).collect()}
    got = {r.k: r.p for r in fitted(df, params).transform(df).select("k", "p").collect()}
    assert len(set(want.values())) > 5 and np.allclose([got[k] for k in want], list(want.values()), atol=1e-7)


@pytest.mark.parametrize("params", [R.TreeParams(30, 3, False), R.TreeParams(60, 4, True)], ids=["boosted", "forest"])
def test_a_fit_does_not_depend_on_partitions(df, params):
    a, b = (fitted(df.repartition(n), params) for n in (1, 7))
    assert all((s.feature == t.feature).all() and (s.bin == t.bin).all() and (s.value == t.value).all() for s, t in zip(a.trees, b.trees, strict=True))


def test_draws_have_the_shares_asked_for():
    key = np.arange(200_000, dtype=np.uint64)
    p = R.TreeParams(1, 1, True)
    rows, times = R.drawn_rows(key, 3, p)
    assert abs(times.sum() / len(key) - 0.9) < 0.01 and abs(len(rows) / len(key) - (1 - np.exp(-0.9))) < 0.005
    assert abs((times == 2).sum() / len(key) - 0.81 / 2 * np.exp(-0.9)) < 0.005
    rows, times = R.drawn_rows(key, 3, R.TreeParams(1, 1, False))
    assert times is None and abs(len(rows) / len(key) - 0.9) < 0.005
    assert len(np.intersect1d(rows, R.drawn_rows(key, 4, R.TreeParams(1, 1, False))[0])) < 0.82 * len(key)


def test_a_forest_is_grown_in_a_job_a_level_and_group_of_trees(spark, df):
    """Trees visit the rows together: 500 trees of depth 5 are 50 jobs. Boosting visits them once a level and round."""
    estimators = modeling.bureau_estimators(100)
    boosted, forest = estimators["gradient_boosted_trees"], estimators["random_forest"]
    assert (boosted.trees, boosted.depth, forest.trees, forest.depth) == (300, 4, 500, 5)
    rows, sc = R.bin_rows(df, "y", "k"), spark.sparkContext
    try:
        sc.setJobGroup("forest-visits", "")
        model = R.fit_trees(rows, R.TreeParams(2 * R.GROUP, 3, True))
        jobs = len(sc.statusTracker().getJobIdsForGroup("forest-visits"))
    finally:
        sc.setJobGroup("", "")
        rows.release()
    assert len(model.trees) == 2 * R.GROUP and jobs <= 2 * 3


def test_degenerate_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    model = fitted(none, R.TreeParams(3, 2, True))
    assert model.transform(spark.createDataFrame([], SCHEMA)).count() == 0
    same = spark.createDataFrame([(i, [1.0, float(i % 2)], 1) for i in range(40)], SCHEMA)
    assert {r.p for r in fitted(same, R.TreeParams(4, 2, True)).transform(same).collect()} == {1.0}
    assert min(r.p for r in fitted(same, R.TreeParams(4, 2, False)).transform(same).collect()) > 0.8
