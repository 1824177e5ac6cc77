"""Degenerate inputs: empty tables, one class, one row, fewer rows than tiles (ANSI mode on)."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskloom.operators import drift, metrics, ranks, weights

SCHEMA = "id long, score double, y int"


def test_empty_input(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert metrics.auc_exact(df, "score", "y").first().auc is None
    assert metrics.decile_table(df, "score", "y", "id").count() == 0
    assert ranks.exact_quantiles(df, "score", [0.5]) == [None]


def test_single_class_gives_null_not_error(spark):
    df = spark.createDataFrame([(i, float(i), 1) for i in range(20)], SCHEMA)
    r = metrics.auc_ks_exact(df, "score", "y").first()
    assert r.auc is None and r.n_neg == 0
    w = {x.y: x for x in weights.class_table(df, "y").collect()}
    assert w[1].w_neg_pos == 0.0 and w[1].w_balanced == 1.0  # n0 / n1 with no negatives


def test_fewer_rows_than_tiles_and_one_row(spark):
    df = spark.createDataFrame([(i, float(i), i % 2) for i in range(4)], SCHEMA)
    order = [F.col("score").desc(), F.col("id").asc()]
    a = sorted(ranks.with_ntile(df, order, 10).select("id", "tile").collect())
    b = sorted(df.withColumn("tile", F.ntile(10).over(Window.orderBy(*order))).select("id", "tile").collect())
    assert a == b
    one = spark.createDataFrame([(1, 0.5, 1)], SCHEMA)
    assert ranks.exact_quantiles(one, "score", [0, 0.5, 1]) == [0.5, 0.5, 0.5]
    assert metrics.ks_qcut(one, "score", "y", 20).first().ks_qcut == pytest.approx(1.0, abs=1e-6)


def test_psi_with_nulls_and_nan_ignored(spark):
    rows = [(i, float(i % 10), 0) for i in range(100)] + [(100, None, 0), (101, float("nan"), 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    r = drift.psi(df, df, "score").first()
    assert r.psi == pytest.approx(0.0, abs=1e-12) and r.n_expected == 100
