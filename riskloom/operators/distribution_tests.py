"""EV-1 binned AUC, EV-5 exact KS p-values with both one-sided tails, EV-8 one-sample KS against a normal.

All three read counts per distinct score; the rows themselves are counted once. Results have full precision.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators import metrics, ranks

#: Rows of the larger class up to which p-values are exact (beyond it the limit laws).
EXACT_ROWS = 10_000
#: Terms of the normal CDF's series, and |z| beyond which it is 0 or 1 (the tail there is under 1e-15).
CDF_TERMS, CDF_FAR = 120, 8.0


def path_exit_probability(d: int, n1: int, n0: int, side: str) -> float:
    """P(a random order of n1 ones and n0 zeros leaves the band), d > 0 a multiple of 1 / (n1 n0).

    After i ones and j zeros the difference of the shares is (i n0 - j n1) / (n1 n0); ``side`` is "two" (its size reaches d),
    "greater" (it does) or "less" (its negative does). The walk's distribution goes on step by step, and what leaves the band is added up:
    sums of positive terms, exact to rounding however small the result. n1 + n0 steps over n1 + 1 numbers.
    """
    ones = np.arange(n1 + 1, dtype=np.int64)
    p, out, total = np.zeros(n1 + 1), 0.0, n1 + n0
    p[0] = 1.0
    for t in range(total):
        zeros = t - ones
        left = total - t
        up = p * (n1 - ones) / left
        stay = p * np.clip(n0 - zeros, 0, None) / left
        p = stay
        p[1:] += up[:-1]
        gap = ones * n0 - (t + 1 - ones) * n1
        gone = gap >= d if side == "greater" else -gap >= d if side == "less" else np.abs(gap) >= d
        out += float(p[gone].sum())
        p[gone] = 0.0
    return min(out, 1.0)


def ks_pvalue(d: int, n1: int, n0: int, side: str, exact_rows: int = EXACT_ROWS) -> float:
    """p-value of the statistic d / (n1 n0): exact while the larger class has ``exact_rows`` rows or fewer, else the limit law."""
    if not n1 or not n0:
        return float("nan")
    if d <= 0:
        return 1.0
    if max(n1, n0) <= exact_rows:
        return path_exit_probability(d, n1, n0, side)
    lam2 = (d / n1 / n0) ** 2 * (n1 / (n1 + n0)) * n0
    if side != "two":
        return math.exp(-2.0 * lam2)
    if lam2 < 1.0:  # the theta form converges fast here
        x = math.pi**2 / (8.0 * lam2)
        return 1.0 - math.sqrt(2.0 * math.pi / lam2) * sum(math.exp(-((2 * k - 1) ** 2) * x) for k in range(1, 20))
    return min(1.0, 2.0 * sum((-1.0) ** (k - 1) * math.exp(-2.0 * k * k * lam2) for k in range(1, 50)))


def ks_two_sample_by(df: DataFrame, by: Sequence[str], score: str, label: str, exact_rows: int = EXACT_ROWS) -> DataFrame:
    """EV-5 per group: (group, n_pos, n_neg, ks, ks_greater, ks_less, p_value, p_greater, p_less).

    ks_greater is the largest amount by which label 1's distribution function lies above label 0's, ks_less the other way round. Statistics are
    whole numbers over n_pos * n_neg until the end. With ties the exact law is, as usual, that of untied scores. One row per
    group reaches the p-value function. Empty groups and groups of one class have null statistics and p-values.
    """
    g = list(by)
    big = "decimal(38,0)"
    gap = F.col("cum_n1").cast(big) * F.col("t0").cast(big) - F.col("cum_n0").cast(big) * F.col("t1").cast(big)
    stats = metrics.cumulative_by(df, g, score, label).groupBy(*g).agg(
        F.greatest(F.max(gap), F.lit(0)).cast("long").alias("up"), F.greatest(F.max(-gap), F.lit(0)).cast("long").alias("down"),
        F.first("t1").alias("n_pos"), F.first("t0").alias("n_neg"))

    @F.pandas_udf("two double, greater double, less double")
    def values(up: pd.Series, down: pd.Series, n1: pd.Series, n0: pd.Series) -> pd.DataFrame:
        rows = [(ks_pvalue(max(u, d), a, b, "two", exact_rows), ks_pvalue(u, a, b, "greater", exact_rows), ks_pvalue(d, a, b, "less", exact_rows))
                for u, d, a, b in zip(*(map(int, c) for c in (up, down, n1, n0)))]
        return pd.DataFrame(rows, columns=["two", "greater", "less"], dtype="float64")

    out = stats.withColumn("p", values("up", "down", "n_pos", "n_neg"))
    whole = F.col("n_pos").cast("double") * F.col("n_neg")

    def share(x: Column) -> Column:
        return F.try_divide(x.cast("double"), whole)

    return out.select(*g, "n_pos", "n_neg", share(F.greatest("up", "down")).alias("ks"), share(F.col("up")).alias("ks_greater"), share(F.col("down")).alias("ks_less"),
                      *[F.nanvl(F.col(f"p.{c}"), F.lit(None).cast("double")).alias(n) for c, n in (("two", "p_value"), ("greater", "p_greater"), ("less", "p_less"))])


def normal_cdf(z: Column) -> Column:
    """The standard normal distribution function, to 1e-14.

    0.5 + density(z) * (z + z^3/3 + z^5/(3 5) + ...): for |z| <= CDF_FAR the terms fall by over a half from term 64 on, so what follows CDF_TERMS
    terms is below the last one, which is under 1e-20 of the sum; all terms have one sign, so rounding
    stays within some units of the last place. Beyond CDF_FAR the value is within 1e-15 of 0 or 1. Null stays null.
    """
    start = F.struct(z.alias("sum"), z.alias("term"))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(CDF_TERMS)), start,
        lambda acc, k: F.struct((acc["sum"] + acc["term"] * z * z / (2 * k + 1)).alias("sum"), (acc["term"] * z * z / (2 * k + 1)).alias("term")),
        lambda acc: acc["sum"])
    inside = F.lit(0.5) + F.exp(-z * z / 2) / F.lit(math.sqrt(2 * math.pi)) * series
    return F.when(z > CDF_FAR, F.lit(1.0)).when(z < -CDF_FAR, F.lit(0.0)).when(z.isNotNull(), inside)


def ks_normal(df: DataFrame, value: str) -> DataFrame:
    """EV-8: one-sample KS of ``value`` against N(0, 1): one row (statistic, p_value, n); p-value by the limit law. Null and NaN values do not count.

    The distribution function is taken once per distinct value, on running counts; both sides of each jump are compared.
    """
    v = F.col(value).cast("double")
    counts = df.where(v.isNotNull() & ~F.isnan(v)).groupBy(v.alias("v")).agg(F.count("*").alias("n"))
    cum = ranks.with_prefix_sums(counts, [F.col("v").asc()], ["n"])
    cdf = normal_cdf(F.col("v"))
    above = F.col("cum_n") / F.col("total_n") - cdf
    below = cdf - (F.col("cum_n") - F.col("n")) / F.col("total_n")
    out = cum.agg(F.max(F.greatest(above, below)).alias("statistic"), F.first("total_n").alias("n"))
    return out.select("statistic", F.when(F.col("n") > 0, metrics.kolmogorov_pvalue(F.col("statistic") * F.sqrt("n"))).alias("p_value"), F.coalesce("n", F.lit(0)).alias("n"))


def auc_binned(df: DataFrame, score: str, label: str, bins: int = 1000) -> DataFrame:
    """EV-1: area under the ROC curve whose points are thinned to about ``bins``: one row (auc, n_points).

    With 2 * ``bins`` distinct scores or more, floor(distinct / bins) neighbours in descending order are one point; otherwise every
    distinct score is. Groups are cut by global positions, so they do not depend on partitions. The area is a whole number over 2 P N.
    """
    placed = ranks.with_positions(metrics.score_counts(df, score, label), [F.col("score").desc()], "_pos", "_n")
    width = F.when(F.col("_n") >= 2 * bins, F.floor(F.col("_n") / bins)).otherwise(F.lit(1))
    points = placed.groupBy(F.floor(F.col("_pos") / width).alias("point")).agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    # fewer than 2 * bins points: a window on a table of fixed size
    whole = Window.orderBy("point").rowsBetween(Window.unboundedPreceding, 0)
    cum = points.withColumn("c1", F.sum("n1").over(whole))
    big = "decimal(38,0)"
    area = F.sum(F.col("n0").cast(big) * (2 * F.col("c1") - F.col("n1")).cast(big))
    return cum.agg(F.try_divide(area.cast("double"), F.lit(2.0) * F.sum("n1") * F.sum("n0")).alias("auc"), F.count("*").alias("n_points"))
