"""Ranking metrics on a scored table: exact AUC, three kinds of KS, calibration.

Every metric first collapses the rows to one row per distinct score (partial
aggregation, so a score shared by a third of all rows costs one map-side counter),
then needs running sums over the score order; those come from ``ranks`` (range
partitions + checkpoint + a tiny broadcast offsets table), never from a one-task
window over all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators import ranks

DIGITS = 9


def score_counts(df: DataFrame, score: str, label: str) -> DataFrame:
    """(score, n1, n0): positives and negatives per distinct score; NULL scores/labels dropped."""
    return (
        df.where(F.col(score).isNotNull() & F.col(label).isNotNull() & ~F.isnan(F.col(score)))
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(
            F.count_if(F.col(label) == 1).cast("long").alias("n1"),
            F.count_if(F.col(label) != 1).cast("long").alias("n0"),
        )
    )


def _cumulative(df: DataFrame, score: str, label: str, num_partitions: int | None) -> DataFrame:
    counts = score_counts(df, score, label)
    return ranks.with_prefix_sums(counts, [F.col("score").asc()], ["n1", "n0"],
                                  num_partitions=num_partitions)


def auc_exact(df: DataFrame, score: str, label: str, num_partitions: int | None = None) -> DataFrame:
    """EV-3: exact ROC AUC with ties counted half (Mann-Whitney), one row.

    AUC = sum_s n1(s) * (2 * n0_below(s) + n0(s)) / (2 * P * N), integer arithmetic until
    the last division, so the value does not depend on the order of addition.
    """
    cum = _cumulative(df, score, label, num_partitions)
    big = "decimal(38,0)"
    below = F.col("cum_n0") - F.col("n0")
    num = F.sum(F.col("n1").cast(big) * (F.lit(2) * below + F.col("n0")).cast(big))
    pos = F.first("total_n1")
    neg = F.first("total_n0")
    return cum.agg(
        F.round(F.try_divide(num.cast("double"), (F.lit(2.0) * pos * neg)), DIGITS).alias("auc"),
        pos.alias("n_pos"),
        neg.alias("n_neg"),
    )


def cumulative_by(df: DataFrame, by: Sequence[str], score: str, label: str,
                  num_partitions: int | None = None) -> DataFrame:
    """Per group and distinct score: n1, n0, running cum_n1 / cum_n0 and group totals t1 / t0.

    Running sums are taken once in (group, score) order over the whole stacked table and
    rebased per group: the sums before a group's first row are subtracted, found with a
    per-group aggregate (one row per group, broadcast back: the groups are the caller's
    candidates, splits or segments).
    """
    g = list(by)
    counts = (
        df.where(F.col(score).isNotNull() & F.col(label).isNotNull() & ~F.isnan(F.col(score)))
        .groupBy(*g, F.col(score).cast("double").alias("score"))
        .agg(F.count_if(F.col(label) == 1).cast("long").alias("n1"),
             F.count_if(F.col(label) != 1).cast("long").alias("n0"))
    )
    cum = ranks.with_prefix_sums(counts, [*[F.col(c).asc() for c in g], F.col("score").asc()], ["n1", "n0"],
                                 num_partitions=num_partitions)
    starts = cum.groupBy(*g).agg(
        F.min(F.col("cum_n1") - F.col("n1")).alias("_b1"), F.min(F.col("cum_n0") - F.col("n0")).alias("_b0"),
        F.sum("n1").alias("t1"), F.sum("n0").alias("t0"))
    return cum.join(F.broadcast(starts), g).select(
        *g, "score", "n1", "n0",
        (F.col("cum_n1") - F.col("_b1")).alias("cum_n1"), (F.col("cum_n0") - F.col("_b0")).alias("cum_n0"),
        "t1", "t0")


def auc_exact_by(df: DataFrame, by: Sequence[str], score: str, label: str,
                 num_partitions: int | None = None) -> DataFrame:
    """EV-3 for many groups (candidate models, splits) in one ranking pass: one row per group."""
    g = list(by)
    cum = cumulative_by(df, g, score, label, num_partitions)
    big = "decimal(38,0)"
    below = F.col("cum_n0") - F.col("n0")
    return cum.groupBy(*g).agg(
        F.round(F.try_divide(
            F.sum(F.col("n1").cast(big) * (F.lit(2) * below + F.col("n0")).cast(big)).cast("double"),
            F.lit(2.0) * F.first("t1") * F.first("t0")), DIGITS).alias("auc"),
        F.first("t1").alias("n_pos"),
        F.first("t0").alias("n_neg"),
    )


def ks_exact_by(df: DataFrame, by: Sequence[str], score: str, label: str,
                num_partitions: int | None = None) -> DataFrame:
    """EV-5 for many groups in one ranking pass: (group..., ks, p_value, n_pos, n_neg)."""
    g = list(by)
    cum = cumulative_by(df, g, score, label, num_partitions)
    gap = F.abs(F.try_divide(F.col("cum_n1"), F.col("t1").cast("double"))
                - F.try_divide(F.col("cum_n0"), F.col("t0").cast("double")))
    stats = cum.groupBy(*g).agg(F.max(gap).alias("d"), F.first("t1").alias("n_pos"), F.first("t0").alias("n_neg"))
    lam = F.col("d") * F.sqrt(F.col("n_pos") * F.col("n_neg") / (F.col("n_pos") + F.col("n_neg")))
    return stats.select(*g, F.round("d", DIGITS).alias("ks"), F.round(kolmogorov_pvalue(lam), 6).alias("p_value"),
                        "n_pos", "n_neg")


def auc_ks_exact_by(df: DataFrame, by: Sequence[str], score: str, label: str, num_partitions: int | None = None) -> DataFrame:
    """EV-3 + EV-5 for many groups from one ranking pass: (group..., auc, ks, n_pos, n_neg)."""
    g = list(by)
    big = "decimal(38,0)"
    below = F.col("cum_n0") - F.col("n0")
    gap = F.abs(F.try_divide(F.col("cum_n1"), F.col("t1").cast("double")) - F.try_divide(F.col("cum_n0"), F.col("t0").cast("double")))
    area = F.sum(F.col("n1").cast(big) * (F.lit(2) * below + F.col("n0")).cast(big)).cast("double")
    return cumulative_by(df, g, score, label, num_partitions).groupBy(*g).agg(
        F.round(F.try_divide(area, F.lit(2.0) * F.first("t1") * F.first("t0")), DIGITS).alias("auc"), F.round(F.max(gap), DIGITS).alias("ks"),
        F.first("t1").alias("n_pos"), F.first("t0").alias("n_neg"))


def kolmogorov_pvalue(lam: Column) -> Column:
    """Asymptotic two-sided p-value Q_KS(lambda) = 2 sum_k (-1)^(k-1) exp(-2 k^2 lambda^2).

    Below lambda = 1 the alternating series converges slowly, so the theta-function form
    1 - sqrt(2 pi)/lambda * sum_k exp(-(2k-1)^2 pi^2 / (8 lambda^2)) is used there.
    Result clamped to [0, 1]. (scipy's exact small-sample p is not used.)
    """
    ks = F.sequence(F.lit(1), F.lit(100))
    alternating = F.aggregate(
        ks, F.lit(0.0),
        lambda acc, k: acc + F.lit(2.0) * F.pow(F.lit(-1.0), k - 1) * F.exp(F.lit(-2.0) * k * k * lam * lam),
    )
    theta = F.lit(1.0) - F.sqrt(F.lit(2.0 * 3.141592653589793)) / lam * F.aggregate(
        ks, F.lit(0.0),
        lambda acc, k: acc + F.exp(-F.pow(F.lit(2.0) * k - 1, 2) * F.lit(3.141592653589793 ** 2) / (F.lit(8.0) * lam * lam)),
    )
    raw = F.when(lam <= 0, F.lit(1.0)).when(lam < 1, theta).otherwise(alternating)
    return F.least(F.greatest(raw, F.lit(0.0)), F.lit(1.0))


def ks_exact(df: DataFrame, score: str, label: str, num_partitions: int | None = None) -> DataFrame:
    """EV-5: two-sample KS statistic between the score distributions of label 1 and label 0.

    D = max over distinct scores |F1(s) - F0(s)|; p-value from the Kolmogorov limit law with
    lambda = D * sqrt(n1 n0 / (n1 + n0)). One row: ks, p_value, n_pos, n_neg.
    """
    cum = _cumulative(df, score, label, num_partitions)
    gap = F.abs(F.try_divide(F.col("cum_n1"), F.col("total_n1").cast("double"))
                - F.try_divide(F.col("cum_n0"), F.col("total_n0").cast("double")))
    stats = cum.agg(F.max(gap).alias("d"), F.first("total_n1").alias("n_pos"), F.first("total_n0").alias("n_neg"))
    lam = F.col("d") * F.sqrt(F.col("n_pos") * F.col("n_neg") / (F.col("n_pos") + F.col("n_neg")))
    return stats.select(
        F.round("d", DIGITS).alias("ks"),
        F.round(kolmogorov_pvalue(lam), 6).alias("p_value"),
        "n_pos", "n_neg",
    )


def auc_ks_exact(df: DataFrame, score: str, label: str, num_partitions: int | None = None) -> DataFrame:
    """EV-3 + EV-5 from one ranking pass (the running sums are frozen once): one row
    (auc, ks, p_value, n_pos, n_neg)."""
    cum = _cumulative(df, score, label, num_partitions)
    big = "decimal(38,0)"
    below = F.col("cum_n0") - F.col("n0")
    gap = F.abs(F.try_divide(F.col("cum_n1"), F.col("total_n1").cast("double"))
                - F.try_divide(F.col("cum_n0"), F.col("total_n0").cast("double")))
    stats = cum.agg(
        F.sum(F.col("n1").cast(big) * (F.lit(2) * below + F.col("n0")).cast(big)).alias("num"),
        F.max(gap).alias("d"), F.first("total_n1").alias("n_pos"), F.first("total_n0").alias("n_neg"))
    lam = F.col("d") * F.sqrt(F.col("n_pos") * F.col("n_neg") / (F.col("n_pos") + F.col("n_neg")))
    return stats.select(
        F.round(F.try_divide(F.col("num").cast("double"), F.lit(2.0) * F.col("n_pos") * F.col("n_neg")), DIGITS).alias("auc"),
        F.round("d", DIGITS).alias("ks"), F.round(kolmogorov_pvalue(lam), 6).alias("p_value"), "n_pos", "n_neg")


def decile_table(df: DataFrame, score: str, label: str, key: str, k: int = 10, descending: bool = True,
                 num_partitions: int | None = None) -> DataFrame:
    """EV-4 / WIN-1 / AGG-5 / WIN-2: bads and goods per score tile with cumulative shares.

    Tiles are NTILE(k) over (score desc, key) -- the key makes ties deterministic.
    Output (decile, bads, goods, cum_bads, cum_goods, cum_bad_pct, cum_good_pct, ks)
    has k rows, so the running sums over it are a window on k rows.
    """
    s = F.col(score)
    order = [s.desc() if descending else s.asc(), F.col(key).asc()]
    rows = df.where(s.isNotNull() & F.col(label).isNotNull()).select(score, key, label)
    tiled = ranks.with_ntile(rows, order, k, "decile", num_partitions=num_partitions)
    per = tiled.groupBy("decile").agg(
        F.count_if(F.col(label) == 1).cast("long").alias("bads"),
        F.count_if(F.col(label) == 0).cast("long").alias("goods"),
    )
    run = Window.orderBy("decile").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy()
    out = per.withColumns({
        "cum_bads": F.sum("bads").over(run),
        "cum_goods": F.sum("goods").over(run),
        "_tb": F.sum("bads").over(whole),
        "_tg": F.sum("goods").over(whole),
    })
    out = out.withColumns({
        "cum_bad_pct": F.round(F.try_divide(F.col("cum_bads"), F.col("_tb").cast("double")), DIGITS),
        "cum_good_pct": F.round(F.try_divide(F.col("cum_goods"), F.col("_tg").cast("double")), DIGITS),
    })
    out = out.withColumn(
        "ks",
        F.round(F.try_divide(F.col("cum_bads"), F.col("_tb").cast("double"))
                - F.try_divide(F.col("cum_goods"), F.col("_tg").cast("double")), DIGITS),
    )
    return out.drop("_tb", "_tg")


def ks_decile(df: DataFrame, score: str, label: str, key: str, k: int = 10, **kw) -> DataFrame:
    """EV-4: signed max over tiles of cum bad share minus cum good share (one row)."""
    return decile_table(df, score, label, key, k, **kw).agg(F.max("ks").alias("ks_decile"))


def _distinct_edges(edges: Sequence[float] | None) -> list[float]:
    """Edges in order without NULLs and repeats."""
    out: list[float] = []
    for e in edges or []:
        if e is not None and (not out or e != out[-1]):
            out.append(e)
    return out


def quantile_edges(df: DataFrame, score: str, q: int, num_partitions: int | None = None) -> list[float]:
    """WIN-4: ``q``-quantile edges, de-duplicated, in order (linear interpolation, pandas/numpy parity)."""
    return _distinct_edges(ranks.exact_quantiles(df, score, [i / q for i in range(q + 1)], num_partitions))


def qcut_bucket(x: Column, edges: Sequence[float]) -> Column:
    """Right-closed bucket index (0-based) of ``x`` among de-duplicated ``edges``; the
    lowest edge is included in bucket 0 (pandas ``qcut`` semantics)."""
    inner = F.array(*[F.lit(float(e)) for e in edges[1:-1]])
    return F.size(F.filter(inner, lambda c: c < x))


def bucket_table(df: DataFrame, score: str, label: str, q: int = 20,
                 num_partitions: int | None = None, method: str = "exact") -> DataFrame:
    """Per quantile bucket: rows, events, mean score, event rate, running shares (EV-7, EV-11).

    ``exact``: rows are collapsed once to counts per score; edges and bucket totals both read
    that table. ``approx``: edges from one ``percentile_approx`` sketch (rank error <= n / 100000).
    """
    rows = df.where(F.col(label).isNotNull())
    sums = {"_n": F.count(F.lit(1)), "_events": F.sum(label)}
    probs = [i / q for i in range(q + 1)]
    if method == "approx":
        rows = rows.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))
        counted = rows.groupBy(F.col(score).cast("double").alias(score)).agg(*[e.alias(c) for c, e in sums.items()])
        found = rows.agg(F.percentile_approx(F.col(score).cast("double"), probs, 100_000).alias("cuts"))
    else:
        counted = ranks.freeze_counts(rows, [], score, sums, num_partitions)
        found = ranks.quantiles_of_counts(counted, [], score, "_n", probs)
    edges = _distinct_edges(found.first()["cuts"])
    per = counted.groupBy(qcut_bucket(F.col(score), edges).alias("bucket")).agg(
        F.sum("_n").cast("long").alias("n"),
        F.sum("_events").cast("long").alias("events"),
        (F.sum(F.col(score) * F.col("_n")) / F.sum("_n")).alias("avg_score"),
    )
    run = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy()
    return per.withColumns({
        "cum_events": F.sum("events").over(run),
        "cum_non_events": F.sum(F.col("n") - F.col("events")).over(run),
        "total_events": F.sum("events").over(whole),
        "total_rows": F.sum("n").over(whole),
    })


def ks_qcut(df: DataFrame, score: str, label: str, q: int = 20, num_partitions: int | None = None,
            method: str = "exact") -> DataFrame:
    """EV-7: KS over ``q`` quantile buckets, absolute max, 1e-9 guards on the totals."""
    t = bucket_table(df, score, label, q, num_partitions, method)
    gap = F.abs(
        F.col("cum_events") / (F.col("total_events") + F.lit(1e-9))
        - F.col("cum_non_events") / ((F.col("total_rows") - F.col("total_events")) + F.lit(1e-9))
    )
    return t.agg(F.round(F.max(gap), DIGITS).alias("ks_qcut"))


def calibration(df: DataFrame, score: str, label: str, q: int = 10, num_partitions: int | None = None,
                method: str = "exact") -> DataFrame:
    """EV-11: mean predicted vs observed event rate per quantile bucket of the score."""
    t = bucket_table(df, score, label, q, num_partitions, method)
    return t.select(
        "bucket", "n", "events",
        F.round("avg_score", DIGITS).alias("mean_predicted"),
        F.round(F.col("events") / F.col("n"), DIGITS).alias("observed_rate"),
        F.round(F.col("avg_score") - F.col("events") / F.col("n"), DIGITS).alias("gap"),
    )
