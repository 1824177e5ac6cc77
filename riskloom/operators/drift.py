"""Population stability (DRF-1..3).

PSI(expected, actual, bins): cut points are the exact quantiles of ``expected`` (outer
edges replaced by -inf/+inf); both sides are binned left-closed (last bin closed);
shares use a 1e-9 guard; PSI = sum (a - e) * ln((a + 1e-9) / (e + 1e-9)).
NULL and NaN fall in no bin. Repeated cut points leave an empty bin (term 0).

All features are handled in one pass over a stacked (feature, value, period) table. It is
collapsed once to counts per (feature, value) and period; cut points and bin counts both
read that table (``ranks.freeze_counts``), so the input is computed once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators import ranks

EPS = 1e-9
DIGITS = 9


def psi_bin(x: Column, cuts: Column, bins: int) -> Column:
    """Bin 0..bins-1 of ``x``: count of interior cut points <= x."""
    inner = F.slice(cuts, 2, bins - 1)
    return F.size(F.filter(inner, lambda c: x >= c))


def stack_features(df: DataFrame, features: Sequence[str], period: Column | str, key_cols: Sequence[str] = ()) -> DataFrame:
    """(feature, value, period): one row per input row and feature; NULL/NaN values dropped.

    Build stacked tables with this (an explode) rather than a literal feature column: with
    a literal the optimizer folds the feature join key in ``psi_by_feature`` and plans a
    nested-loop join.
    """
    per = F.col(period) if isinstance(period, str) else period
    stacked = df.select(
        *key_cols, per.alias("period"),
        F.explode(F.array(*[
            F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features
        ])).alias("_fv"),
    ).select(*key_cols, "period", F.col("_fv.feature").alias("feature"), F.col("_fv.value").alias("value"))
    return stacked.where(F.col("value").isNotNull() & ~F.isnan("value") & F.col("period").isNotNull())


APPROX_ACCURACY = 100_000  # percentile_approx: rank error <= n / accuracy


def psi_by_feature(stacked: DataFrame, expected: str = "expected", actual: str = "actual", bins: int = 10,
                   num_partitions: int | None = None, method: str = "exact") -> DataFrame:
    """DRF-3: PSI per feature from a stacked (feature, value, period) table, one plan.

    Output (feature, psi, n_expected, n_actual). ``method``: cut points are ``exact`` order
    statistics (numpy/DuckDB parity), or ``approx``: one bounded quantile sketch per feature over
    the rows, without a sort (rank error <= n / APPROX_ACCURACY). A feature without expected rows is absent.
    """
    probs = [i / bins for i in range(bins + 1)]
    period = F.col("period")
    rows = stacked.where(period.isin(expected, actual))
    if method == "approx":
        counted = rows.select("feature", "value", (period == expected).cast("int").alias("_e"), (period == actual).cast("int").alias("_a"))
        cuts = counted.where(F.col("_e") == 1).groupBy("feature").agg(F.percentile_approx("value", probs, APPROX_ACCURACY).alias("cuts"))
    else:
        counted = ranks.freeze_counts(
            rows, ["feature"], "value", {"_e": F.count_if(period == expected), "_a": F.count_if(period == actual)}, num_partitions)
        cuts = ranks.quantiles_of_counts(counted, ["feature"], "value", "_e", probs)
    # one row per feature (bounded by the table's columns): broadcast, never a shuffle join
    # keyed on the few feature names, which would put each feature's values in one task
    binned = counted.join(F.broadcast(cuts), "feature").select(
        "feature", "_e", "_a", psi_bin(F.col("value"), F.col("cuts"), bins).alias("bin"))
    counts = binned.groupBy("feature").agg(
        *[F.sum(F.when(F.col("bin") == b, F.col("_e")).otherwise(0)).alias(f"e{b}") for b in range(bins)],
        *[F.sum(F.when(F.col("bin") == b, F.col("_a")).otherwise(0)).alias(f"a{b}") for b in range(bins)],
    )
    e_tot = sum((F.col(f"e{b}") for b in range(bins)), F.lit(0))
    a_tot = sum((F.col(f"a{b}") for b in range(bins)), F.lit(0))
    terms = []
    for b in range(bins):
        e = F.col(f"e{b}") / (e_tot + F.lit(EPS))
        a = F.col(f"a{b}") / (a_tot + F.lit(EPS))
        terms.append((a - e) * F.log((a + F.lit(EPS)) / (e + F.lit(EPS))))
    psi = terms[0]
    for t in terms[1:]:
        psi = psi + t
    return counts.select(
        "feature",
        F.round(psi, DIGITS).alias("psi"),
        e_tot.cast("long").alias("n_expected"),
        a_tot.cast("long").alias("n_actual"),
    )


def psi(expected: DataFrame, actual: DataFrame, column: str, bins: int = 10,
        num_partitions: int | None = None, method: str = "exact") -> DataFrame:
    """DRF-1: PSI of one column between two DataFrames (one row: psi, n_expected, n_actual)."""
    e = expected.select(F.col(column).alias("_x"), F.lit("expected").alias("_p"))
    a = actual.select(F.col(column).alias("_x"), F.lit("actual").alias("_p"))
    stacked = stack_features(e.unionByName(a).withColumnRenamed("_x", column), [column], "_p")
    return psi_by_feature(stacked, bins=bins, num_partitions=num_partitions, method=method).drop("feature")


STORE = "feature string, value double, n long, period string"


def add_periods(df: DataFrame, features: Sequence[str], period: Column | str, store: str) -> None:
    """DRF-3 over time: merge the value counts of the periods in ``df`` into the table at ``store`` (a folder per period).

    A period that the store has already is replaced; others are neither read nor written. Rows without a period or value do not count.
    """
    stacked = stack_features(df, features, period)
    counts = stacked.groupBy("feature", "value", F.col("period").cast("string").alias("period")).agg(F.count("*").alias("n"))
    counts.select("feature", "value", "n", "period").write.partitionBy("period").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(store)


def psi_over_periods(spark: SparkSession, store: str, base: str, bins: int = 10, periods: Sequence[str] | None = None) -> DataFrame:
    """PSI of each (feature, period) of the store against the period ``base``: feature, period, psi, n_base, n (full precision).

    Reads counts per distinct value of the base and of ``periods`` (default: all). Cut points are the base's exact quantiles; a feature
    without base rows is absent.
    """
    rows = spark.read.schema(STORE).parquet(store)
    if periods is not None:
        rows = rows.where(F.col("period").isin([base, *periods]))
    frozen = ranks.freeze_counts(rows.where(F.col("period") == base), ["feature"], "value", {"_n": F.sum("n")})
    cuts = ranks.quantiles_of_counts(frozen, ["feature"], "value", "_n", [i / bins for i in range(bins + 1)])
    binned = rows.join(cuts, "feature").select("feature", "period", "n", psi_bin(F.col("value"), F.col("cuts"), bins).alias("bin"))
    per = binned.groupBy("feature", "period").agg(*[F.sum(F.when(F.col("bin") == b, F.col("n")).otherwise(0)).alias(f"a{b}") for b in range(bins)])
    first = per.where(F.col("period") == base).select("feature", *[F.col(f"a{b}").alias(f"e{b}") for b in range(bins)])
    both = per.join(first, "feature")
    e_tot, a_tot = (sum((F.col(f"{x}{b}") for b in range(bins)), F.lit(0)) for x in "ea")
    total = F.lit(0.0)
    for b in range(bins):
        e, a = F.col(f"e{b}") / (e_tot + F.lit(EPS)), F.col(f"a{b}") / (a_tot + F.lit(EPS))
        total = total + (a - e) * F.log((a + F.lit(EPS)) / (e + F.lit(EPS)))
    return both.select("feature", "period", total.alias("psi"), e_tot.cast("long").alias("n_base"), a_tot.cast("long").alias("n"))
