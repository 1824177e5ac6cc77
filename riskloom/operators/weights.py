"""Class weights (CW-1..8): one class-count table, joined back by label.

The count table has one row per class (two for a 0/1 label) and is built by a
partial + final aggregate; the fixed schemes need no table at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCHEMES = (
    "majority",          # CW-1  max(count) / count_k
    "neg_pos",           # CW-2  label 1: n0 / n1, label 0: 1
    "total_over_count",  # CW-3  n / count_k
    "complement",        # CW-4  label 1: 1 - p, label 0: p (p = share of label 1)
    "fixed_4_1",         # CW-5
    "fixed_3_1",         # CW-6
    "fixed_5_1",         # CW-7  written as flag * 4 + 1
    "balanced",          # CW-8  n / (K * count_k)
)

# Fixed values that must equal the reference's: constant weights of label 1 (label 0 gets 1).
FIXED = {"fixed_4_1": 4.0, "fixed_3_1": 3.0, "fixed_5_1": 5.0}


def class_table(df: DataFrame, label: str) -> DataFrame:
    """(label, n, w_<scheme> for every scheme); one row per class."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).cast("long").alias("n"))
    whole = Window.partitionBy()
    n = F.sum("n").over(whole)
    n1 = F.sum(F.when(F.col(label) == 1, F.col("n")).otherwise(0)).over(whole)
    n0 = F.sum(F.when(F.col(label) == 0, F.col("n")).otherwise(0)).over(whole)
    k = F.count(F.lit(1)).over(whole)
    is1 = F.col(label) == 1
    weights: dict[str, Column] = {
        "w_majority": F.max("n").over(whole) / F.col("n"),
        "w_neg_pos": F.when(is1, F.try_divide(n0, n1.cast("double"))).otherwise(F.lit(1.0)),
        "w_total_over_count": n / F.col("n"),
        "w_complement": F.when(is1, F.lit(1.0) - n1 / n).otherwise(n1 / n),
        **{f"w_{s}": F.when(is1, F.lit(v)).otherwise(F.lit(1.0)) for s, v in FIXED.items()},
        "w_balanced": n / (k * F.col("n")),
    }
    return counts.select(label, "n", *[F.round(v, 12).alias(name) for name, v in weights.items()])


def with_class_weight(df: DataFrame, label: str, scheme: str = "majority", weight_col: str = "class_weight",
                      fit_on: DataFrame | None = None) -> DataFrame:
    """Add ``weight_col`` for ``scheme``; rows with a NULL label get NULL.

    ``fit_on``: the rows whose class counts give the weights (the training rows, when ``df`` also
    holds evaluation rows); default: ``df`` itself. A class absent from them gets NULL.
    """
    if scheme not in SCHEMES:
        raise ValueError(f"unknown scheme {scheme!r}; one of {SCHEMES}")
    if scheme in FIXED:
        return df.withColumn(
            weight_col,
            F.when(F.col(label) == 1, F.lit(FIXED[scheme])).when(F.col(label).isNotNull(), F.lit(1.0)),
        )
    table = class_table(df if fit_on is None else fit_on, label).select(label, F.col(f"w_{scheme}").alias(weight_col))
    # one row per class: bounded by the label's cardinality
    return df.join(F.broadcast(table), label, "left")
