"""Loan ETL: cleaning, feature derivation, profiling (PRJ-*, FLT-*, AGG-1..4).

All steps are projections, filters and one-pass aggregates: Catalyst collapses the
projections into one codegen stage and pushes filters to the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from riskloom.functions import columns as C

CORE_COLUMNS = ("fico_score", "loan_amount", "monthly_income", "loan_status_flag")


def impute_and_label(df: DataFrame, status: str = "loan_status", fico: str = "fico_score",
                     label: str = "loan_status_flag") -> DataFrame:
    """PRJ-1 + PRJ-2: FICO NULL -> 600 and the label re-derived from the status text."""
    return df.withColumns({fico: C.impute_const(fico), label: C.label_from_status(status)})


def basic_clean(df: DataFrame, **kw) -> DataFrame:
    """The minimal ETL: impute, label, then drop every row with any NULL/NaN (FLT-1)."""
    return impute_and_label(df, **kw).dropna()


def engineer_features(df: DataFrame) -> DataFrame:
    """PRJ-3, 4, 6, 7: cltv, util_bin, delinq_flag, high_risk_flag."""
    return df.withColumns({
        "cltv": C.cltv(),
        "util_bin": C.util_bin(),
        "delinq_flag": C.flag_equals("loan_status_flag", 1),
        "high_risk_flag": C.high_risk_flag(),
    })


def drop_incomplete(df: DataFrame, subset: Sequence[str] = CORE_COLUMNS) -> DataFrame:
    """FLT-2: drop rows with a NULL (or NaN) in any of ``subset``."""
    return df.dropna(subset=list(subset))


def loan_etl(df: DataFrame, subset: Sequence[str] = CORE_COLUMNS) -> DataFrame:
    """The full loan ETL (features then FLT-2), same order as the batch job it replaces."""
    return drop_incomplete(engineer_features(df), subset)


def with_column_if_missing(df: DataFrame, name: str, source: str) -> DataFrame:
    """PRJ-11: add ``name`` as a copy of ``source`` only when absent."""
    return df if name in df.columns else df.withColumn(name, F.col(source))


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """PRJ-12: feature discovery from the schema: numeric columns not excluded."""
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in skip]


def cast_columns(df: DataFrame, types: dict[str, str], safe: bool = True) -> DataFrame:
    """PRJ-8: cast many columns; ``safe`` uses try_cast so dirty cells become NULL under ANSI."""
    conv = (lambda c, t: F.col(c).try_cast(t)) if safe else (lambda c, t: F.col(c).cast(t))
    return df.withColumns({c: conv(c, t) for c, t in types.items()})


def class_balance(df: DataFrame, label: str = "loan_status_flag") -> DataFrame:
    """AGG-1/2: rows per label value (partial aggregation before the shuffle)."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def default_rate_by(df: DataFrame, by: str | Sequence[str], label: str = "loan_status_flag") -> DataFrame:
    """Rows, defaults and default rate per group (AGG-1 + AGG-5)."""
    keys = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(label) == 1).alias("n_default"),
        F.round(F.count_if(F.col(label) == 1) / F.count(F.lit(1)), 9).alias("default_rate"),
    )


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """FLT-5: NULL count of every column in one pass (one row, one column per input column).

    NaN is counted with NULL for floating columns, as ``dropna`` treats both as missing.
    """
    cols = list(columns) if columns is not None else df.columns
    types = dict(df.dtypes)

    def missing(c: str):
        cond = F.col(c).isNull()
        if types[c] in ("double", "float"):
            cond = cond | F.isnan(F.col(c))
        return F.count_if(cond).alias(f"null_{c}")

    return df.agg(F.count(F.lit(1)).alias("n_rows"), *[missing(c) for c in cols])


def preview(df: DataFrame, columns: Sequence[str], n: int, order_by: Sequence[str]) -> DataFrame:
    """SNK-6/SRT-3: first ``n`` rows in a stated order (top-k; the limit is the feature)."""
    return df.select(*columns).orderBy(*order_by).limit(n)
