"""Splits (SPL-1..3, FLT-6, SRT-2).

The default split is a hash of the key: stable under repartitioning and executor loss,
and the same rows in any engine. ``randomSplit`` is kept for parity; it depends on
the partitioning of its input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import hash_bucket, parse_date


def with_hash_split(df: DataFrame, key: str, train_pct: int = 80, col: str = "split",
                    names: tuple[str, str] = ("train", "test")) -> DataFrame:
    """SPL-1 default: ``train`` when md5(key) bucket (0..99) < ``train_pct``."""
    return df.withColumn(col, F.when(hash_bucket(key) < F.lit(train_pct), names[0]).otherwise(names[1]))


def hash_split(df: DataFrame, key: str, train_pct: int = 80) -> tuple[DataFrame, DataFrame]:
    b = hash_bucket(key)
    return df.where(b < F.lit(train_pct)), df.where(b >= F.lit(train_pct))


def random_split(df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 42) -> list[DataFrame]:
    """SPL-1 as the reference wrote it (``randomSplit``)."""
    return df.randomSplit(list(weights), seed=seed)


def bernoulli_sample(df: DataFrame, fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """SPL-3: sampling is the feature here."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def in_window(date_col: str, window: tuple[str, str]):
    """FLT-6: inclusive date range; NULL dates are outside every window."""
    return F.col(date_col).between(F.to_date(F.lit(window[0])), F.to_date(F.lit(window[1])))


def with_time_split(df: DataFrame, date_col: str, train: tuple[str, str], valid: tuple[str, str],
                    col: str = "split") -> DataFrame:
    """SPL-2: label rows ``train`` / ``valid`` by inclusive windows; other rows get NULL."""
    return df.withColumn(
        col, F.when(in_window(date_col, train), "train").when(in_window(date_col, valid), "valid")
    )


def time_split(df: DataFrame, date_col: str, train: tuple[str, str], valid: tuple[str, str]):
    return df.where(in_window(date_col, train)), df.where(in_window(date_col, valid))


def sorted_by_date(df: DataFrame, date_col: str, key: str | None = None) -> DataFrame:
    """SRC-4/SRT-2: parse the date (bad text -> NULL) and order by it, NULLs last."""
    out = df.withColumn(date_col, parse_date(date_col)) if dict(df.dtypes)[date_col] == "string" else df
    order = [F.col(date_col).asc_nulls_last()] + ([F.col(key).asc()] if key else [])
    return out.orderBy(*order)
