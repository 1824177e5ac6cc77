"""Column expressions (JVM-side, codegen'd) for loan features.

Every function returns a ``Column``; none needs a UDF.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed values that must equal the reference's for equal results.
FICO_IMPUTE_VALUE = 600
DEFAULT_STATUS_TEXT = "Default"
UTIL_BIN_CUTS = (0.3, 0.6)  # text bins Low / Medium / High
UTIL_BIN_LABELS = ("Low", "Medium", "High")
UTIL_INDEX_CUTS = (0.3, 0.7)  # numeric bin index 0 / 1 / 2
HIGH_RISK_FICO_BELOW = 580
HIGH_RISK_PLAN = "Business"


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def impute_const(c: ColumnOrName, value=FICO_IMPUTE_VALUE) -> Column:
    """PRJ-1: replace NULL by a constant."""
    return F.coalesce(_c(c), F.lit(value))


def label_from_status(c: ColumnOrName, positive: str = DEFAULT_STATUS_TEXT) -> Column:
    """PRJ-2: 1 when the status text equals ``positive``; anything else, NULL included, is 0."""
    return F.when(_c(c) == F.lit(positive), 1).otherwise(0)


def cltv(income: ColumnOrName = "monthly_income", tenure: ColumnOrName = "tenure_months",
         amount: ColumnOrName = "loan_amount") -> Column:
    """PRJ-3: income over the term minus the amount (usually negative)."""
    return _c(income) * _c(tenure) / F.lit(12) - _c(amount)


def util_bin(c: ColumnOrName = "credit_utilization", cuts: Sequence[float] = UTIL_BIN_CUTS,
             labels: Sequence[str] = UTIL_BIN_LABELS) -> Column:
    """PRJ-4: text bin; NULL utilization falls to the last label."""
    expr = None
    for cut, label in zip(cuts, labels):
        cond = _c(c) < F.lit(cut)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(labels[len(cuts)])


def util_bin_index(c: ColumnOrName = "credit_utilization", cuts: Sequence[float] = UTIL_INDEX_CUTS) -> Column:
    """PRJ-5: integer bin 0..len(cuts); NULL falls to the last bin."""
    expr = None
    for i, cut in enumerate(cuts):
        cond = _c(c) < F.lit(cut)
        expr = F.when(cond, i) if expr is None else expr.when(cond, i)
    return expr.otherwise(len(cuts))


def flag_equals(c: ColumnOrName = "loan_status_flag", value=1) -> Column:
    """PRJ-6: boolean to int; a NULL input stays NULL."""
    return (_c(c) == F.lit(value)).cast("int")


def high_risk_flag(fico: ColumnOrName = "fico_score", plan: ColumnOrName = "plan_type",
                   bankruptcy: ColumnOrName = "has_bankruptcy") -> Column:
    """PRJ-7: OR of three rules in three-valued logic; unknown counts as 0."""
    cond = (_c(fico) < HIGH_RISK_FICO_BELOW) | (_c(plan) == HIGH_RISK_PLAN) | (_c(bankruptcy) == 1)
    return F.when(cond, 1).otherwise(0)


def safe_log1p(c: ColumnOrName) -> Column:
    """PRJ-15: log1p of the non-negative part; NULL stays NULL."""
    return F.when(_c(c).isNotNull(), F.log1p(F.greatest(_c(c), F.lit(0.0))))


def parse_date(c: ColumnOrName) -> Column:
    """PRJ-17: ``yyyy-MM-dd`` or ISO date-time text to DATE; unparsable text becomes NULL."""
    text = _c(c).cast("string")
    return F.coalesce(
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss")).cast("date"),
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date"),
    )


def utc_timestamp_text(ts: ColumnOrName | None = None) -> Column:
    """PRJ-18: ``yyyy-MM-dd'T'HH:mm:ss'Z'`` text of a timestamp (default: now) in UTC."""
    value = F.current_timestamp() if ts is None else _c(ts)
    return F.date_format(F.to_utc_timestamp(value, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def sigmoid(z: ColumnOrName) -> Column:
    """Logistic link 1 / (1 + e^-z)."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(z)))


def linear_score(coefficients: dict[str, float], intercept: float = 0.0) -> Column:
    """ML-7 (fixed coefficients): intercept + sum(coef * feature) as one expression."""
    z = F.lit(float(intercept))
    for name, coef in coefficients.items():
        z = z + F.lit(float(coef)) * F.col(name)
    return z


def hash_bucket(key: ColumnOrName, buckets: int = 100) -> Column:
    """Stable bucket 0..buckets-1 from the first 16 bits of md5(key) (SPL-1)."""
    return (F.conv(F.substring(F.md5(_c(key).cast("string")), 1, 4), 16, 10).cast("int") % F.lit(buckets))
