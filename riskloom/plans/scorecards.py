"""Fixed-coefficient linear scorecards used as oracle-checkable "models" (ML-7, ML-8).

A fitted spark.ml model has no SQL twin, so the SQL-checked queries score with fixed
coefficients instead; the spark.ml queries (``plans.modeling``) train real models on
the same tables.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# name -> (coefficients in order, intercept)
SCORECARDS: dict[str, tuple[dict[str, float], float]] = {
    "scorecard_utilization": (
        {"utilization_rate": 2.0, "dti": 1.5, "delinq_12m": 0.4, "inquiries_6m": 0.1}, -2.5),
    "scorecard_capacity": ({"income": -0.0001, "cltv": 1.0}, 0.5),
    "scorecard_history": ({"num_trades": 0.2, "age": -0.01}, -0.5),
}
DEFAULT_SCORECARD = "scorecard_utilization"
MODEL_VERSION = "scorecard_utilization|fixed-v1"

# Windows of the bureau view (its snapshot dates run 1995..2001).
BUREAU_TRAIN = ("1995-01-01", "1999-12-31")
BUREAU_VALID = ("2000-01-01", "2001-12-31")


def z_expr(name: str = DEFAULT_SCORECARD) -> Column:
    coefs, intercept = SCORECARDS[name]
    z = F.lit(float(intercept))
    for feature, c in coefs.items():
        z = z + F.lit(float(c)) * F.col(feature)
    return z


def z_sql(name: str = DEFAULT_SCORECARD) -> str:
    coefs, intercept = SCORECARDS[name]
    terms = [f"CAST({intercept!r} AS DOUBLE)"] + [f"CAST({c!r} AS DOUBLE) * {f}" for f, c in coefs.items()]
    return "(" + " + ".join(terms) + ")"


def pd_sql(name: str = DEFAULT_SCORECARD) -> str:
    return f"(CAST(1 AS DOUBLE) / (CAST(1 AS DOUBLE) + EXP(-{z_sql(name)})))"
