"""Registered queries of the distribution tests (EV-1, EV-5, EV-8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import distribution_tests as T
from riskloom.operators import features
from riskloom.plans import catalog
from riskloom.plans.catalog import CLEAN_LOANS_SQL, PARAM_DIGITS, SIG, D, query

LABEL = "loan_status_flag"
#: Points of the thinned curve in the query (the usual 1000 would leave the few hundred distinct scores as they are).
AUC_BINS = 50

_PER_SCORE = f"""per AS (SELECT fico_score AS s, CAST(COUNT_IF({LABEL} = 1) AS BIGINT) AS n1, CAST(COUNT_IF({LABEL} <> 1) AS BIGINT) AS n0 FROM clean GROUP BY 1)"""


@query("ev1_auc_binned", f"""WITH {CLEAN_LOANS_SQL}, {_PER_SCORE},
o AS (SELECT *, ROW_NUMBER() OVER (ORDER BY s DESC) - 1 AS pos, COUNT(*) OVER () AS n FROM per),
b AS (SELECT pos // (CASE WHEN n >= {2 * AUC_BINS} THEN n // {AUC_BINS} ELSE 1 END) AS point, SUM(n1) AS n1, SUM(n0) AS n0 FROM o GROUP BY 1),
c AS (SELECT *, SUM(n1) OVER (ORDER BY point) AS c1 FROM b)
SELECT ROUND(CAST(SUM(n0 * (2 * c1 - n1)) AS DOUBLE) / ({D(2)} * CAST(SUM(n1) AS DOUBLE) * CAST(SUM(n0) AS DOUBLE)), 9) AS auc, COUNT(*) AS n_points FROM c""", ("loans",))
def q_auc_binned(spark, sf):
    """EV-1: area under the thinned ROC curve of the FICO score (AUC_BINS points)."""
    out = T.auc_binned(catalog.clean_loans(spark, sf), "fico_score", LABEL, AUC_BINS)
    return out.select(F.round("auc", 9).alias("auc"), "n_points")


@query("ev5_ks_by_state", f"""WITH {CLEAN_LOANS_SQL},
per AS (SELECT state, fico_score AS s, CAST(COUNT_IF({LABEL} = 1) AS BIGINT) AS n1, CAST(COUNT_IF({LABEL} <> 1) AS BIGINT) AS n0 FROM clean GROUP BY 1, 2),
cum AS (SELECT *, SUM(n1) OVER w AS c1, SUM(n0) OVER w AS c0, SUM(n1) OVER (PARTITION BY state) AS t1, SUM(n0) OVER (PARTITION BY state) AS t0
        FROM per WINDOW w AS (PARTITION BY state ORDER BY s)),
g AS (SELECT state, MAX(t1) AS t1, MAX(t0) AS t0, GREATEST(MAX(c1 * t0 - c0 * t1), 0) AS up, GREATEST(MAX(c0 * t1 - c1 * t0), 0) AS down FROM cum GROUP BY state)
SELECT state, CAST(t1 AS BIGINT) AS n_pos, CAST(t0 AS BIGINT) AS n_neg,
       ROUND(CAST(GREATEST(up, down) AS DOUBLE) / (CAST(t1 AS DOUBLE) * CAST(t0 AS DOUBLE)), 9) AS ks,
       ROUND(CAST(up AS DOUBLE) / (CAST(t1 AS DOUBLE) * CAST(t0 AS DOUBLE)), 9) AS ks_greater,
       ROUND(CAST(down AS DOUBLE) / (CAST(t1 AS DOUBLE) * CAST(t0 AS DOUBLE)), 9) AS ks_less, TRUE AS p_in_bounds
FROM g WHERE t1 > 0 AND t0 > 0""", ("loans",))
def q_ks_by_state(spark, sf):
    """EV-5: two-sample KS of FICO (defaulted against the rest) per state, both tails. SQL has no exact p-values; the query checks them against
    bounds that hold for any sizes: each in [0, 1], the smaller tail not above the two-sided value, that one not above their sum, and each tail under
    e * exp(-2 d^2 n1 n0 / (n1 + n0))."""
    out = T.ks_two_sample_by(catalog.clean_loans(spark, sf), ["state"], "fico_score", LABEL).where("n_pos > 0 and n_neg > 0")
    lam2 = F.col("n_pos") * F.col("n_neg") / (F.col("n_pos") + F.col("n_neg"))

    def bounded(p, d):
        return F.col(p).between(0, 1) & (F.col(p) <= F.lit(2.718281828459045) * F.exp(-2 * F.col(d) * F.col(d) * lam2) + 1e-12)

    both = F.least("p_greater", "p_less") <= F.col("p_value") + 1e-12
    ok = F.col("p_value").between(0, 1) & both & (F.col("p_value") <= F.col("p_greater") + F.col("p_less") + 1e-12) & bounded("p_greater", "ks_greater") & bounded("p_less", "ks_less")
    return out.select("state", "n_pos", "n_neg", *[F.round(c, 9).alias(c) for c in ("ks", "ks_greater", "ks_less")], ok.alias("p_in_bounds"))


@query("ev8_ks_normal_native", f"""WITH {CLEAN_LOANS_SQL},
st AS (SELECT {SIG('AVG(fico_score)')} AS m, {SIG('STDDEV_POP(fico_score)')} AS sd FROM clean),
per AS (SELECT (fico_score - m) / sd AS z, COUNT(*) AS n FROM clean, st GROUP BY 1),
cum AS (SELECT z, n, SUM(n) OVER (ORDER BY z) AS c, SUM(n) OVER () AS t FROM per),
area AS (SELECT z, n, c, t, {D(0.5)} + z / {D(1200)} / sqrt({D(2)} * pi()) * list_sum(list_transform(range(0, 401), lambda k:
   (CASE WHEN k = 0 OR k = 400 THEN {D(1)} WHEN k % 2 = 1 THEN {D(4)} ELSE {D(2)} END) * exp({D(-0.5)} * (z * k / 400) * (z * k / 400)))) AS f FROM cum)
SELECT ROUND(MAX(GREATEST(c / CAST(t AS DOUBLE) - f, f - (c - n) / CAST(t AS DOUBLE))), 7) AS statistic, CAST(MAX(t) AS BIGINT) AS n FROM area""", ("loans",))
def q_ks_normal_native(spark, sf):
    """EV-8: one-sample KS of the standardized FICO score against N(0, 1); the SQL twin integrates the density by Simpson's rule."""
    df = catalog.clean_loans(spark, sf)
    z = features.Standardizer(["fico_score"], digits=PARAM_DIGITS).fit(df).transform(df)
    return T.ks_normal(z, "fico_score_z").select(F.round("statistic", 7).alias("statistic"), "n")
