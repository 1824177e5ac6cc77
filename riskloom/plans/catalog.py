"""Registered queries: each is a Spark plan over the driver tables plus, where SQL can
express it, the same query as DuckDB SQL (the correctness oracle).

Query names are the inventory ID in lower case plus a word. Every query reads the whole
driver tables (through the ``loans`` / ``bureau`` views); none caps or samples rows
except where the limit is the feature (``snk2_sample_100``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions import columns as C
from riskloom.operators import contract, drift, etl, features, governance, metrics, ranks, splits, weights
from riskloom.plans import scorecards as S
from riskloom.session import ensure_checkpoint_dir
from riskloom.sources import policy, tables
from riskloom.sources.tables import with_views_sql

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}

D = "CAST({} AS DOUBLE)".format  # DuckDB reads 0.5 as DECIMAL: cast every literal used in float math


#: Significant digits of fitted means and sds in the queries compared with SQL: the last bits of a mean differ by engine.
PARAM_DIGITS = 10


def SIG(x: str) -> str:
    """SQL twin of ``features.round_param`` with ``PARAM_DIGITS``."""
    return f"(CASE WHEN {x} = 0 THEN {x} ELSE ROUND({x}, CAST({PARAM_DIGITS - 1} - FLOOR(LOG10(ABS({x}))) AS INTEGER)) END)"


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = (fn, with_views_sql(sql, *views) if sql else None)
        return fn
    return deco


# --------------------------------------------------------------------------- shared inputs

def clean_loans(spark: SparkSession, sf: str) -> DataFrame:
    return etl.loan_etl(tables.loans(spark, sf))


CLEAN_LOANS_SQL = """clean AS (
  SELECT *, monthly_income * tenure_months / 12 - loan_amount AS cltv,
    CASE WHEN credit_utilization < 0.3 THEN 'Low' WHEN credit_utilization < 0.6 THEN 'Medium' ELSE 'High' END AS util_bin,
    CAST(loan_status_flag = 1 AS INT) AS delinq_flag,
    CASE WHEN fico_score < 580 OR plan_type = 'Business' OR has_bankruptcy = 1 THEN 1 ELSE 0 END AS high_risk_flag
  FROM loans
  WHERE fico_score IS NOT NULL AND loan_amount IS NOT NULL AND monthly_income IS NOT NULL AND loan_status_flag IS NOT NULL)"""


def bureau_split(spark: SparkSession, sf: str) -> DataFrame:
    return splits.with_time_split(tables.bureau(spark, sf), "snapshot_date", S.BUREAU_TRAIN, S.BUREAU_VALID)


BUREAU_SPLIT_SQL = f"""bs AS (
  SELECT *, CASE WHEN snapshot_date BETWEEN DATE '{S.BUREAU_TRAIN[0]}' AND DATE '{S.BUREAU_TRAIN[1]}' THEN 'train'
                 WHEN snapshot_date BETWEEN DATE '{S.BUREAU_VALID[0]}' AND DATE '{S.BUREAU_VALID[1]}' THEN 'valid' END AS split
  FROM bureau)"""


# --------------------------------------------------------------------------- step 1: loan ETL

@query("agg5_default_rate_by_util_bin", f"""WITH {CLEAN_LOANS_SQL}
SELECT util_bin, COUNT(*) AS n, CAST(COUNT_IF(loan_status_flag = 1) AS BIGINT) AS n_default,
       ROUND(CAST(COUNT_IF(loan_status_flag = 1) AS BIGINT) / COUNT(*), 9) AS default_rate
FROM clean GROUP BY util_bin""", ("loans",))
def q_default_rate_by_util_bin(spark, sf):
    """Flagship: loan ETL -> rows, defaults and default rate per utilization bin."""
    return etl.default_rate_by(clean_loans(spark, sf), "util_bin")


@query("prj_loan_features", f"""WITH {CLEAN_LOANS_SQL}
SELECT loan_id, customer_id, fico_score, loan_amount, tenure_months, state, plan_type, monthly_income,
  CAST(date_issued AS DATE) AS issue_date, loan_status, loan_status_flag, credit_utilization, has_bankruptcy,
  cltv, util_bin,
  CASE WHEN credit_utilization < 0.3 THEN 0 WHEN credit_utilization < 0.7 THEN 1 ELSE 2 END AS util_bin_index,
  delinq_flag, high_risk_flag,
  ROUND(LN(1 + GREATEST(loan_amount, {D(0)})), 9) AS loan_amount_log
FROM clean""", ("loans",))
def q_loan_features(spark, sf):
    """PRJ-1..7, 15, 17 on every cleaned loan row."""
    df = clean_loans(spark, sf)
    return df.select(
        "loan_id", "customer_id", "fico_score", "loan_amount", "tenure_months", "state", "plan_type",
        "monthly_income", C.parse_date("date_issued").alias("issue_date"), "loan_status", "loan_status_flag",
        "credit_utilization", "has_bankruptcy", "cltv", "util_bin",
        C.util_bin_index("credit_utilization").alias("util_bin_index"), "delinq_flag", "high_risk_flag",
        F.round(C.safe_log1p("loan_amount"), 9).alias("loan_amount_log"),
    )


@query("flt1_basic_clean", """SELECT loan_id, customer_id, COALESCE(fico_score, 600) AS fico_score, loan_amount,
  tenure_months, state, plan_type, monthly_income, date_issued, loan_status,
  CASE WHEN loan_status = 'Default' THEN 1 ELSE 0 END AS loan_status_flag, credit_utilization, has_bankruptcy
FROM loans
WHERE loan_status IS NOT NULL AND credit_utilization IS NOT NULL AND loan_amount IS NOT NULL
  AND monthly_income IS NOT NULL AND tenure_months IS NOT NULL AND state IS NOT NULL AND date_issued IS NOT NULL""",
       ("loans",))
def q_basic_clean(spark, sf):
    """PRJ-1 + PRJ-2 + FLT-1: impute FICO 600, label from status text, drop rows with any NULL."""
    return etl.basic_clean(tables.loans(spark, sf))


@query("agg1_class_balance", """SELECT loan_status_flag, COUNT(*) AS n FROM loans GROUP BY loan_status_flag""",
       ("loans",))
def q_class_balance(spark, sf):
    """AGG-1 on the raw loans (the NULL label is its own group)."""
    return etl.class_balance(tables.loans(spark, sf))


_LOAN_COLS = ["loan_id", "customer_id", "fico_score", "loan_amount", "tenure_months", "state", "plan_type",
              "monthly_income", "date_issued", "loan_status", "loan_status_flag", "credit_utilization",
              "has_bankruptcy"]


@query("flt5_null_profile", "SELECT COUNT(*) AS n_rows, " + ", ".join(
    f"CAST(COUNT_IF({c} IS NULL{' OR isnan(' + c + ')' if c in ('fico_score', 'loan_amount', 'monthly_income', 'credit_utilization') else ''}) AS BIGINT) AS null_{c}"
    for c in _LOAN_COLS) + " FROM loans", ("loans",))
def q_null_profile(spark, sf):
    """FLT-5: NULL (and NaN) count of every loan column in one aggregate."""
    return etl.null_profile(tables.loans(spark, sf), _LOAN_COLS)


@query("snk2_sample_100", f"""WITH {CLEAN_LOANS_SQL}
SELECT loan_id, fico_score, loan_amount, cltv, util_bin, delinq_flag, high_risk_flag FROM clean ORDER BY loan_id LIMIT 100""",
       ("loans",))
def q_sample_100(spark, sf):
    """SNK-2/SNK-6/SRT-3: the exploration sample: first 100 cleaned loans by key (limit is the feature)."""
    return etl.preview(clean_loans(spark, sf),
                       ["loan_id", "fico_score", "loan_amount", "cltv", "util_bin", "delinq_flag", "high_risk_flag"],
                       100, ["loan_id"])


# --------------------------------------------------------------------------- step 2: weights, splits

@query("cw_class_weights", f"""WITH {CLEAN_LOANS_SQL},
c AS (SELECT loan_status_flag, COUNT(*) AS n FROM clean GROUP BY loan_status_flag),
t AS (SELECT CAST(SUM(n) AS BIGINT) AS tot, MAX(n) AS mx, CAST(SUM(CASE WHEN loan_status_flag = 1 THEN n ELSE 0 END) AS BIGINT) AS n1,
             CAST(SUM(CASE WHEN loan_status_flag = 0 THEN n ELSE 0 END) AS BIGINT) AS n0, COUNT(*) AS k FROM c)
SELECT loan_status_flag, n,
  ROUND(mx / n, 12) AS w_majority,
  ROUND(CASE WHEN loan_status_flag = 1 THEN n0 / CAST(n1 AS DOUBLE) ELSE {D(1)} END, 12) AS w_neg_pos,
  ROUND(tot / n, 12) AS w_total_over_count,
  ROUND(CASE WHEN loan_status_flag = 1 THEN {D(1)} - n1 / tot ELSE n1 / tot END, 12) AS w_complement,
  ROUND(CASE WHEN loan_status_flag = 1 THEN {D(4)} ELSE {D(1)} END, 12) AS w_fixed_4_1,
  ROUND(CASE WHEN loan_status_flag = 1 THEN {D(3)} ELSE {D(1)} END, 12) AS w_fixed_3_1,
  ROUND(CASE WHEN loan_status_flag = 1 THEN {D(5)} ELSE {D(1)} END, 12) AS w_fixed_5_1,
  ROUND(tot / (k * n), 12) AS w_balanced
FROM c, t""", ("loans",))
def q_class_weights(spark, sf):
    """CW-1..8: weight of each class under every scheme."""
    return weights.class_table(clean_loans(spark, sf), "loan_status_flag")


@query("cw1_weighted_sums", f"""WITH {CLEAN_LOANS_SQL},
c AS (SELECT loan_status_flag, COUNT(*) AS n FROM clean GROUP BY loan_status_flag),
w AS (SELECT loan_status_flag, MAX(n) OVER () / n AS wt FROM c)
SELECT clean.loan_status_flag, COUNT(*) AS n, ROUND(SUM(wt), 6) AS weight_sum, ROUND(AVG(wt), 9) AS avg_weight
FROM clean JOIN w ON clean.loan_status_flag = w.loan_status_flag GROUP BY clean.loan_status_flag""", ("loans",))
def q_weighted_sums(spark, sf):
    """CW-1 applied to rows + AGG-3: per class, rows, sum and mean of the row weights."""
    w = weights.with_class_weight(clean_loans(spark, sf), "loan_status_flag", "majority", "wt")
    return w.groupBy("loan_status_flag").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("wt"), 6).alias("weight_sum"),
                                             F.round(F.avg("wt"), 9).alias("avg_weight"))


@query("spl1_hash_split", f"""WITH {CLEAN_LOANS_SQL}
SELECT CASE WHEN CAST(('0x' || SUBSTR(MD5(CAST(loan_id AS STRING)), 1, 4)) AS INT) % 100 < 80 THEN 'train' ELSE 'test' END AS split,
       loan_status_flag, COUNT(*) AS n
FROM clean GROUP BY 1, 2""", ("loans",))
def q_hash_split(spark, sf):
    """SPL-1: stable 80/20 split on md5 of the key; rows per split and class."""
    df = splits.with_hash_split(clean_loans(spark, sf), "loan_id")
    return df.groupBy("split", "loan_status_flag").agg(F.count(F.lit(1)).alias("n"))


@query("spl2_time_split", f"""WITH {BUREAU_SPLIT_SQL}
SELECT split, COUNT(*) AS n, CAST(COUNT_IF(defaulted = 1) AS BIGINT) AS n_default, MIN(snapshot_date) AS first_date,
       MAX(snapshot_date) AS last_date
FROM bs GROUP BY split""", ("bureau",))
def q_time_split(spark, sf):
    """SPL-2/FLT-6: out-of-time windows (inclusive); rows outside both windows get a NULL split."""
    return bureau_split(spark, sf).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("defaulted") == 1).alias("n_default"),
        F.min("snapshot_date").alias("first_date"), F.max("snapshot_date").alias("last_date"),
    )


# --------------------------------------------------------------------------- step 3: ranks and metrics

@query("ev4_ks_decile", f"""WITH {CLEAN_LOANS_SQL},
t AS (SELECT loan_status_flag AS y, NTILE(10) OVER (ORDER BY fico_score DESC, loan_id) AS decile FROM clean),
p AS (SELECT CAST(decile AS INT) AS decile, CAST(COUNT_IF(y = 1) AS BIGINT) AS bads, CAST(COUNT_IF(y = 0) AS BIGINT) AS goods FROM t GROUP BY decile),
r AS (SELECT *, CAST(SUM(bads) OVER (ORDER BY decile ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum_bads,
              CAST(SUM(goods) OVER (ORDER BY decile ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum_goods,
              CAST(SUM(bads) OVER () AS DOUBLE) AS tb, CAST(SUM(goods) OVER () AS DOUBLE) AS tg FROM p)
SELECT decile, bads, goods, cum_bads, cum_goods, ROUND(cum_bads / tb, 9) AS cum_bad_pct,
       ROUND(cum_goods / tg, 9) AS cum_good_pct, ROUND(cum_bads / tb - cum_goods / tg, 9) AS ks FROM r""", ("loans",))
def q_ks_decile(spark, sf):
    """EV-4 / WIN-1 / AGG-5 / WIN-2 / SRT-1: decile table by descending score (FICO), key tie-break."""
    return metrics.decile_table(clean_loans(spark, sf), "fico_score", "loan_status_flag", "loan_id")


@query("ev4_ks_decile_max", f"""WITH {CLEAN_LOANS_SQL},
t AS (SELECT loan_status_flag AS y, NTILE(10) OVER (ORDER BY fico_score DESC, loan_id) AS decile FROM clean),
p AS (SELECT decile, CAST(COUNT_IF(y = 1) AS BIGINT) AS bads, CAST(COUNT_IF(y = 0) AS BIGINT) AS goods FROM t GROUP BY decile),
r AS (SELECT SUM(bads) OVER (ORDER BY decile ROWS UNBOUNDED PRECEDING) / CAST(SUM(bads) OVER () AS DOUBLE)
           - SUM(goods) OVER (ORDER BY decile ROWS UNBOUNDED PRECEDING) / CAST(SUM(goods) OVER () AS DOUBLE) AS ks FROM p)
SELECT MAX(ROUND(ks, 9)) AS ks_decile FROM r""", ("loans",))
def q_ks_decile_max(spark, sf):
    """EV-4 + AGG-7: the signed KS by deciles (max over the decile table)."""
    return metrics.ks_decile(clean_loans(spark, sf), "fico_score", "loan_status_flag", "loan_id")


_SCORE_COUNTS = """per AS (SELECT CAST(fico_score AS DOUBLE) AS s, CAST(COUNT_IF(loan_status_flag = 1) AS BIGINT) AS n1,
                     CAST(COUNT_IF(loan_status_flag <> 1) AS BIGINT) AS n0 FROM clean GROUP BY 1),
cum AS (SELECT *, SUM(n1) OVER (ORDER BY s ROWS UNBOUNDED PRECEDING) AS c1,
                  SUM(n0) OVER (ORDER BY s ROWS UNBOUNDED PRECEDING) AS c0,
                  SUM(n1) OVER () AS t1, SUM(n0) OVER () AS t0 FROM per)"""


@query("ev3_auc_exact", f"""WITH {CLEAN_LOANS_SQL}, {_SCORE_COUNTS}
SELECT ROUND(CAST(SUM(CAST(n1 AS HUGEINT) * (2 * (c0 - n0) + n0)) AS DOUBLE) / ({D(2)} * CAST(MAX(t1) AS DOUBLE) * CAST(MAX(t0) AS DOUBLE)), 9) AS auc,
       CAST(MAX(t1) AS BIGINT) AS n_pos, CAST(MAX(t0) AS BIGINT) AS n_neg FROM cum""", ("loans",))
def q_auc_exact(spark, sf):
    """EV-3: exact AUC with ties (rank-sum over distinct scores), score = FICO."""
    return metrics.auc_exact(clean_loans(spark, sf), "fico_score", "loan_status_flag")


def _kolmogorov_sql(lam: str) -> str:
    alt = (f"list_sum(list_transform(range(1, 101), lambda k: {D(2)} * pow({D(-1)}, k - 1) * "
           f"exp({D(-2)} * k * k * {lam} * {lam})))")
    theta = (f"({D(1)} - sqrt({D(2)} * pi()) / {lam} * list_sum(list_transform(range(1, 101), lambda k: "
             f"exp(-pow({D(2)} * k - 1, 2) * {D(repr(3.141592653589793 ** 2))} / ({D(8)} * {lam} * {lam})))))")
    raw = f"CASE WHEN {lam} <= 0 THEN {D(1)} WHEN {lam} < 1 THEN {theta} ELSE {alt} END"
    return f"LEAST(GREATEST({raw}, {D(0)}), {D(1)})"


@query("ev5_ks_exact", f"""WITH {CLEAN_LOANS_SQL}, {_SCORE_COUNTS},
d AS (SELECT MAX(ABS(c1 / CAST(t1 AS DOUBLE) - c0 / CAST(t0 AS DOUBLE))) AS d, CAST(MAX(t1) AS BIGINT) AS n_pos,
             CAST(MAX(t0) AS BIGINT) AS n_neg FROM cum),
l AS (SELECT *, d * sqrt(n_pos * n_neg / CAST(n_pos + n_neg AS DOUBLE)) AS lam FROM d)
SELECT ROUND(d, 9) AS ks, ROUND({_kolmogorov_sql('lam')}, 6) AS p_value, n_pos, n_neg FROM l""", ("loans",))
def q_ks_exact(spark, sf):
    """EV-5: two-sample KS (label 1 vs 0 scores) with the asymptotic p-value."""
    return metrics.ks_exact(clean_loans(spark, sf), "fico_score", "loan_status_flag")


@query("win3_roc_points", f"""WITH {CLEAN_LOANS_SQL}, {_SCORE_COUNTS}
SELECT s AS score, n1, n0, CAST(c1 AS BIGINT) AS cum_n1, CAST(c0 AS BIGINT) AS cum_n0,
       ROUND({D(1)} - (c1 - n1) / CAST(t1 AS DOUBLE), 9) AS tpr, ROUND({D(1)} - (c0 - n0) / CAST(t0 AS DOUBLE), 9) AS fpr
FROM cum""", ("loans",))
def q_roc_points(spark, sf):
    """WIN-3: ROC / KS curve per distinct score: share of each class at or above the score."""
    counts = metrics.score_counts(clean_loans(spark, sf), "fico_score", "loan_status_flag")
    cum = ranks.with_prefix_sums(counts, [F.col("score").asc()], ["n1", "n0"])
    return cum.select(
        "score", "n1", "n0", "cum_n1", "cum_n0",
        F.round(F.lit(1.0) - (F.col("cum_n1") - F.col("n1")) / F.col("total_n1").cast("double"), 9).alias("tpr"),
        F.round(F.lit(1.0) - (F.col("cum_n0") - F.col("n0")) / F.col("total_n0").cast("double"), 9).alias("fpr"),
    )


def _qcut_ctes(source: str, score: str, label: str, q: int, p: str = "q") -> str:
    """CTEs {p}e, {p}b, {p}t, {p}u: edges, buckets, per-bucket table, running sums."""
    probs = ", ".join(repr(i / q) for i in range(q + 1))
    return f"""{p}e AS (SELECT list_sort(list_distinct(quantile_cont({score}, [{probs}]::DOUBLE[]))) AS edges FROM {source}),
{p}b AS (SELECT {score} AS sc, {label} AS y, CAST(len(list_filter(edges[2:len(edges) - 1], lambda c: c < {score})) AS INTEGER) AS bucket
      FROM {source}, {p}e),
{p}t AS (SELECT bucket, COUNT(*) AS n, CAST(SUM(y) AS BIGINT) AS events, AVG(sc) AS avg_score FROM {p}b GROUP BY bucket),
{p}u AS (SELECT *, SUM(events) OVER (ORDER BY bucket ROWS UNBOUNDED PRECEDING) AS cum_events,
              SUM(n - events) OVER (ORDER BY bucket ROWS UNBOUNDED PRECEDING) AS cum_non_events,
              SUM(events) OVER () AS total_events, SUM(n) OVER () AS total_rows FROM {p}t)"""


def _ks_from_qcut() -> str:
    """KS over the running sums of the ``{p}u`` CTE (absolute max, 1e-9 guards)."""
    return "ROUND(MAX(ABS(cum_events / (total_events + 1e-9) - cum_non_events / ((total_rows - total_events) + 1e-9))), 9)"


@query("ev7_ks_qcut", f"""WITH {CLEAN_LOANS_SQL}, {_qcut_ctes('clean', 'fico_score', 'loan_status_flag', 20)}
SELECT {_ks_from_qcut()} AS ks_qcut FROM qu""", ("loans",))
def q_ks_qcut(spark, sf):
    """EV-7 / WIN-4 / AGG-8 / WIN-5: KS over 20 right-closed quantile buckets (duplicate edges dropped)."""
    return metrics.ks_qcut(clean_loans(spark, sf), "fico_score", "loan_status_flag", 20)


_SCORED_VALID_SQL = f"""{BUREAU_SPLIT_SQL},
sv AS (SELECT customer_id, defaulted, ROUND({S.pd_sql()}, 9) AS pd FROM bs WHERE split = 'valid')"""


@query("ev11_calibration", f"""WITH {_SCORED_VALID_SQL}, {_qcut_ctes('sv', 'pd', 'defaulted', 10)}
SELECT bucket, n, events, ROUND(avg_score, 9) AS mean_predicted, ROUND(events / n, 9) AS observed_rate,
       ROUND(avg_score - events / n, 9) AS gap FROM qu""", ("bureau",))
def q_calibration(spark, sf):
    """EV-11: reported PD (9 digits, as in the decisions) vs observed default rate per PD decile
    (validation window)."""
    sv = bureau_split(spark, sf).where(F.col("split") == "valid").select(
        "customer_id", "defaulted", F.round(C.sigmoid(S.z_expr()), 9).alias("pd"))
    return metrics.calibration(sv, "pd", "defaulted", 10)


# --------------------------------------------------------------------------- step 4: drift

def _psi_ctes(stacked: str, bins: int = 10, p: str = "p") -> str:
    """CTEs ending in {p}psi (feature, psi, n_expected, n_actual)."""
    probs = ", ".join(repr(i / bins) for i in range(bins + 1))
    return f"""{p}cuts AS (SELECT feature, quantile_cont(value, [{probs}]::DOUBLE[]) AS cuts FROM {stacked} WHERE period = 'expected' GROUP BY feature),
{p}binned AS (SELECT s.feature, s.period, len(list_filter(cuts[2:{bins}], lambda c: s.value >= c)) AS bin
           FROM {stacked} s JOIN {p}cuts c ON s.feature = c.feature WHERE s.period IN ('expected', 'actual')),
{p}grid AS (SELECT feature, bin FROM {p}cuts, range(0, {bins}) r(bin)),
{p}cnt AS (SELECT g.feature, g.bin, CAST(COUNT_IF(b.period = 'expected') AS BIGINT) AS e, CAST(COUNT_IF(b.period = 'actual') AS BIGINT) AS a
        FROM {p}grid g LEFT JOIN {p}binned b ON g.feature = b.feature AND g.bin = b.bin GROUP BY g.feature, g.bin),
{p}sh AS (SELECT *, e / (SUM(e) OVER (PARTITION BY feature) + 1e-9) AS ep, a / (SUM(a) OVER (PARTITION BY feature) + 1e-9) AS ap,
              SUM(e) OVER (PARTITION BY feature) AS ne, SUM(a) OVER (PARTITION BY feature) AS na FROM {p}cnt),
{p}psi AS (SELECT feature, ROUND(SUM((ap - ep) * LN((ap + 1e-9) / (ep + 1e-9))), 9) AS psi, CAST(MAX(ne) AS BIGINT) AS n_expected,
       CAST(MAX(na) AS BIGINT) AS n_actual FROM {p}sh GROUP BY feature)"""


def _stack_sql(features_: list[str]) -> str:
    parts = [f"SELECT CASE split WHEN 'train' THEN 'expected' WHEN 'valid' THEN 'actual' END AS period, '{f}' AS feature, "
             f"CAST({f} AS DOUBLE) AS value FROM bs WHERE split IS NOT NULL AND {f} IS NOT NULL AND NOT isnan(CAST({f} AS DOUBLE))"
             for f in features_]
    return "st AS (" + " UNION ALL ".join(parts) + ")"


@query("drf1_psi_income", f"""WITH {BUREAU_SPLIT_SQL}, {_stack_sql(['income'])}, {_psi_ctes('st')}
SELECT * FROM ppsi""", ("bureau",))
def q_psi_income(spark, sf):
    """DRF-1: PSI of income, validation window against the training window, 10 bins."""
    bs = bureau_split(spark, sf)
    stacked = drift.stack_features(
        bs, ["income"], F.when(F.col("split") == "train", "expected").when(F.col("split") == "valid", "actual"))
    return drift.psi_by_feature(stacked)


@query("drf3_psi_features", f"""WITH {BUREAU_SPLIT_SQL}, {_stack_sql(policy.NUMERIC_FEATURES + policy.PASSTHROUGH_FEATURES)},
{_psi_ctes('st')}
SELECT * FROM ppsi""", ("bureau",))
def q_psi_features(spark, sf):
    """DRF-3: PSI of every numeric feature in one pass over a stacked table."""
    bs = bureau_split(spark, sf)
    stacked = drift.stack_features(
        bs, policy.NUMERIC_FEATURES + policy.PASSTHROUGH_FEATURES,
        F.when(F.col("split") == "train", "expected").when(F.col("split") == "valid", "actual"))
    return drift.psi_by_feature(stacked)


@query("drf2_psi_score", f"""WITH {BUREAU_SPLIT_SQL},
st AS (SELECT CASE split WHEN 'train' THEN 'expected' ELSE 'actual' END AS period, 'pd' AS feature, ROUND({S.pd_sql()}, 9) AS value
       FROM bs WHERE split IS NOT NULL), {_psi_ctes('st')}
SELECT * FROM ppsi""", ("bureau",))
def q_psi_score(spark, sf):
    """DRF-2: PSI of the reported score (PD to 9 digits, as in the decisions), valid vs train window."""
    bs = bureau_split(spark, sf).where(F.col("split").isNotNull())
    # stacked through stack_features (explode): a literal feature column would let the
    # optimizer fold the feature join key and plan a nested-loop join
    scored = bs.withColumn("pd", F.round(C.sigmoid(S.z_expr()), 9))
    stacked = drift.stack_features(
        scored, ["pd"], F.when(F.col("split") == "train", "expected").otherwise("actual"))
    return drift.psi_by_feature(stacked)


# --------------------------------------------------------------------------- step 5: governance

def _contract_sql() -> str:
    parts = []
    for name, ftype, required, lo, hi, allowed, fmt in policy.CONTRACT_FIELDS:
        if required:
            parts.append((name, "required", f"{name} IS NULL"))
        if lo is not None:
            parts.append((name, "min", f"{name} < {lo}"))
        if hi is not None:
            parts.append((name, "max", f"{name} > {hi}"))
        if allowed is not None:
            vals = ", ".join(repr(v) for v in allowed)
            parts.append((name, "allowed", f"{name} IS NOT NULL AND {name} NOT IN ({vals})"))
    sel = " UNION ALL ".join(
        f"SELECT '{f}' AS field, '{r}' AS rule, CAST(COUNT_IF({p}) AS BIGINT) AS violations, "
        f"CAST(COUNT(*) AS BIGINT) AS n_rows FROM bureau" for f, r, p in parts)
    return sel


@query("gov1_contract", _contract_sql(), ("bureau",))
def q_contract(spark, sf):
    """GOV-1: every contract rule's violation count, one aggregate pass."""
    return contract.validate(tables.bureau(spark, sf))


@query("gov1_key_check", """WITH k AS (SELECT customer_id, COUNT(*) AS n FROM bureau GROUP BY customer_id)
SELECT CAST(COALESCE(SUM(CASE WHEN customer_id IS NULL THEN n ELSE 0 END), 0) AS BIGINT) AS null_keys,
       CAST(COUNT_IF(customer_id IS NOT NULL AND n > 1) AS BIGINT) AS duplicated_keys,
       CAST(COALESCE(SUM(CASE WHEN customer_id IS NOT NULL AND n > 1 THEN n ELSE 0 END), 0) AS BIGINT) AS rows_with_duplicated_key
FROM k""", ("bureau",))
def q_key_check(spark, sf):
    """GOV-1 primary key: NULL keys and duplicated keys."""
    return contract.key_summary(tables.bureau(spark, sf))


_REASON_SQL = "list_filter([" + ", ".join(
    f"CASE WHEN {feat} >= {D(repr(float(t)))} THEN '{r}' END" for r, _d, feat, t in policy.REASON_RULES) + "], lambda x: x IS NOT NULL)"


@query("gov3_reason_counts", " UNION ALL ".join(
    f"SELECT '{r}' AS reason, CAST(COUNT_IF({feat} >= {D(repr(float(t)))}) AS BIGINT) AS n FROM bureau"
    for r, _d, feat, t in policy.REASON_RULES), ("bureau",))
def q_reason_counts(spark, sf):
    """GOV-3: applicants per reason code."""
    return governance.reason_counts(tables.bureau(spark, sf))


@query("src8_policy_rule_counts", REGISTRY["gov3_reason_counts"][1])
def q_policy_rule_counts(spark, sf):
    """SRC-8 + GOV-3: the policy as rule rows (reason, description, feature, threshold), applied
    by a broadcast join of stacked feature values; applicants per reason."""
    return governance.reason_counts_from_rules(tables.bureau(spark, sf), policy.reason_rules(spark))


@query("gov4_decisions", f"""SELECT customer_id, '{S.MODEL_VERSION}' AS model_version, ROUND({S.pd_sql()}, 9) AS score,
  array_to_string({_REASON_SQL}, ',') AS reason_codes FROM bureau""", ("bureau",))
def q_decisions(spark, sf):
    """GOV-3 + GOV-4 + ML-7: per applicant model version, PD score and reason codes (comma-joined)."""
    coefs, intercept = S.SCORECARDS[S.DEFAULT_SCORECARD]
    d = governance.decisions(tables.bureau(spark, sf), "customer_id", coefs, intercept, S.MODEL_VERSION)
    return d.withColumn("reason_codes", F.array_join("reason_codes", ","))


def _auc_sql(source: str, score: str, label: str, name_sql: str) -> str:
    return f"""SELECT {name_sql} AS model, ROUND(CAST(SUM(CAST(n1 AS HUGEINT) * (2 * (c0 - n0) + n0)) AS DOUBLE)
        / ({D(2)} * CAST(MAX(t1) AS DOUBLE) * CAST(MAX(t0) AS DOUBLE)), 9) AS auc FROM (
  SELECT *, SUM(n1) OVER (ORDER BY s ROWS UNBOUNDED PRECEDING) AS c1, SUM(n0) OVER (ORDER BY s ROWS UNBOUNDED PRECEDING) AS c0,
            SUM(n1) OVER () AS t1, SUM(n0) OVER () AS t0
  FROM (SELECT {score} AS s, CAST(COUNT_IF({label} = 1) AS BIGINT) AS n1, CAST(COUNT_IF({label} <> 1) AS BIGINT) AS n0 FROM {source} GROUP BY 1))"""


def _scorecard_auc_rows(bs: DataFrame, split: str) -> DataFrame:
    """(model, auc) for every scorecard: one stacked (model, z, label) table, one ranking pass."""
    rows = bs.where(F.col("split") == split).select(
        "defaulted",
        F.explode(F.array(*[F.struct(F.lit(n).alias("model"), S.z_expr(n).alias("z")) for n in S.SCORECARDS])).alias("_m"),
    ).select(F.col("_m.model").alias("model"), F.col("_m.z").alias("z"), "defaulted")
    return metrics.auc_exact_by(rows, ["model"], "z", "defaulted").select("model", "auc")


@query("ml8_scorecard_auc", f"WITH {BUREAU_SPLIT_SQL}, v AS (SELECT * FROM bs WHERE split = 'valid')\n" + " UNION ALL ".join(
    _auc_sql("v", S.z_sql(n), "defaulted", f"'{n}'") for n in S.SCORECARDS), ("bureau",))
def q_scorecard_auc(spark, sf):
    """ML-8 (fixed scorecards): validation AUC of every candidate model, one row each."""
    return _scorecard_auc_rows(bureau_split(spark, sf), "valid")


@query("srt4_best_model", f"WITH {BUREAU_SPLIT_SQL}, v AS (SELECT * FROM bs WHERE split = 'valid'), a AS (" + " UNION ALL ".join(
    _auc_sql("v", S.z_sql(n), "defaulted", f"'{n}'") for n in S.SCORECARDS) + """)
SELECT arg_max(model, (auc, model)) AS best_model, MAX(auc) AS best_auc FROM a""", ("bureau",))
def q_best_model(spark, sf):
    """SRT-4: the candidate with the highest validation AUC (ties: larger name)."""
    return governance.best_by(_scorecard_auc_rows(bureau_split(spark, sf), "valid"), "model", "auc")


def metric_record(spark: SparkSession, sf: str) -> DataFrame:
    """EV-10: best model, AUC train/valid, KS (20 buckets) and PSI of its PD, one row.

    The scores of all candidates are computed once and frozen (window, label, a score per model).
    One grouped ranking pass gives the AUC of every candidate on both windows (the best is
    picked from the valid rows); KS and PSI are computed for the best one. The metrics are
    stacked as (metric, value) rows and turned into one wide row by a single aggregate (no
    join between one-row frames).
    """
    ensure_checkpoint_dir(spark)
    bs = bureau_split(spark, sf).where(F.col("split").isNotNull()).select(
        "split", "defaulted", *[S.z_expr(n).alias(f"z_{n}") for n in S.SCORECARDS]).checkpoint()
    stacked = bs.select(
        "split", "defaulted",
        F.explode(F.array(*[F.struct(F.lit(n).alias("model"), F.col(f"z_{n}").alias("z")) for n in S.SCORECARDS])).alias("_m"),
    ).select(F.col("_m.model").alias("model"), "split", F.col("_m.z").alias("z"), "defaulted")
    aucs = metrics.auc_exact_by(stacked, ["model", "split"], "z", "defaulted")
    best = governance.best_by(aucs.where(F.col("split") == "valid"), "model", "auc").first()["best_model"]
    valid = bs.where(F.col("split") == "valid").select(
        "defaulted", F.round(C.sigmoid(F.col(f"z_{best}")), 9).alias("pd"))
    scored = drift.stack_features(
        bs.withColumn("pd", F.round(C.sigmoid(F.col(f"z_{best}")), 9)), ["pd"],
        F.when(F.col("split") == "train", "expected").otherwise("actual"))
    parts = [
        aucs.where(F.col("model") == best).select(F.concat(F.lit("auc_"), F.col("split")).alias("metric"),
                                                 F.col("auc").alias("value")),
        metrics.ks_qcut(valid, "pd", "defaulted", 20).select(F.lit("ks_valid").alias("metric"), F.col("ks_qcut").alias("value")),
        drift.psi_by_feature(scored).select(F.lit("psi_valid_vs_train").alias("metric"), F.col("psi").alias("value")),
    ]
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    names = ["auc_train", "auc_valid", "ks_valid", "psi_valid_vs_train"]
    return long.agg(F.lit(best).alias("best_model"),
                    *[F.max(F.when(F.col("metric") == n, F.col("value"))).alias(n) for n in names])


def _metric_record_ctes() -> str:
    """CTEs ending in ``mr`` (best_model, auc_train, auc_valid, ks_valid, psi_valid_vs_train)."""
    cards = " UNION ALL ".join(_auc_sql("v", S.z_sql(n), "defaulted", f"'{n}'") for n in S.SCORECARDS)
    z_case = "CASE " + " ".join(f"WHEN best = '{n}' THEN {S.z_sql(n)}" for n in S.SCORECARDS) + " END"
    return f"""{BUREAU_SPLIT_SQL}, v AS (SELECT * FROM bs WHERE split = 'valid'), a AS ({cards}),
bm AS (SELECT arg_max(model, (auc, model)) AS best FROM a),
sc AS (SELECT split, defaulted, {z_case} AS z FROM bs, bm WHERE split IS NOT NULL),
scp AS (SELECT *, ROUND(CAST(1 AS DOUBLE) / (CAST(1 AS DOUBLE) + EXP(-z)), 9) AS pd FROM sc),
tr AS (SELECT * FROM scp WHERE split = 'train'), va AS (SELECT * FROM scp WHERE split = 'valid'),
atr AS ({_auc_sql('tr', 'z', 'defaulted', "'x'")}), ava AS ({_auc_sql('va', 'z', 'defaulted', "'x'")}),
{_qcut_ctes('va', 'pd', 'defaulted', 20)},
ks AS (SELECT {_ks_from_qcut()} AS ks_valid FROM qu),
st AS (SELECT CASE split WHEN 'train' THEN 'expected' ELSE 'actual' END AS period, 'pd' AS feature, pd AS value FROM scp),
{_psi_ctes('st')},
mr AS (SELECT bm.best AS best_model, atr.auc AS auc_train, ava.auc AS auc_valid, ks.ks_valid,
              ppsi.psi AS psi_valid_vs_train FROM bm, atr, ava, ks, ppsi)"""


@query("ev10_metric_record", f"WITH {_metric_record_ctes()}\nSELECT * FROM mr", ("bureau",))
def q_metric_record(spark, sf):
    """EV-10 + SRT-4 + DRF-2: best scorecard by validation AUC, its AUC train/valid, KS and PSI."""
    return metric_record(spark, sf)


@query("gov2_gate", f"""WITH {_metric_record_ctes()}
SELECT 'auc' AS metric, auc_valid AS value, {D(policy.GATE_AUC_MIN)} AS threshold, '>=' AS op, COALESCE(auc_valid >= {D(policy.GATE_AUC_MIN)}, false) AS passed FROM mr
UNION ALL SELECT 'ks', ks_valid, {D(policy.GATE_KS_MIN)}, '>=', COALESCE(ks_valid >= {D(policy.GATE_KS_MIN)}, false) FROM mr
UNION ALL SELECT 'psi', psi_valid_vs_train, {D(policy.GATE_PSI_MAX)}, '<', COALESCE(psi_valid_vs_train < {D(policy.GATE_PSI_MAX)}, false) FROM mr""",
       ("bureau",))
def q_gate(spark, sf):
    """GOV-2: the metric gate (AUC >= 0.65, KS >= 0.20, PSI < 0.10) on the metric record."""
    return governance.gate(metric_record(spark, sf)).drop("all_passed")


# --------------------------------------------------------------------------- step 6: features

@query("fe2_string_index", """SELECT state, COUNT(*) AS n,
  CAST(ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, state) - 1 AS INT) AS state_index FROM bureau GROUP BY state""",
       ("bureau",))
def q_string_index(spark, sf):
    """FE-2: frequency-ordered index of a category (most frequent = 0, ties by label)."""
    return features.frequency_index_table(tables.bureau(spark, sf), "state", "state_index")


@query("fe4_label_index", f"""WITH {CLEAN_LOANS_SQL}
SELECT loan_status_flag, COUNT(*) AS n,
  CAST(ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, loan_status_flag) - 1 AS INT) AS label_index
FROM clean GROUP BY loan_status_flag""", ("loans",))
def q_label_index(spark, sf):
    """FE-4: StringIndexer-style index of the label (0 = most frequent class); shows the class
    flip that makes the raw 0/1 label the safer choice."""
    return features.frequency_index_table(clean_loans(spark, sf), "loan_status_flag", "label_index")


@query("fe3_index_unseen", f"""WITH {BUREAU_SPLIT_SQL},
lv AS (SELECT employment_status AS level, CAST(ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, employment_status) - 1 AS INT) AS idx
       FROM bs WHERE split = 'train' AND employment_status IS NOT NULL GROUP BY employment_status)
SELECT v.customer_id, CAST(COALESCE(lv.idx, (SELECT COUNT(*) FROM lv)) AS INT) AS employment_status_index
FROM (SELECT * FROM bs WHERE split = 'valid') v LEFT JOIN lv ON lv.level = v.employment_status""", ("bureau",))
def q_index_unseen(spark, sf):
    """FE-3: frequency index fitted on train, applied to valid; unseen levels kept as index K."""
    bs = bureau_split(spark, sf)
    idx = features.FrequencyIndexer("employment_status").fit(bs.where(F.col("split") == "train"))
    return idx.transform(bs.where(F.col("split") == "valid")).select("customer_id", "employment_status_index")


_ONEHOT = {"employment_status": tables.EMPLOYMENT, "risk_segment": tables.SEGMENTS}


@query("fe5_onehot", f"""WITH {BUREAU_SPLIT_SQL}
SELECT customer_id, """ + ", ".join(
    f"COALESCE(CAST({c} = '{v}' AS DOUBLE), {D(0)}) AS {c}_{v}"
    for c, levels in _ONEHOT.items() for v in sorted(levels)) + """
FROM bs WHERE split = 'valid'""", ("bureau",))
def q_onehot(spark, sf):
    """FE-5/FE-6: one 0/1 column per level seen in the training window (alphabetical), applied to
    the validation window; an unseen level is all zeros. (The levels are those the bureau view
    defines, so the oracle lists them.)"""
    bs = bureau_split(spark, sf)
    enc = features.CategoryEncoder(list(_ONEHOT)).fit(bs.where(F.col("split") == "train"))
    return enc.transform_onehot(bs.where(F.col("split") == "valid")).select("customer_id", *enc.output_names())


@query("fe6_category_index", f"""WITH {BUREAU_SPLIT_SQL},
lv AS (SELECT feature, level, CAST(ROW_NUMBER() OVER (PARTITION BY feature ORDER BY level) - 1 AS INT) AS idx,
              COUNT(*) OVER (PARTITION BY feature) AS k
       FROM (SELECT DISTINCT 'state' AS feature, state AS level FROM bs WHERE split = 'train'
             UNION SELECT DISTINCT 'employment_status', employment_status FROM bs WHERE split = 'train'
             UNION SELECT DISTINCT 'risk_segment', risk_segment FROM bs WHERE split = 'train')),
kk AS (SELECT feature, MAX(k) AS k FROM lv GROUP BY feature)
SELECT v.customer_id,
  CAST(COALESCE(l1.idx, (SELECT k FROM kk WHERE feature = 'state')) AS INT) AS state_idx,
  CAST(COALESCE(l2.idx, (SELECT k FROM kk WHERE feature = 'employment_status')) AS INT) AS employment_status_idx,
  CAST(COALESCE(l3.idx, (SELECT k FROM kk WHERE feature = 'risk_segment')) AS INT) AS risk_segment_idx
FROM (SELECT * FROM bs WHERE split = 'valid') v
LEFT JOIN lv l1 ON l1.feature = 'state' AND l1.level = v.state
LEFT JOIN lv l2 ON l2.feature = 'employment_status' AND l2.level = v.employment_status
LEFT JOIN lv l3 ON l3.feature = 'risk_segment' AND l3.level = v.risk_segment""", ("bureau",))
def q_category_index(spark, sf):
    """FE-6/FE-8: alphabetical level index fitted on the training window, applied to the
    validation window; an unseen level gets index K (the all-zero one-hot slot)."""
    bs = bureau_split(spark, sf)
    enc = features.CategoryEncoder(policy.CATEGORICAL_FEATURES).fit(bs.where(F.col("split") == "train"))
    return enc.transform_index(bs.where(F.col("split") == "valid")).select(
        "customer_id", *[f"{c}_idx" for c in policy.CATEGORICAL_FEATURES])


#: Levels that the fit does not see, so that they are new in the validation rows.
_HELD_BACK = {"state": "NATION_3", "employment_status": sorted(tables.EMPLOYMENT)[0], "risk_segment": sorted(tables.SEGMENTS)[0]}


@query("fe6_unseen_levels", f"""WITH {BUREAU_SPLIT_SQL},
tr AS (SELECT * FROM bs WHERE split = 'train'),
""" + ",\n".join(
    f"l_{c} AS (SELECT {c} AS level, CAST(ROW_NUMBER() OVER (ORDER BY {c}) - 1 AS INT) AS idx, "
    f"CAST(ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, {c}) - 1 AS INT) AS freq, CAST(COUNT(*) OVER () AS INT) AS k "
    f"FROM tr WHERE {c} <> '{v}' GROUP BY {c})" for c, v in _HELD_BACK.items()) + """
SELECT v.customer_id, """ + ", ".join(
    f"COALESCE(l_{c}.idx, (SELECT MAX(k) FROM l_{c})) AS {c}_idx, "
    f"CASE WHEN l_{c}.idx IS NULL THEN 0 ELSE 1 END AS {c}_ones" for c in _HELD_BACK) + """,
  COALESCE(l_employment_status.freq, (SELECT MAX(k) FROM l_employment_status)) AS employment_status_index
FROM (SELECT * FROM bs WHERE split = 'valid') v """ + " ".join(
    f"LEFT JOIN l_{c} ON l_{c}.level = v.{c}" for c in _HELD_BACK), ("bureau",))
def q_unseen_levels(spark, sf):
    """FE-3/FE-5/FE-6: encoders fitted without one level of each category, applied to validation rows that have it:
    index K, an all-zero vector (``_ones`` counts the ones of the sparse vector)."""
    from pyspark.ml.functions import vector_to_array

    bs = bureau_split(spark, sf)
    train = bs.where(F.col("split") == "train")
    fit = train.select(*[F.when(F.col(c) != v, F.col(c)).alias(c) for c, v in _HELD_BACK.items()])
    enc = features.CategoryEncoder(list(_HELD_BACK)).fit(fit)
    idx = features.FrequencyIndexer("employment_status").fit(fit)
    valid = bs.where(F.col("split") == "valid").select("customer_id", *_HELD_BACK)
    out = enc.transform_vector(idx.transform(valid))
    ones = lambda c: F.aggregate(vector_to_array(f"{c}_vec"), F.lit(0.0), lambda a, x: a + x).cast("int")
    return out.select("customer_id", *[f"{c}_idx" for c in _HELD_BACK], *[ones(c).alias(f"{c}_ones") for c in _HELD_BACK],
                      "employment_status_index")


@query("fe7_standardize", f"""WITH {BUREAU_SPLIT_SQL},
st AS (SELECT {", ".join(f"{SIG(f'AVG({c})')} AS m_{c}, CASE WHEN STDDEV_POP({c}) = 0 OR STDDEV_POP({c}) IS NULL THEN {D(1)} ELSE {SIG(f'STDDEV_POP({c})')} END AS s_{c}" for c in policy.NUMERIC_FEATURES)}
       FROM bs WHERE split = 'train')
SELECT customer_id, {", ".join(f"({c} - m_{c}) / s_{c} AS {c}_z" for c in policy.NUMERIC_FEATURES)}
FROM bs, st WHERE split = 'valid'""", ("bureau",))
def q_standardize(spark, sf):
    """FE-7/FE-8: z-scores with the population sd (zero sd -> 1), fitted on train, applied to valid."""
    bs = bureau_split(spark, sf)
    sc = features.Standardizer(policy.NUMERIC_FEATURES, digits=PARAM_DIGITS).fit(bs.where(F.col("split") == "train"))
    out = sc.transform(bs.where(F.col("split") == "valid"))
    return out.select("customer_id", *[f"{c}_z" for c in policy.NUMERIC_FEATURES])


_LEAK_FEATURES = ["fico_score", "loan_amount", "tenure_months", "monthly_income", "credit_utilization",
                  "has_bankruptcy", "cltv", "high_risk_flag", "delinq_flag"]


@query("fe12_leakage_report", f"""WITH {CLEAN_LOANS_SQL}
""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, ROUND(CORR(CAST({c} AS DOUBLE), CAST(loan_status_flag AS DOUBLE)), 6) AS corr_with_label, "
    f"COALESCE(ABS(CORR(CAST({c} AS DOUBLE), CAST(loan_status_flag AS DOUBLE))) >= {D(0.99)}, false) AS leak FROM clean"
    for c in _LEAK_FEATURES), ("loans",))
def q_leakage(spark, sf):
    """FE-12: correlation of every candidate feature with the label; |corr| >= 0.99 is a leak."""
    return features.leakage_report(clean_loans(spark, sf), _LEAK_FEATURES, "loan_status_flag")


@query("fe9_feature_manifest", f"""WITH {BUREAU_SPLIT_SQL},
lv AS (SELECT DISTINCT 'state' AS source, state AS level, 1 AS o FROM bs WHERE split = 'train'
       UNION SELECT DISTINCT 'employment_status', employment_status, 2 FROM bs WHERE split = 'train'
       UNION SELECT DISTINCT 'risk_segment', risk_segment, 3 FROM bs WHERE split = 'train'),
al AS (SELECT source || '_' || level AS name, source, 'onehot' AS kind, o AS g, level AS sub FROM lv
       UNION ALL SELECT * FROM (VALUES {", ".join(f"('{c}', '{c}', 'numeric', 10, '{i:03d}')" for i, c in enumerate(policy.NUMERIC_FEATURES))},
                                       {", ".join(f"('{c}', '{c}', 'passthrough', 20, '{i:03d}')" for i, c in enumerate(policy.PASSTHROUGH_FEATURES))}) x(name, source, kind, g, sub))
SELECT CAST(ROW_NUMBER() OVER (ORDER BY g, sub) - 1 AS INT) AS position, name, source, kind FROM al""", ("bureau",))
def q_feature_manifest(spark, sf):
    """FE-9/FE-10: the design-matrix manifest (one-hot levels from train, numeric, passthrough)."""
    bs = bureau_split(spark, sf).where(F.col("split") == "train")
    return features.feature_manifest(bs, policy.CATEGORICAL_FEATURES, policy.NUMERIC_FEATURES,
                                     policy.PASSTHROUGH_FEATURES)


@query("agg9_quantiles", """SELECT risk_segment, CAST(UNNEST(range(0, 7)) AS INT) AS q_index,
  UNNEST([0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]::DOUBLE[]) AS prob,
  ROUND(UNNEST(quantile_cont(income, [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]::DOUBLE[])), 9) AS value
FROM bureau GROUP BY risk_segment""", ("bureau",))
def q_quantiles(spark, sf):
    """AGG-9: exact quantiles (linear interpolation) of income per risk segment."""
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    cuts = ranks.grouped_quantiles(tables.bureau(spark, sf), ["risk_segment"], "income", probs)
    return cuts.select(
        "risk_segment",
        F.posexplode(F.arrays_zip(F.array(*[F.lit(p) for p in probs]).alias("prob"), F.col("cuts").alias("value"))).alias("q_index", "pv"),
    ).select("risk_segment", F.col("q_index").cast("int"), F.col("pv.prob").alias("prob"),
             # 9 decimals: DuckDB interpolates with a more precise position than numpy / Spark,
             # which can move the last bit of an interpolated value
             F.round("pv.value", 9).alias("value"))


_HIST_CUTS = [0.2, 0.4, 0.6, 0.8]


@query("agg10_histogram", f"""SELECT CAST(len(list_filter([{", ".join(D(c) for c in _HIST_CUTS)}], lambda c: utilization_rate >= c)) AS INTEGER) AS bin,
  COUNT(*) AS n FROM bureau WHERE utilization_rate IS NOT NULL AND NOT isnan(utilization_rate) GROUP BY 1""", ("bureau",))
def q_histogram(spark, sf):
    """AGG-10: histogram of utilization over given cut points (left-closed bins)."""
    b = tables.bureau(spark, sf).where(F.col("utilization_rate").isNotNull() & ~F.isnan("utilization_rate"))
    return b.groupBy(drift.psi_bin(F.col("utilization_rate"), F.array(*[F.lit(x) for x in [float("-inf")] + _HIST_CUTS + [float("inf")]]), len(_HIST_CUTS) + 1).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------------------- step 7: attributions

_ATTR_COEFS, _ATTR_B = S.SCORECARDS[S.DEFAULT_SCORECARD]


@query("gov6_global_importance", f"""WITH {BUREAU_SPLIT_SQL},
m AS (SELECT {", ".join(f"{SIG(f'AVG({c})')} AS m_{c}" for c in _ATTR_COEFS)} FROM bs WHERE split = 'train'),
c AS (SELECT {", ".join(f"{D(repr(w))} * ({c} - m_{c}) AS c_{c}" for c, w in _ATTR_COEFS.items())} FROM bs, m WHERE split = 'valid')
""" + " UNION ALL ".join(f"SELECT '{c}' AS feature, ROUND(AVG(ABS(c_{c})), 9) AS mean_abs_contribution FROM c" for c in _ATTR_COEFS),
       ("bureau",))
def q_global_importance(spark, sf):
    """GOV-6: linear attributions coef * (x - train mean); global importance = mean |contribution|."""
    bs = bureau_split(spark, sf)
    att = features.LinearAttribution(_ATTR_COEFS, digits=PARAM_DIGITS).fit(bs.where(F.col("split") == "train"))
    return att.global_importance(bs.where(F.col("split") == "valid"))


@query("srt5_top_reasons", f"""WITH {BUREAU_SPLIT_SQL},
m AS (SELECT {", ".join(f"{SIG(f'AVG({c})')} AS m_{c}" for c in _ATTR_COEFS)} FROM bs WHERE split = 'train'),
c AS (SELECT customer_id, UNNEST([{", ".join(f"{{'feature': '{c}', 'contribution': {D(repr(w))} * ({c} - m_{c})}}" for c, w in _ATTR_COEFS.items())}]) AS x
      FROM bs, m WHERE split = 'valid'),
r AS (SELECT customer_id, x.feature AS feature, x.contribution AS contribution,
             ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY x.contribution DESC, x.feature) AS rk FROM c)
SELECT customer_id, CAST(rk AS INT) AS rank, feature, contribution FROM r WHERE rk <= 2""",
       ("bureau",))
def q_top_reasons(spark, sf):
    """SRT-5: the two features that push each applicant's score up the most (top-k is the feature)."""
    bs = bureau_split(spark, sf)
    att = features.LinearAttribution(_ATTR_COEFS, digits=PARAM_DIGITS).fit(bs.where(F.col("split") == "train"))
    return att.top_reasons(bs.where(F.col("split") == "valid"), "customer_id", 2)
