"""Reason codes, decisions, metric gate, audit events (GOV-2..5, SNK-5, SRT-4/5).

All row-level steps are projections: reason codes are an array built from one
``when`` per policy rule (the rule list is config of fixed size), so no join and no
shuffle is needed per applicant.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.columns import sigmoid, linear_score
from riskloom.sources.policy import GATE_AUC_MIN, GATE_KS_MIN, GATE_PSI_MAX, REASON_RULES

DIGITS = 9
EXPLANATIONS = "array<struct<feature:string,contribution:double,reason:string>>"


def reason_codes(rules: Sequence[tuple] = REASON_RULES) -> Column:
    """GOV-3: array of reason names whose feature is >= its threshold, in policy order."""
    hits = F.array(*[
        F.when(F.col(feature) >= F.lit(float(threshold)), F.lit(reason))
        for reason, _desc, feature, threshold in rules
    ])
    return F.filter(hits, lambda r: r.isNotNull())


def with_reason_codes(df: DataFrame, col: str = "reason_codes", rules: Sequence[tuple] = REASON_RULES) -> DataFrame:
    return df.withColumn(col, reason_codes(rules))


def reason_counts(df: DataFrame, rules: Sequence[tuple] = REASON_RULES) -> DataFrame:
    """How many rows trigger each reason: one aggregate, unpivoted to (reason, n)."""
    one = df.agg(*[
        F.count_if(F.col(feature) >= F.lit(float(t))).cast("long").alias(reason) for reason, _d, feature, t in rules
    ])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(r).alias("reason"), F.col(r).alias("n")) for r, *_ in rules
    ])).alias("_x")).select("_x.reason", "_x.n")


def reason_counts_from_rules(df: DataFrame, rules: DataFrame) -> DataFrame:
    """GOV-3 driven by a rule table (SRC-8): (reason, n) of rows at or above each threshold.

    Rows are stacked once per rule feature and joined to the rule rows; the rule table is
    config (one row per reason), so it is broadcast. Counting is a partial aggregate, so a
    reason hit by most rows is still one counter per task.
    """
    features = [r["feature"] for r in rules.select("feature").distinct().collect()]
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features
    ])).alias("_fv")).select("_fv.feature", "_fv.value")
    hits = stacked.join(F.broadcast(rules), "feature").where(F.col("value") >= F.col("threshold"))
    counts = hits.groupBy("reason").agg(F.count(F.lit(1)).cast("long").alias("n"))
    # reasons with no hit still get a row
    return rules.select("reason").join(counts, "reason", "left").select("reason", F.coalesce("n", F.lit(0)).alias("n"))


def decisions(df: DataFrame, key: str, coefficients: dict[str, float], intercept: float,
              model_version: str, rules: Sequence[tuple] = REASON_RULES, keep: Sequence[str] = ()) -> DataFrame:
    """GOV-4: (key, model_version, score, reason_codes) per applicant; score = PD of a linear model.

    ``keep`` carries extra input columns through (e.g. the request id)."""
    return df.select(
        F.col(key), *keep,
        F.lit(model_version).alias("model_version"),
        F.round(sigmoid(linear_score(coefficients, intercept)), DIGITS).alias("score"),
        reason_codes(rules).alias("reason_codes"),
    )


def decision_document(decided: DataFrame, request_col: str, key: str) -> DataFrame:
    """SNK-5: one response document per request: maps key -> score and key -> reasons.

    A request is a bounded batch of applicants (the API's unit), so collecting one
    request's rows into maps is bounded by the request size, not by the table. Of an
    applicant's repeated records in a request the one with the highest score stands;
    records without a key are left out (the contract check reports them).
    """
    entry = F.struct(F.col(key).alias("k"), F.col("score").alias("s"), F.col("reason_codes").alias("r"))
    docs = decided.where(F.col(key).isNotNull()).groupBy(request_col, "model_version").agg(F.sort_array(F.collect_list(entry)).alias("_all"))
    last = F.filter("_all", lambda e, i: ~e["k"].eqNullSafe(F.get("_all", i + 1)["k"]))
    return docs.withColumn("_all", last).select(
        request_col, "model_version",
        F.map_from_entries(F.transform("_all", lambda e: F.struct(e["k"], e["s"]))).alias("scores"),
        F.map_from_entries(F.transform("_all", lambda e: F.struct(e["k"], e["r"]))).alias("reason_codes"),
    )


def gate(metrics: DataFrame, auc_col: str = "auc_valid", ks_col: str = "ks_valid", psi_col: str = "psi_valid_vs_train",
         auc_min: float = GATE_AUC_MIN, ks_min: float = GATE_KS_MIN, psi_max: float = GATE_PSI_MAX) -> DataFrame:
    """GOV-2: one row per metric (metric, value, threshold, op, passed) plus ``all_passed``.

    Reads the metric names the evaluation writes (auc_valid, ks_valid, psi_valid_vs_train).
    """
    checks = [
        ("auc", auc_col, auc_min, ">=", F.col(auc_col) >= F.lit(auc_min)),
        ("ks", ks_col, ks_min, ">=", F.col(ks_col) >= F.lit(ks_min)),
        ("psi", psi_col, psi_max, "<", F.col(psi_col) < F.lit(psi_max)),
    ]
    rows = metrics.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("metric"), F.col(c).cast("double").alias("value"),
                 F.lit(float(t)).alias("threshold"), F.lit(op).alias("op"), F.coalesce(cond, F.lit(False)).alias("passed"))
        for name, c, t, op, cond in checks
    ])).alias("_g")).select("_g.*")
    # three rows: the window over all of them is a one-task step on a fixed-size table
    return rows.withColumn("all_passed", F.min(F.col("passed").cast("int")).over(Window.partitionBy()) == 1)


def best_by(metric_rows: DataFrame, name_col: str = "model", metric_col: str = "auc") -> DataFrame:
    """SRT-4: arg-max of a metric table (one row: best name and its value)."""
    return metric_rows.agg(
        F.max_by(F.col(name_col), F.struct(F.col(metric_col), F.col(name_col))).alias(f"best_{name_col}"),
        F.max(metric_col).alias(f"best_{metric_col}"),
    )


def explanations(top: Column, rules: Sequence[tuple] = REASON_RULES) -> Column:
    """GOV-5: (feature, contribution, reason) of each entry of ``top``; the reason is the policy's candidate for the
    feature, null where the policy has none."""
    def reason(feature: Column) -> Column:
        out = F.lit(None).cast("string")
        for name, _desc, of, _threshold in reversed(rules):
            out = F.when(feature == of, F.lit(name)).otherwise(out)
        return out

    return F.transform(top, lambda e: F.struct(
        e["feature"].alias("feature"), e["contribution"].alias("contribution"), reason(e["feature"]).alias("reason")))


def audit_events(decided: DataFrame, key: str, request_cols: Sequence[str], features_used: Sequence[str],
                 event_time: Column | None = None, latency_ms: Column | None = None, explanations: Column | None = None) -> DataFrame:
    """GOV-5: audit-log rows (event_id, timestamp, model_version, request, response, features_used,
    explanations, reason_codes, latency_ms). The id is a hash of version, key and request time, so a replay
    of the same decision yields the same id (idempotent sinks, de-duplication).
    """
    ts = event_time if event_time is not None else F.current_timestamp()
    return decided.select(
        F.sha2(F.concat_ws("|", F.col("model_version"), F.col(key).cast("string"), ts.cast("string")), 256).alias("event_id"),
        ts.alias("timestamp"),
        F.col("model_version"),
        F.struct(*[F.col(c) for c in request_cols]).alias("request"),
        F.struct(F.col(key), F.col("score"), F.col("reason_codes")).alias("response"),
        F.array(*[F.lit(f) for f in features_used]).alias("features_used"),
        (explanations if explanations is not None else F.array().cast(EXPLANATIONS)).alias("explanations"),
        F.col("reason_codes"),
        (latency_ms if latency_ms is not None else F.lit(None).cast("double")).alias("latency_ms"),
    )
