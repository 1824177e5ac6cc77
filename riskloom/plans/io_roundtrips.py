"""Source/sink queries: data derived from the driver tables is written with the library's
sinks into the shared checkpoint folder and read back with its readers, then run through
the same operators as the parquet queries (so the oracle SQL is the same).

Each call writes into a fresh folder ``<spark checkpoint dir>/io-<uuid>``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators import contract, etl, governance, ranks
from riskloom.plans import catalog
from riskloom.plans import scorecards as S
from riskloom.plans.catalog import REGISTRY, query
from riskloom.session import ensure_checkpoint_dir
from riskloom.sources import files, tables



def _folder(spark: SparkSession, what: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/io-{uuid.uuid4().hex}/{what}"


def _loans_csv(spark: SparkSession, sf: str) -> str:
    path = _folder(spark, "loans_csv")
    cols = [f.name for f in files.LOAN_SCHEMA.fields]
    files.write_csv(tables.loans(spark, sf).select(*cols), path)
    return path


@query("src2_loans_csv_etl", REGISTRY["agg5_default_rate_by_util_bin"][1])
def q_loans_csv_etl(spark, sf):
    """SRC-2 + SNK: raw loans written as CSV, read back with the fixed 12-field schema, ETL,
    default rate per utilization bin (same answer as the parquet flagship)."""
    df = files.read_loans_csv(spark, _loans_csv(spark, sf))
    return etl.default_rate_by(etl.loan_etl(df), "util_bin")


@query("src1_csv_inferred_clean", """SELECT CASE WHEN loan_status = 'Default' THEN 1 ELSE 0 END AS loan_status_flag,
  COUNT(*) AS n, CAST(COUNT_IF(fico_score IS NULL) AS BIGINT) AS null_fico_before_impute
FROM loans WHERE loan_status IS NOT NULL AND credit_utilization IS NOT NULL GROUP BY 1""", ("loans",))
def q_csv_inferred_clean(spark, sf):
    """SRC-1 + PRJ-1/2 + FLT-1: CSV read with inferred types, impute, label, drop rows with NULLs."""
    raw = files.read_csv_inferred(spark, _loans_csv(spark, sf))
    clean = etl.basic_clean(raw.withColumn("_fico_was_null", F.col("fico_score").isNull()))
    return clean.groupBy("loan_status_flag").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("_fico_was_null").alias("null_fico_before_impute"))


@query("snk1_parquet_roundtrip", """WITH """ + catalog.CLEAN_LOANS_SQL + """
SELECT util_bin, COUNT(*) AS n, ROUND(SUM(loan_amount), 2) AS loan_amount_sum FROM clean GROUP BY util_bin""", ("loans",))
def q_parquet_roundtrip(spark, sf):
    """SNK-1 + SRC-3: cleaned loans written as Parquet partitioned by util_bin, read back."""
    path = _folder(spark, "clean_loans")
    files.write_parquet(catalog.clean_loans(spark, sf), path, partition_by=["util_bin"])
    back = spark.read.parquet(path)
    return back.groupBy("util_bin").agg(F.count(F.lit(1)).alias("n"),
                                        F.round(F.sum("loan_amount"), 2).alias("loan_amount_sum"))


def _contract_text_sql() -> str:
    from riskloom.sources import policy

    parts = []
    text_types = {"date": None, "float": "DOUBLE", "integer": "INTEGER"}
    for name, ftype, required, lo, hi, allowed, fmt in policy.CONTRACT_FIELDS:
        typed = name
        if required:
            parts.append((name, "required", f"{name} IS NULL"))
        if ftype == "date":
            parts.append((name, "format", f"{name} IS NOT NULL AND TRY_STRPTIME(CAST({name} AS VARCHAR), '%Y-%m-%d') IS NULL"))
        elif ftype in text_types:
            parts.append((name, "type", f"{name} IS NOT NULL AND TRY_CAST(CAST({name} AS VARCHAR) AS {text_types[ftype]}) IS NULL"))
        if lo is not None:
            parts.append((name, "min", f"{typed} < {lo}"))
        if hi is not None:
            parts.append((name, "max", f"{typed} > {hi}"))
        if allowed is not None:
            vals = ", ".join(repr(str(v)) for v in allowed)
            parts.append((name, "allowed", f"{typed} IS NOT NULL AND CAST({typed} AS VARCHAR) NOT IN ({vals})"))
    return " UNION ALL ".join(
        f"SELECT '{f}' AS field, '{r}' AS rule, CAST(COUNT_IF({p}) AS BIGINT) AS violations, "
        f"CAST(COUNT(*) AS BIGINT) AS n_rows FROM bureau" for f, r, p in parts)


@query("src4_bureau_csv_contract", _contract_text_sql(), ("bureau",))
def q_bureau_csv_contract(spark, sf):
    """SRC-4 + GOV-1: bureau snapshots written as CSV and validated from text (type and
    date-format rules apply to text columns)."""
    path = _folder(spark, "bureau_csv")
    files.write_csv(tables.bureau(spark, sf), path)
    return contract.validate(files.read_csv_text(spark, path))


@query("src6_metrics_json_gate", REGISTRY["gov2_gate"][1])
def q_metrics_json_gate(spark, sf):
    """SNK-3 + SRC-6 + GOV-2: the metric record written as JSON, read back, gated."""
    path = _folder(spark, "metrics_json")
    files.write_json(catalog.metric_record(spark, sf), path)
    return governance.gate(files.read_metrics_json(spark, path)).drop("all_passed")


def request_documents(bureau: DataFrame, rows_per_document: int = 500) -> DataFrame:
    """Group applicants into request documents of at most ``rows_per_document`` rows.

    The document id comes from the row's position in the order of all fields
    (``ranks.with_positions``): the same on every run, and a repeated key cannot pile into
    one document.
    """
    fields = [f.name for f in files.REQUEST_RECORD.fields]
    rec = bureau.select(
        *[F.col(c).cast(files.REQUEST_RECORD[c].dataType) if c != "snapshot_date"
          else F.date_format("snapshot_date", "yyyy-MM-dd'T'HH:mm:ss").alias(c) for c in fields])
    placed = ranks.with_positions(rec, [F.col(c) for c in fields], "_pos", "_n")
    rid = F.floor(F.col("_pos") / F.lit(rows_per_document)).cast("string")
    return placed.withColumn("request_id", rid).groupBy("request_id").agg(
        F.collect_list(F.struct(*fields)).alias("records"))


@query("src7_request_documents", REGISTRY["gov4_decisions"][1])
def q_request_documents(spark, sf):
    """SRC-7 + GOV-4 + SNK-5: bureau rows as request documents (JSON lines), read back,
    decided, written as response documents (maps keyed by customer), flattened."""
    req_path, resp_path = _folder(spark, "requests"), _folder(spark, "responses")
    files.write_json(request_documents(tables.bureau(spark, sf)), req_path)
    req = files.read_decision_requests(spark, req_path, multi_line=False, id_col="request_id")
    coefs, intercept = S.SCORECARDS[S.DEFAULT_SCORECARD]
    decided = governance.decisions(req, "customer_id", coefs, intercept, S.MODEL_VERSION, keep=["request_id"])
    docs = governance.decision_document(decided, "request_id", "customer_id")
    files.write_json(docs, resp_path)
    back = spark.read.json(resp_path, schema=docs.schema)
    flat = back.select("model_version", "reason_codes", F.explode("scores").alias("customer_id", "score"))
    return flat.select("customer_id", "model_version", "score",
                       F.array_join(F.col("reason_codes")[F.col("customer_id")], ",").alias("reason_codes"))
