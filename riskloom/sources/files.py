"""File sources and sinks (SRC-1..7, SNK-1..5).

Readers declare schemas wherever the shape is known (no inference pass over the
data); inference is kept only as the reference's exploratory CSV path. Writers use
Spark's committers (task output renamed at job commit), so a lost executor's partial
files never become visible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, StringType, StructField, StructType)

from riskloom.functions.columns import parse_date

# Fixed values that must equal the reference's: raw loan file schema (v2: fico_score DOUBLE).
LOAN_SCHEMA = StructType([
    StructField("customer_id", StringType(), True),
    StructField("fico_score", DoubleType(), True),
    StructField("loan_amount", DoubleType(), True),
    StructField("tenure_months", IntegerType(), True),
    StructField("state", StringType(), True),
    StructField("plan_type", StringType(), True),
    StructField("monthly_income", DoubleType(), True),
    StructField("date_issued", StringType(), True),
    StructField("loan_status", StringType(), True),
    StructField("loan_status_flag", IntegerType(), True),
    StructField("credit_utilization", DoubleType(), True),
    StructField("has_bankruptcy", IntegerType(), True),
])

# Fixed values that must equal the reference's: one decision-request record.
REQUEST_RECORD = StructType([
    StructField("customer_id", StringType()),
    StructField("snapshot_date", StringType()),
    StructField("income", DoubleType()),
    StructField("utilization_rate", DoubleType()),
    StructField("num_trades", IntegerType()),
    StructField("delinq_12m", IntegerType()),
    StructField("inquiries_6m", IntegerType()),
    StructField("dti", DoubleType()),
    StructField("cltv", DoubleType()),
    StructField("employment_status", StringType()),
    StructField("state", StringType()),
    StructField("age", IntegerType()),
    StructField("tenure_months", IntegerType()),
])
REQUEST_SCHEMA = StructType([StructField("records", ArrayType(REQUEST_RECORD))])

METRICS_SCHEMA = StructType([
    StructField("best_model", StringType()),
    StructField("auc_train", DoubleType()),
    StructField("auc_valid", DoubleType()),
    StructField("ks_valid", DoubleType()),
    StructField("psi_valid_vs_train", DoubleType()),
])


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """SRC-1: header + inferred types (an extra pass over the file; exploration only)."""
    return spark.read.csv(path, header=True, inferSchema=True)


def read_loans_csv(spark: SparkSession, path: str, schema: StructType = LOAN_SCHEMA) -> DataFrame:
    """SRC-2: fixed schema; PERMISSIVE mode turns a cell that does not parse into NULL."""
    return spark.read.csv(path, schema=schema, header=True, mode="PERMISSIVE")


def read_bureau_csv(spark: SparkSession, path: str, date_col: str = "snapshot_date") -> DataFrame:
    """SRC-4: bureau CSV, all columns as text, date coerced (bad -> NULL).

    No global sort is added here: ordering by date is ``splits.sorted_by_date`` and is
    only needed for ordered output; the windows filter by value.
    """
    df = spark.read.csv(path, header=True, inferSchema=False)
    return df.withColumn(date_col, parse_date(date_col))


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV with every column as text (input of contract type/format checks)."""
    return spark.read.csv(path, header=True, inferSchema=False)


def read_metrics_json(spark: SparkSession, path: str) -> DataFrame:
    """SRC-6: the metrics record(s) read back for gating (any Hadoop file system URI)."""
    return spark.read.schema(METRICS_SCHEMA).json(path)


def read_decision_requests(spark: SparkSession, path: str, multi_line: bool = True,
                           id_col: str | None = None) -> DataFrame:
    """SRC-7: request documents ``{"records": [...]}`` -> one row per record, date parsed
    (ISO date-time too). ``multi_line``: one pretty-printed document per file (the API
    sample); otherwise JSON lines, one document per line (splittable). ``request_id`` is
    the document's ``id_col`` field when given, else the source file."""
    schema = REQUEST_SCHEMA
    if id_col:
        schema = StructType([StructField(id_col, StringType())] + REQUEST_SCHEMA.fields)
    docs = spark.read.schema(schema).json(path, multiLine=multi_line)
    rid = F.col(id_col) if id_col else F.input_file_name()
    rows = docs.select(rid.alias("request_id"), F.explode("records").alias("r"))
    return rows.select("request_id", "r.*").withColumn("snapshot_date", parse_date("snapshot_date"))


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """SNK-1: Parquet, overwrite."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header, overwrite."""
    df.write.mode("overwrite").csv(path, header=True)


def write_sample_csv(df: DataFrame, path: str, order_by: list[str], n: int = 100) -> None:
    """SNK-2: first ``n`` rows in a stated order, one CSV file with header."""
    df.orderBy(*order_by).limit(n).coalesce(1).write.mode("overwrite").csv(path, header=True)


def write_json(df: DataFrame, path: str) -> None:
    """SNK-3/SNK-4/SNK-5: JSON lines (metric records, audit events, decision documents)."""
    df.write.mode("overwrite").json(path)


#: Bureau snapshot columns with their types; the date stays text until it is coerced.
BUREAU_CSV = ("customer_id string, snapshot_date string, income double, utilization_rate double, num_trades int, delinq_12m int, inquiries_6m int, "
              "dti double, cltv double, employment_status string, state string, age int, tenure_months int, risk_segment string, defaulted int")


def read_bureau_csv_rejecting(spark: SparkSession, path: str, store: str, date_col: str = "snapshot_date",
                              header: bool = True) -> tuple[DataFrame, DataFrame]:
    """SRC-4: typed bureau CSV parsed once into ``store`` (rejected=true|false) -> (rows, rejects).

    A line with too few or too many cells, or with a cell that is not of its column's type, is a reject and kept as its text (column ``line``); the
    date of the others is coerced, an unreadable one is NULL and the row stays. All columns are parsed whatever is read later, so
    what counts as broken does not depend on the query.
    """
    raw = spark.read.csv(path, schema=f"{BUREAU_CSV}, line string", header=header, mode="PERMISSIVE", columnNameOfCorruptRecord="line")
    parsed = raw.withColumn(date_col, parse_date(date_col)).withColumn("rejected", F.col("line").isNotNull())
    parsed.write.partitionBy("rejected").parquet(store)
    back = spark.read.schema(parsed.schema).parquet(store)
    return back.where(~F.col("rejected")).drop("rejected", "line"), back.where("rejected").select("line")
