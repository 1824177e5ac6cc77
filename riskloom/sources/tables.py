"""Driver tables and the two loan-shaped views derived from them.

``loans`` has the raw loan-file shape (customer_id, fico_score, loan_amount, ...,
credit_utilization, has_bankruptcy) plus ``loan_id``; ``bureau`` has the bureau
snapshot shape (customer_id, snapshot_date, income, ..., defaulted). Both are built
from orders x customer x nation plus a per-order aggregate of lineitem.

Plan shape at scale: lineitem is pre-aggregated per order (partial + final hash
aggregate, one shuffle on l_orderkey); orders joins it on the same key, so the
aggregate side is already partitioned; the customer join shuffles on custkey and a
hot customer is split by AQE's skew-join handling; nation (one row per country) is joined
as the planner's statistics say, which is a broadcast for a file of that size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (parquet); Catalyst prunes columns and pushes filters into the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_lines(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    """Per-order aggregate of lineitem (max quantity / 50, lines, max discount, max tax, returns)."""
    return _order_lines(spark, sf_dir, lineitem)


def _order_lines(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    li = lineitem if lineitem is not None else read_table(spark, sf_dir, "lineitem")
    return li.groupBy("l_orderkey").agg(
        (F.max("l_quantity") / F.lit(50)).alias("util"),
        F.count(F.lit(1)).alias("n_lines"),
        F.max("l_discount").alias("max_discount"),
        F.max("l_tax").alias("max_tax"),
        F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("n_returned"),
    )


ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _orders_customers(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """orders (batch, or a stream for the streaming decisions) x customer x nation."""
    if orders is None:
        orders = read_table(spark, sf_dir, "orders")
    orders = orders.select(*ORDER_COLS)
    customer = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"
    )
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )


def _null_when(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw loan table (shape of the fixed 12-field loan schema + ``loan_id``).

    Nulls are made on purpose: FICO is null for every 17th order key, the status
    text and flag for every 53rd, utilization for orders without line items.
    """
    oc = _orders_customers(spark, sf_dir)
    lines = _order_lines(spark, sf_dir).select("l_orderkey", "util")
    df = oc.join(lines, oc.o_orderkey == lines.l_orderkey, "left")
    key = F.col("o_orderkey")
    no_status = key % 53 == 0
    return df.select(
        key.alias("loan_id"),
        key.cast("string").alias("customer_id"),
        _null_when(
            key % 17 == 0, F.floor(F.lit(350) + (F.col("c_acctbal") + 1000) / 22).cast("double")
        ).alias("fico_score"),
        F.col("o_totalprice").alias("loan_amount"),
        (F.substring("o_orderpriority", 1, 1).cast("int") * 6).alias("tenure_months"),
        F.col("n_name").alias("state"),
        F.when(F.col("c_mktsegment") == "BUILDING", "Business")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "Family")
        .otherwise("Individual")
        .alias("plan_type"),
        (F.col("c_acctbal") + 2500).alias("monthly_income"),
        F.col("o_orderdate").cast("date").cast("string").alias("date_issued"),
        _null_when(
            no_status, F.when(F.col("o_orderstatus") == "F", "Default").otherwise("Current")
        ).alias("loan_status"),
        _null_when(no_status, F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).alias(
            "loan_status_flag"
        ),
        F.col("util").alias("credit_utilization"),
        F.when(F.col("c_custkey") % 11 == 0, 1).otherwise(0).alias("has_bankruptcy"),
    )


EMPLOYMENT = ["employed", "self_employed", "unemployed", "student", "retired"]
SEGMENTS = ["low", "med", "high"]


def bureau(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None,
           lines: DataFrame | None = None) -> DataFrame:
    """Bureau snapshot table (contract shape), one row per order with line items.

    ``orders`` may be a streaming DataFrame: the other inputs are static, so every
    join is a stream-static inner join and the result is a stateless stream.
    ``lines``: a precomputed ``order_lines`` table (the stream passes a materialized one so
    that a micro-batch does not aggregate lineitem again).
    """
    oc = _orders_customers(spark, sf_dir, orders)
    lines = lines if lines is not None else _order_lines(spark, sf_dir)
    df = oc.join(lines, oc.o_orderkey == lines.l_orderkey)
    key = F.col("o_orderkey")
    cust = F.col("o_custkey")
    employment = F.element_at(F.array(*[F.lit(e) for e in EMPLOYMENT]), (cust % 5 + 1).cast("int"))
    segment = F.element_at(F.array(*[F.lit(s) for s in SEGMENTS]), (key % 3 + 1).cast("int"))
    return df.select(
        key.cast("string").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("snapshot_date"),
        (F.col("c_acctbal") * 10 + 10000).cast("double").alias("income"),
        F.col("util").alias("utilization_rate"),
        F.col("n_lines").cast("int").alias("num_trades"),
        F.col("n_returned").cast("int").alias("delinq_12m"),
        (key % 7).cast("int").alias("inquiries_6m"),
        (F.col("max_discount") * 6).alias("dti"),
        (F.col("max_tax") * 10).alias("cltv"),
        employment.alias("employment_status"),
        F.col("n_name").alias("state"),
        (F.lit(16) + cust % 60).cast("int").alias("age"),
        (key % 360).cast("int").alias("tenure_months"),
        segment.alias("risk_segment"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("defaulted"),
    )


# SQL text of the same two views, used by the DuckDB oracle queries (CTEs).
LOANS_SQL = """
SELECT o.o_orderkey AS loan_id, CAST(o.o_orderkey AS STRING) AS customer_id,
 CASE WHEN o.o_orderkey % 17 = 0 THEN NULL ELSE CAST(FLOOR(350 + (c.c_acctbal + 1000) / 22) AS DOUBLE) END AS fico_score,
 o.o_totalprice AS loan_amount,
 CAST(SUBSTR(o.o_orderpriority,1,1) AS INT) * 6 AS tenure_months,
 n.n_name AS state,
 CASE c.c_mktsegment WHEN 'BUILDING' THEN 'Business' WHEN 'HOUSEHOLD' THEN 'Family' ELSE 'Individual' END AS plan_type,
 c.c_acctbal + 2500 AS monthly_income,
 CAST(CAST(o.o_orderdate AS DATE) AS STRING) AS date_issued,
 CASE WHEN o.o_orderkey % 53 = 0 THEN NULL WHEN o.o_orderstatus = 'F' THEN 'Default' ELSE 'Current' END AS loan_status,
 CASE WHEN o.o_orderkey % 53 = 0 THEN NULL WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS loan_status_flag,
 l.util AS credit_utilization,
 CASE WHEN c.c_custkey % 11 = 0 THEN 1 ELSE 0 END AS has_bankruptcy
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN (SELECT l_orderkey, MAX(l_quantity) / 50 AS util FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey
"""

BUREAU_SQL = """
SELECT CAST(o.o_orderkey AS STRING) AS customer_id, CAST(o.o_orderdate AS DATE) AS snapshot_date,
 CAST(c.c_acctbal * 10 + 10000 AS DOUBLE) AS income, l.util AS utilization_rate, CAST(l.n AS INT) AS num_trades,
 CAST(l.r AS INT) AS delinq_12m, CAST(o.o_orderkey % 7 AS INT) AS inquiries_6m, l.d * 6 AS dti, l.t * 10 AS cltv,
 CASE o.o_custkey % 5 WHEN 0 THEN 'employed' WHEN 1 THEN 'self_employed' WHEN 2 THEN 'unemployed' WHEN 3 THEN 'student' ELSE 'retired' END AS employment_status,
 n.n_name AS state, CAST(16 + o.o_custkey % 60 AS INT) AS age, CAST(o.o_orderkey % 360 AS INT) AS tenure_months,
 CASE o.o_orderkey % 3 WHEN 0 THEN 'low' WHEN 1 THEN 'med' ELSE 'high' END AS risk_segment,
 CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS defaulted
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN (SELECT l_orderkey, MAX(l_quantity) / 50 AS util, COUNT(*) AS n, MAX(l_discount) AS d, MAX(l_tax) AS t,
 SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS r FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey
"""


def with_views_sql(body: str, *views: str) -> str:
    """Prefix an oracle query with the CTEs of the named views."""
    parts = {"loans": LOANS_SQL, "bureau": BUREAU_SQL}
    ctes = ",\n".join(f"{v} AS ({parts[v]})" for v in views)
    if not views:
        return body
    stripped = body.lstrip()
    if stripped[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{stripped[5:]}"
    return f"WITH {ctes}\n{body}"
