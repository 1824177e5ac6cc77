"""Streaming decisions and audit log (GOV-5, SNK-4): Structured Streaming with state.

New orders arrive as application files. A replayed order is dropped by its key and date (state kept for
``REPLAY_WINDOW`` of arrival time); the rest is joined to the customer, nation and line-item tables to form the bureau snapshot,
scored, explained, given reason codes and written as audit events to a sink of gzipped JSON lines. Orders whose line items have
not arrived wait in a pending table and are decided by the first step that finds the lines.

A step (a micro-batch, or the settling of waiting orders when a run starts) reads pending version v, writes its
events into folder v + 1 and pending version v + 1, and then a row to the step log. A step that is repeated after a failure
overwrites what it had written, and a micro-batch that the log has is skipped: each decision is one event. The event id
hashes version, key and event time.
"""

from __future__ import annotations

import time
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskloom.functions.columns import utc_timestamp_text
from riskloom.operators import features, governance
from riskloom.plans import catalog
from riskloom.plans import scorecards as S
from riskloom.plans.catalog import query
from riskloom.session import ensure_checkpoint_dir
from riskloom.sources import policy, tables

REQUEST_FIELDS = ["income", "utilization_rate", "num_trades", "delinq_12m", "inquiries_6m", "dti", "cltv",
                  "employment_status", "state", "age", "tenure_months"]


#: How long (in arrival time) a replayed order is known.
REPLAY_WINDOW = "7 days"
TOP_EXPLANATIONS = 2


def audit_rows(spark: SparkSession, sf_dir: str, orders: DataFrame, lines: DataFrame, attribution: features.LinearAttribution) -> DataFrame:
    """Audit events, without latency, of the orders that have lines."""
    coefs, intercept = S.SCORECARDS[S.DEFAULT_SCORECARD]
    snap = tables.bureau(spark, sf_dir, orders, lines)
    scored = snap.select(
        "customer_id", "snapshot_date", *REQUEST_FIELDS,
        F.lit(S.MODEL_VERSION).alias("model_version"),
        F.round(governance.sigmoid(governance.linear_score(coefs, intercept)), 9).alias("score"),
        governance.reason_codes().alias("reason_codes"),
        governance.explanations(attribution.top(TOP_EXPLANATIONS)).alias("explanations"),
    )
    return governance.audit_events(
        scored, "customer_id", ["customer_id", "snapshot_date", *REQUEST_FIELDS],
        list(coefs), event_time=F.col("snapshot_date").cast("timestamp"), explanations=F.col("explanations"),
    ).drop("latency_ms")


ORDER_STREAM_SCHEMA = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                       "o_orderdate timestamp, o_orderpriority string")


class AuditRun:
    """The steps of an audit log in folder ``run``: events/step=v, pending/step=v, steps/step=v (the log)."""

    def __init__(self, spark: SparkSession, sf_dir: str, run: str, lines: DataFrame, attribution: features.LinearAttribution) -> None:
        self.spark, self.sf_dir, self.run, self.lines, self.attribution = spark, sf_dir, run, lines, attribution

    def _last(self, batch: int | None = None) -> tuple[int, bool]:
        """The last step of the log, and whether it has the batch (aggregates: the log has a row per step)."""
        log = self.spark.read.schema("batch long, step int").json(f"{self.run}/steps")
        r = log.agg(F.max("step").alias("last"), F.count_if(F.col("batch") == F.lit(batch)).alias("seen")).first()
        return r["last"] or 0, bool(r["seen"])

    def start(self) -> None:
        """An empty log and pending table, unless the folder has them."""
        self.spark.createDataFrame([], ORDER_STREAM_SCHEMA).write.mode("ignore").parquet(f"{self.run}/pending/step=0")
        self.spark.createDataFrame([(-1,)], "batch long").write.mode("ignore").json(f"{self.run}/steps/step=0")

    def pending(self) -> DataFrame:
        """Orders that wait for their line items."""
        return self.spark.read.schema(ORDER_STREAM_SCHEMA).parquet(f"{self.run}/pending/step={self._last()[0]}")

    def step(self, orders: DataFrame | None, batch: int | None = None) -> None:
        """Decide ``orders`` and the waiting ones; ``orders`` None: the waiting ones only."""
        last, seen = self._last(batch)
        if seen:
            return
        begun = time.monotonic()
        waiting = self.spark.read.schema(ORDER_STREAM_SCHEMA).parquet(f"{self.run}/pending/step={last}")
        todo = waiting if orders is None else waiting.unionByName(orders.select(*waiting.columns))
        todo = todo.persist(StorageLevel.MEMORY_AND_DISK)  # a micro-batch is computed anew, its state with it, by each action
        keys = self.lines.select(F.col("l_orderkey").alias("o_orderkey"))
        events = audit_rows(self.spark, self.sf_dir, todo, self.lines, self.attribution).persist(StorageLevel.MEMORY_AND_DISK)
        n = events.count()
        latency = (time.monotonic() - begun) * 1000.0 / max(n, 1)
        folder = f"{self.run}/events/step={last + 1}"
        events.withColumn("latency_ms", F.lit(latency)).write.mode("overwrite").json(folder, compression="gzip")
        events.unpersist()
        todo.join(keys, "o_orderkey", "left_anti").select(*waiting.columns).write.mode("overwrite").parquet(f"{self.run}/pending/step={last + 1}")
        todo.unpersist()
        self.spark.createDataFrame([(batch,)], "batch long").write.mode("overwrite").json(f"{self.run}/steps/step={last + 1}")

    def schema(self) -> StructType:
        empty = self.spark.createDataFrame([], ORDER_STREAM_SCHEMA)
        return audit_rows(self.spark, self.sf_dir, empty, self.lines, self.attribution).withColumn("latency_ms", F.lit(0.0)).schema


def run_audit_stream(spark: SparkSession, sf_dir: str, out_dir: str | None = None, orders_dir: str | None = None,
                     lineitem: DataFrame | None = None):
    """Process every available order file once (availableNow) into a JSON sink.

    ``orders_dir``: folder that receives order files (default: the ``orders*.parquet`` files of the table folder); ``lineitem``: the line
    items known by now (default: the table's). Running again with the same ``out_dir`` resumes from the
    checkpoint, processes only files that arrived since, and settles waiting orders. Returns (sink path, schema).
    ``latency_ms`` is a step's time from reading to scored rows, divided by its decisions.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    run = out_dir or f"{base}/audit-{uuid.uuid4().hex}"
    reader = spark.readStream.schema(ORDER_STREAM_SCHEMA)
    if orders_dir:
        stream = reader.parquet(orders_dir)
    else:
        # the table folder holds one file per table; the glob keeps the orders files only
        stream = reader.option("pathGlobFilter", "orders*.parquet").parquet(sf_dir.rstrip("/"))
    # the static side is evaluated again in every step: aggregate lineitem once into a compact per-order table
    lines_path = f"{run}/_order_lines"
    tables.order_lines(spark, sf_dir, lineitem).write.mode("overwrite").parquet(lines_path)
    coefs, _ = S.SCORECARDS[S.DEFAULT_SCORECARD]
    train = catalog.bureau_split(spark, sf_dir).where(F.col("split") == "train")
    steps = AuditRun(spark, sf_dir, run, spark.read.parquet(lines_path),
                     features.LinearAttribution(coefs, digits=catalog.PARAM_DIGITS).fit(train))
    steps.start()
    if not steps.pending().isEmpty():
        steps.step(None)
    fresh = (stream.withColumn("arrived", F.current_timestamp()).withWatermark("arrived", REPLAY_WINDOW)
             .dropDuplicatesWithinWatermark(["o_orderkey", "o_orderdate"]).drop("arrived"))
    q = (fresh.writeStream.outputMode("append").foreachBatch(lambda rows, batch: steps.step(rows, batch))
         .option("checkpointLocation", f"{run}/_checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return f"{run}/events", steps.schema()


_COEFS = S.SCORECARDS[S.DEFAULT_SCORECARD][0]
_REASON_OF = "CASE x.feature " + " ".join(f"WHEN '{feat}' THEN '{r}'" for r, _d, feat, _t in policy.REASON_RULES) + " END"


@query("gov5_audit_stream", f"""WITH {catalog.BUREAU_SPLIT_SQL},
m AS (SELECT {", ".join(f"{catalog.SIG(f'AVG({c})')} AS m_{c}" for c in _COEFS)} FROM bs WHERE split = 'train'),
c AS (SELECT customer_id, UNNEST([{", ".join(f"{{'feature': '{c}', 'contribution': {catalog.D(repr(w))} * ({c} - m_{c})}}" for c, w in _COEFS.items())}]) AS x
      FROM bureau, m),
t AS (SELECT customer_id, x.feature AS feature, ROUND(x.contribution, 9) AS contribution, {_REASON_OF} AS reason,
             ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY x.contribution DESC, x.feature) AS rk FROM c),
e AS (SELECT customer_id, {", ".join(f"MAX(CASE WHEN rk = {k} THEN {c} END) AS {c}_{k}" for k in (1, 2) for c in ("feature", "contribution", "reason"))}
      FROM t GROUP BY customer_id)
SELECT sha256(concat_ws('|', '{S.MODEL_VERSION}', b.customer_id,
    CAST(CAST(snapshot_date AS TIMESTAMP) AS VARCHAR))) AS event_id,
  strftime(CAST(snapshot_date AS TIMESTAMP), '%Y-%m-%dT%H:%M:%SZ') AS event_time, '{S.MODEL_VERSION}' AS model_version,
  b.customer_id, ROUND({S.pd_sql()}, 9) AS score, {", ".join(f"b.{c} AS request_{c}" for c in REQUEST_FIELDS)},
  array_to_string(list_filter([{", ".join(f"CASE WHEN {feat} >= CAST({float(t)!r} AS DOUBLE) THEN '{r}' END" for r, _d, feat, t in policy.REASON_RULES)}], lambda x: x IS NOT NULL), ',') AS reason_codes,
  '{",".join(_COEFS)}' AS features_used, {", ".join(f"{c}_{k}" for k in (1, 2) for c in ("feature", "contribution", "reason"))},
  TRUE AS latency_in_range
FROM bureau b JOIN e ON e.customer_id = b.customer_id""", ("bureau",))
def q_audit_stream(spark, sf):
    """GOV-5/SNK-4: audit events of the streamed decisions, all nine fields, read back from the JSON sink."""
    path, schema = run_audit_stream(spark, sf)
    ev = spark.read.schema(schema).json(path)
    top = [(c, k) for k in (1, 2) for c in ("feature", "contribution", "reason")]
    return ev.select(
        "event_id", utc_timestamp_text("timestamp").alias("event_time"), "model_version",
        F.col("response.customer_id").alias("customer_id"), F.col("response.score").alias("score"),
        *[F.col(f"request.{c}").alias(f"request_{c}") for c in REQUEST_FIELDS],
        F.array_join("reason_codes", ",").alias("reason_codes"), F.array_join("features_used", ",").alias("features_used"),
        *[(F.round(F.get("explanations", F.lit(k - 1))[c], 9) if c == "contribution" else F.get("explanations", F.lit(k - 1))[c]).alias(f"{c}_{k}") for c, k in top],
        ((F.col("latency_ms") > 0) & (F.col("latency_ms") < 3_600_000)).alias("latency_in_range"),
    )
