"""Streaming audit log: restarts, replays and line items that arrive after their order."""

from pyspark.sql import functions as F

from riskloom.plans import catalog
from riskloom.streaming import audit

from conftest import SF_SMALL


def test_restart_processes_only_new_order_files(spark, tmp_path):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    incoming, out = str(tmp_path / "incoming"), str(tmp_path / "audit")
    orders.where(F.col("o_orderkey") % 2 == 0).coalesce(1).write.mode("append").parquet(incoming)
    path, schema = audit.run_audit_stream(spark, SF_SMALL, out, orders_dir=incoming)
    n1 = spark.read.schema(schema).json(path).count()
    orders.where(F.col("o_orderkey") % 2 == 1).coalesce(1).write.mode("append").parquet(incoming)
    path, schema = audit.run_audit_stream(spark, SF_SMALL, out, orders_dir=incoming)  # resumes
    ev = spark.read.schema(schema).json(path)
    batch = catalog.REGISTRY["gov4_decisions"][0](spark, SF_SMALL)
    assert 0 < n1 < ev.count() == batch.count()
    assert ev.select("event_id").distinct().count() == ev.count()


def test_replayed_orders_and_late_lines(spark, tmp_path):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    lineitem = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    late = F.col("l_orderkey") % 3 == 0
    incoming, out = str(tmp_path / "incoming"), str(tmp_path / "audit")
    orders.coalesce(1).write.mode("append").parquet(incoming)
    path, schema = audit.run_audit_stream(spark, SF_SMALL, out, orders_dir=incoming, lineitem=lineitem.where(~late))
    first = spark.read.schema(schema).json(path)
    held = {r.id for r in lineitem.where(late).select(F.col("l_orderkey").cast("string").alias("id")).distinct().collect()}
    batch = {r.customer_id for r in catalog.REGISTRY["gov4_decisions"][0](spark, SF_SMALL).select("customer_id").collect()}
    assert {r.id for r in first.select("response.customer_id").toDF("id").collect()} == batch - held
    # some orders come again, with new files but before the rest of the lines
    orders.where(F.col("o_orderkey") % 5 == 0).coalesce(1).write.mode("append").parquet(incoming)
    path, schema = audit.run_audit_stream(spark, SF_SMALL, out, orders_dir=incoming, lineitem=lineitem.where(~late))
    assert spark.read.schema(schema).json(path).count() == len(batch - held)
    # the lines arrive; no new order file
    path, schema = audit.run_audit_stream(spark, SF_SMALL, out, orders_dir=incoming)
    ev = spark.read.schema(schema).json(path)
    assert sorted(r.id for r in ev.select("response.customer_id").toDF("id").collect()) == sorted(batch)
    assert ev.where("latency_ms > 0 and size(explanations) = 2").count() == ev.count()


def test_a_repeated_step_writes_the_same_events(spark, tmp_path):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select(*[c.split()[0] for c in audit.ORDER_STREAM_SCHEMA.split(", ")])
    lines = audit.tables.order_lines(spark, SF_SMALL)
    coefs = audit.S.SCORECARDS[audit.S.DEFAULT_SCORECARD][0]
    att = audit.features.LinearAttribution(coefs).fit(audit.tables.bureau(spark, SF_SMALL))
    steps = audit.AuditRun(spark, SF_SMALL, str(tmp_path / "run"), lines, att)
    steps.start()
    half = orders.where("o_orderkey % 2 = 0")
    steps.step(half, 7)
    n = spark.read.json(f"{tmp_path}/run/events").count()
    steps.step(half, 7)  # the micro-batch is tried again after it was logged
    assert spark.read.json(f"{tmp_path}/run/events").count() == n > 0


def test_events_are_written_compressed(spark, tmp_path):
    path, _ = audit.run_audit_stream(spark, SF_SMALL, str(tmp_path / "audit"))
    files = list((tmp_path / "audit" / "events").rglob("part-*"))  # the most that a run writes
    assert files and all(f.name.endswith(".json.gz") for f in files)
