"""Registered queries of drift over stored periods, the violations table and the rejecting bureau reader (DRF-3, GOV-1, SRC-4, SRT-2)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riskloom.operators import contract, drift, splits
from riskloom.plans.catalog import query
from riskloom.session import ensure_checkpoint_dir
from riskloom.sources import files, policy, tables

DRIFT_FEATURES = policy.NUMERIC_FEATURES + policy.PASSTHROUGH_FEATURES
BASE_PERIOD = "1995-01"
BINS = 10


def _folder(spark, what: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


_STACK = " UNION ALL ".join(
    f"SELECT strftime(snapshot_date, '%Y-%m') AS period, '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM bureau WHERE {f} IS NOT NULL AND snapshot_date IS NOT NULL"
    for f in DRIFT_FEATURES)


@query("drf3_psi_periods", f"""WITH st AS ({_STACK}),
cuts AS (SELECT feature, quantile_cont(value, [{", ".join(repr(i / BINS) for i in range(BINS + 1))}]::DOUBLE[]) AS cuts FROM st WHERE period = '{BASE_PERIOD}' GROUP BY feature),
binned AS (SELECT s.feature, s.period, len(list_filter(cuts[2:{BINS}], lambda c: s.value >= c)) AS bin FROM st s JOIN cuts c ON s.feature = c.feature),
grid AS (SELECT feature, period, bin FROM (SELECT DISTINCT feature, period FROM binned), range(0, {BINS}) r(bin)),
cnt AS (SELECT g.feature, g.period, g.bin, COUNT(b.bin) AS a FROM grid g LEFT JOIN binned b ON g.feature = b.feature AND g.period = b.period AND g.bin = b.bin GROUP BY ALL),
sh AS (SELECT *, SUM(a) OVER (PARTITION BY feature, period) AS na FROM cnt),
j AS (SELECT x.feature, x.period, x.na, y.na AS ne, x.a / (x.na + 1e-9) AS ap, y.a / (y.na + 1e-9) AS ep FROM sh x JOIN sh y ON x.feature = y.feature AND x.bin = y.bin WHERE y.period = '{BASE_PERIOD}')
SELECT feature, period, ROUND(SUM((ap - ep) * LN((ap + 1e-9) / (ep + 1e-9))), 8) AS psi, CAST(MAX(ne) AS BIGINT) AS n_base, CAST(MAX(na) AS BIGINT) AS n FROM j GROUP BY feature, period""", ("bureau",))
def q_psi_periods(spark, sf):
    """DRF-3 over time: PSI of every numeric feature and month against the first month, from the stored counts. The store is filled in two
    merges (up to 1997 and after), the second of which reads no row of the first."""
    store = _folder(spark, "drift")
    bureau = tables.bureau(spark, sf)
    month = F.date_format("snapshot_date", "yyyy-MM")
    for part in (bureau.where("snapshot_date < '1998-01-01'"), bureau.where("snapshot_date >= '1998-01-01'")):
        drift.add_periods(part, DRIFT_FEATURES, month, store)
    out = drift.psi_over_periods(spark, store, BASE_PERIOD, BINS)
    return out.withColumn("psi", F.round("psi", 8))


def state_named(df):
    """The bureau view with postal codes as states, but for every fifth nation, whose name stays and breaks the contract."""
    n = F.regexp_extract("state", "([0-9]+)$", 1).cast("int")
    codes = F.array(*[F.lit(s) for s in policy.US_STATES])
    return df.withColumn("state", F.when(n % 5 == 0, F.col("state")).otherwise(F.element_at(codes, (n % len(policy.US_STATES)) + 1)))


def _violations_sql() -> str:
    parts = []
    for name, ftype, required, lo, hi, allowed, fmt in policy.CONTRACT_FIELDS:
        if required:
            parts.append((name, "required", f"{name} IS NULL"))
        if lo is not None:
            parts.append((name, "min", f"{name} < {lo}"))
        if hi is not None:
            parts.append((name, "max", f"{name} > {hi}"))
        if allowed is not None:
            parts.append((name, "allowed", f"{name} IS NOT NULL AND {name} NOT IN ({', '.join(repr(v) for v in allowed)})"))
    codes = ", ".join(repr(s) for s in policy.US_STATES)
    nr = "CAST(regexp_extract(state, '([0-9]+)$', 1) AS INT)"
    named = f"b AS (SELECT * REPLACE (CASE WHEN {nr} % 5 = 0 THEN state ELSE list_extract([{codes}], {nr} % {len(policy.US_STATES)} + 1) END AS state) FROM bureau)"
    each = " UNION ALL ".join(f"SELECT '{f}' AS field, '{r}' AS rule, COUNT(*) AS n FROM b WHERE {p} HAVING COUNT(*) > 0" for f, r, p in parts)
    clean = " AND ".join(f"NOT COALESCE({p}, FALSE)" for _, _, p in parts)
    return f"WITH {named} {each} UNION ALL SELECT '' AS field, 'clean' AS rule, COUNT(*) AS n FROM b WHERE {clean} HAVING COUNT(*) > 0"


@query("gov1_violations", _violations_sql(), ("bureau",))
def q_violations(spark, sf):
    """GOV-1: rows per broken rule in the written violations table, and the clean rows split off in the same pass."""
    clean, broken = contract.write_split(state_named(tables.bureau(spark, sf)), _folder(spark, "contract"))
    counts = broken.groupBy("field", "rule").agg(F.count("*").alias("n"))
    return counts.unionByName(clean.groupBy(F.lit("").alias("field"), F.lit("clean").alias("rule")).agg(F.count("*").alias("n")))


_COLUMNS = [c.strip().split()[0] for c in files.BUREAU_CSV.split(",")]
_KEY = "CAST(customer_id AS BIGINT)"


def dirty_lines(df):
    """Bureau rows as CSV lines, some of them broken: a word for a number, a cell too many, an unreadable date."""
    k = F.col("customer_id").cast("long")
    cells = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in _COLUMNS}
    cells["income"] = F.when(k % 97 == 0, F.lit("much")).otherwise(cells["income"])
    cells["snapshot_date"] = F.when(k % 83 == 0, F.lit("31/31/1999")).otherwise(cells["snapshot_date"])
    line = F.concat_ws(",", *[cells[c] for c in _COLUMNS])
    return df.select(F.when(k % 89 == 0, F.concat(line, F.lit(",more"))).otherwise(line).alias("value"))


@query("src4_bureau_csv_rejects", f"""WITH k AS (SELECT *, {_KEY} % 97 = 0 OR {_KEY} % 89 = 0 AS bad, {_KEY} % 83 = 0 AS undated FROM bureau)
SELECT CASE WHEN bad THEN 'reject' WHEN undated THEN 'undated' ELSE 'row' END AS status, COUNT(*) AS n,
       CAST(COALESCE(SUM(CASE WHEN bad THEN 0 ELSE num_trades END), 0) AS BIGINT) AS num_trades, TRUE AS in_order FROM k GROUP BY 1""", ("bureau",))
def q_bureau_csv_rejects(spark, sf):
    """SRC-4/SRT-2: a dirty bureau CSV read once with types, rejects kept as text and unreadable dates coerced; the rows are written in date order
    (nulls last) and read back file by file: rows, trades, and whether each row's date is not before the one above it."""
    path, out = _folder(spark, "dirty"), _folder(spark, "sorted")
    dirty_lines(tables.bureau(spark, sf)).write.text(path)
    rows, rejects = files.read_bureau_csv_rejecting(spark, path, _folder(spark, "parsed"), header=False)
    splits.sorted_by_date(rows, "snapshot_date", "customer_id").write.parquet(out)
    back = spark.read.parquet(out).select("*", F.col("_metadata.file_name").alias("file"))
    # each file is a date range in ascending order: the earliest date of a file is not before the last of the file above
    spans = back.groupBy("file").agg(F.min("snapshot_date").alias("lo"), F.max("snapshot_date").alias("hi"))
    above = F.expr("max(hi) over (order by file rows between unbounded preceding and 1 preceding)")  # a row per file
    ordered = spans.withColumn("above", above).agg(F.coalesce(F.min(F.coalesce(F.col("lo") >= F.col("above"), F.lit(True))), F.lit(True)).alias("ok")).first()["ok"]
    counted = back.groupBy(F.when(F.col("snapshot_date").isNull(), "undated").otherwise("row").alias("status")).agg(
        F.count("*").alias("n"), F.sum("num_trades").cast("long").alias("num_trades"))
    bad = rejects.groupBy(F.lit("reject").alias("status")).agg(F.count("line").alias("n"), F.lit(0).cast("long").alias("num_trades"))
    return counted.unionByName(bad).withColumn("in_order", F.lit(ordered))

