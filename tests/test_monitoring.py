"""Stored periods, the violations table and rejected CSV lines on hand-made rows."""

import shutil

import pytest
from pyspark.sql import functions as F

from riskloom.operators import contract, drift
from riskloom.sources import files


def test_a_period_is_merged_without_reading_the_others(spark, tmp_path):
    store = str(tmp_path / "store")
    rows = [("p1", float(k % 7), 1.0) for k in range(140)] + [("p2", float(k % 5), None) for k in range(90)] + [(None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "p string, x double, y double")
    drift.add_periods(df.where("p = 'p1'"), ["x", "y"], "p", store)
    kept = sorted(f.name for f in (tmp_path / "store" / "period=p1").iterdir())
    for _ in range(2):  # merged again: replaced, not added
        drift.add_periods(df.where("p = 'p2' or p is null"), ["x", "y"], "p", store)
    assert sorted(f.name for f in (tmp_path / "store" / "period=p1").iterdir()) == kept
    got = {(r.feature, r.period): r for r in drift.psi_over_periods(spark, store, "p1", bins=4).collect()}
    assert set(got) == {("x", "p1"), ("y", "p1"), ("x", "p2")} and got["x", "p1"].psi == 0.0 and got["x", "p2"].n == 90
    stacked = drift.stack_features(df, ["x"], F.when(F.col("p") == "p1", "expected").otherwise("actual")).where("period is not null")
    one = drift.psi_by_feature(stacked.join(spark.createDataFrame([("expected",), ("actual",)], "period string"), "period"), bins=4)
    all_at_once = drift.psi_by_feature(drift.stack_features(df.where("p is not null"), ["x"], F.when(F.col("p") == "p1", "expected").otherwise("actual")), bins=4)
    assert got["x", "p2"].psi == pytest.approx(all_at_once.first().psi, abs=1e-9) and one.count() == 1
    shutil.rmtree(tmp_path / "store" / "period=p2")
    assert drift.psi_over_periods(spark, store, "p1").count() == 2


def test_violations_table_and_clean_rows(spark, tmp_path):
    fields = [("id", "string", True, None, None, None, None), ("age", "integer", False, 18, 99, None, None), ("seg", "category", False, None, None, ["a", "b"], None)]
    df = spark.createDataFrame([("1", 20, "a"), (None, 10, "c"), ("3", None, None), ("4", 100, "b")], "id string, age int, seg string")
    clean, broken = contract.write_split(df, str(tmp_path / "out"), fields)
    assert sorted(r.id for r in clean.collect()) == ["1", "3"]
    found = {(r.field, r.rule, r.id) for r in broken.collect()}
    assert found == {("id", "required", None), ("age", "min", None), ("seg", "allowed", None), ("age", "max", "4")}
    want = {(r.field, r.rule): r.violations for r in contract.validate(df, fields).collect()}
    assert {(r.field, r.rule): r["count"] for r in broken.groupBy("field", "rule").count().collect()} == {k: v for k, v in want.items() if v}


def test_broken_csv_lines_are_rejected_and_dates_coerced(spark, tmp_path):
    good = "c1,2024-01-05,10.5,0.5,1,0,0,0.1,0.2,employed,CA,30,12,low,0"
    lines = [",".join(c.split()[0] for c in files.BUREAU_CSV.split(", ")), good, good.replace("10.5", "much"), good + ",more", "c9,2024-01-01",
             good.replace("2024-01-05", "05/01/2024"), good.replace("10.5", "")]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("\n".join(lines) + "\n")
    rows, rejects = files.read_bureau_csv_rejecting(spark, str(tmp_path / "in"), str(tmp_path / "store"))
    assert sorted(str(r.snapshot_date) for r in rows.collect()) == ["2024-01-05", "2024-01-05", "None"]
    assert sorted(r.line for r in rejects.collect()) == sorted([lines[2], lines[3], lines[4]])
