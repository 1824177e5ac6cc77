"""Golden checks from the reference's own small fixtures (values copied here)."""

import json

from pyspark.sql import functions as F

from riskloom.operators import etl, governance
from riskloom.sources import files


def test_basic_clean_five_rows(spark):
    # 5-row raw loan file: one NULL FICO (103), one NULL status (105)
    rows = [(101, 720.0, 15000, "Current"), (102, 680.0, 20000, "Default"), (103, None, 18000, "Default"),
            (104, 590.0, 12000, "Current"), (105, 640.0, 22000, None)]
    df = spark.createDataFrame(rows, "customer_id int, fico_score double, loan_amount int, loan_status string")
    out = {r.customer_id: r for r in etl.basic_clean(df).collect()}
    assert sorted(out) == [101, 102, 103, 104]
    assert out[103].fico_score == 600.0
    assert {k: v.loan_status_flag for k, v in out.items()} == {101: 0, 102: 1, 103: 1, 104: 0}


GOLDEN = [  # inputs ..., expected cltv, util_bin, delinq_flag, high_risk_flag
    (1001, 705, 39199.0, 12, "Family", 3577.0, 0, 0.82, 0, -35622.0, "High", 0, 0),
    (1002, 673, 25912.0, 12, "Business", 1635.0, 0, 0.74, 0, -24277.0, "High", 0, 1),
    (1003, 712, 39919.0, 6, "Business", 5397.0, 0, 0.91, 0, -37220.5, "High", 0, 1),
    (1004, 756, 39981.0, 12, "Business", 6449.0, 0, 0.68, 0, -33532.0, "High", 0, 1),
    (1005, 668, 18235.0, 24, "Family", 3126.0, 1, 0.53, 1, -11983.0, "Medium", 1, 1),
    (1006, 759, 44757.0, 12, "Business", 7999.0, 0, 0.67, 0, -36758.0, "High", 0, 1),
    (1007, 657, 36547.0, 12, "Business", 3654.0, 1, 0.49, 1, -32893.0, "Medium", 1, 1),
    (1008, 707, 46810.0, 12, "Family", 4351.0, 0, 0.78, 0, -42459.0, "High", 0, 0),
    (1009, 584, 22276.0, 6, "Business", 1922.0, 0, 0.84, 1, -21315.0, "High", 0, 1),
    (1010, 707, 34923.0, 12, "Business", 4608.0, 0, 0.73, 0, -30315.0, "High", 0, 1),
]


def test_engineered_features_match_golden_sample(spark):
    df = spark.createDataFrame(
        [g[:9] for g in GOLDEN],
        "customer_id int, fico_score int, loan_amount double, tenure_months int, plan_type string, "
        "monthly_income double, loan_status_flag int, credit_utilization double, has_bankruptcy int")
    got = {r.customer_id: (r.cltv, r.util_bin, r.delinq_flag, r.high_risk_flag)
           for r in etl.engineer_features(df).collect()}
    for g in GOLDEN:
        assert got[g[0]] == (g[9], g[10], g[11], g[12]), g[0]


def test_null_semantics(spark):
    df = spark.createDataFrame(
        [(None, "Business", 0, None, None), (None, "Family", 0, 0.2, 1), (500.0, "Family", 0, 0.65, 0)],
        "fico_score double, plan_type string, has_bankruptcy int, credit_utilization double, loan_status_flag int")
    df = df.withColumns({"monthly_income": F.lit(1.0), "tenure_months": F.lit(12), "loan_amount": F.lit(1.0)})
    r = etl.engineer_features(df).collect()
    assert [x.high_risk_flag for x in r] == [1, 0, 1]
    assert [x.util_bin for x in r] == ["High", "Low", "High"]
    assert [x.delinq_flag for x in r] == [None, 1, 0]


REQUESTS = [  # customer_id, snapshot_date, utilization_rate, inquiries_6m, dti, delinq_12m
    ("C1049830", "2024-08-12T00:00:00", 0.2544680564765006, 2, 0.3501004588534328, 0),
    ("C1018602", "2024-08-10T00:00:00", 0.2668260083909105, 0, 0.1919311211692153, 0),
    ("C1003237", "2024-12-25T00:00:00", 0.1197187998936553, 2, 0.2750035101916529, 0),
    ("C1006915", "2024-09-15T00:00:00", 0.2957466070928717, 3, 0.4045552350935553, 0),
    ("C1001015", "2024-07-06T00:00:00", 0.2149662822922309, 1, 0.3494373629264971, 0),
    ("C1032315", "2024-08-30T00:00:00", 0.3560235874796097, 1, 0.5960970662654357, 0),
    ("C1040074", "2024-08-16T00:00:00", 0.0956959007439857, 0, 0.2039539546973912, 0),
    ("C1011000", "2024-07-19T00:00:00", 0.1673750150859382, 1, 0.2965774199407192, 1),
    ("C1026686", "2024-07-12T00:00:00", 0.1738474336846991, 0, 0.2703486278597629, 0),
    ("C1017535", "2024-12-15T00:00:00", 0.3272458356563262, 0, 0.3923868974378051, 0),
]
EXPECTED_REASONS = {"C1032315": ["high_dti"], "C1011000": ["recent_delinquency"]}


def test_reason_codes_match_sample_response(spark, tmp_path):
    doc = {"records": [
        {"customer_id": c, "snapshot_date": d, "income": 50000.0, "utilization_rate": u, "num_trades": 5,
         "delinq_12m": dq, "inquiries_6m": i, "dti": dti, "cltv": 0.5, "employment_status": "employed",
         "state": "IL", "age": 40, "tenure_months": 100}
        for c, d, u, i, dti, dq in REQUESTS]}
    path = tmp_path / "request.json"
    path.write_text(json.dumps(doc, indent=2))
    req = files.read_decision_requests(spark, str(path))
    assert req.count() == 10
    assert req.where(F.col("snapshot_date").isNull()).count() == 0
    decided = governance.decisions(req, "customer_id", {"dti": 1.0}, 0.0, "v1")
    got = {r.customer_id: r.reason_codes for r in decided.collect()}
    for c, *_ in REQUESTS:
        assert got[c] == EXPECTED_REASONS.get(c, []), c
    doc_df = governance.decision_document(decided.withColumn("request_id", F.lit("r1")), "request_id", "customer_id")
    one = doc_df.collect()
    assert len(one) == 1 and len(one[0].scores) == 10
    assert one[0].reason_codes["C1011000"] == ["recent_delinquency"]
