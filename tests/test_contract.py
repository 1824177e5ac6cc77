"""Contract validation on hand-made bureau rows: one clean, one broken per rule, one duplicate key."""

import datetime as dt

from riskloom.operators import contract

COLS = ("customer_id string, snapshot_date date, income double, utilization_rate double, num_trades int, "
        "delinq_12m int, inquiries_6m int, dti double, cltv double, employment_status string, state string, "
        "age int, tenure_months int, risk_segment string, defaulted int")
CLEAN = ["C1", dt.date(2024, 1, 1), 50000.0, 0.5, 3, 0, 1, 0.3, 0.4, "employed", "IL", 40, 12, "low", 0]
BREAKS = {
    "customer_id": None, "snapshot_date": None, "income": -1.0, "utilization_rate": 1.5, "num_trades": -1,
    "delinq_12m": -1, "inquiries_6m": -1, "dti": -0.1, "cltv": -0.2, "employment_status": "pirate",
    "state": "XX", "age": 17, "tenure_months": -3, "risk_segment": "extreme", "defaulted": 2,
}
RULE = {"customer_id": "required", "snapshot_date": "required", "utilization_rate": "max",
        "employment_status": "allowed", "state": "allowed", "risk_segment": "allowed", "defaulted": "allowed"}


def test_each_broken_rule_is_counted_once(spark):
    names = [c.split()[0] for c in COLS.split(", ")]
    rows = [list(CLEAN)]
    for i, (field, bad) in enumerate(BREAKS.items()):
        r = list(CLEAN)
        r[0] = f"B{i}"
        r[names.index(field)] = bad
        rows.append(r)
    rows.append(list(CLEAN))  # duplicate key C1
    df = spark.createDataFrame(rows, COLS)
    got = {(r.field, r.rule): r.violations for r in contract.validate(df).collect()}
    for field in BREAKS:
        assert got[(field, RULE.get(field, "min"))] == 1, field
    assert sum(got.values()) == len(BREAKS)
    k = contract.key_summary(df).first()
    assert (k.null_keys, k.duplicated_keys, k.rows_with_duplicated_key) == (1, 1, 2)


def test_text_columns_get_type_and_format_rules(spark):
    df = spark.createDataFrame([("C1", "2024-01-01", "12"), ("C2", "01/02/2024", "x")],
                               "customer_id string, snapshot_date string, age string")
    fields = [("customer_id", "string", True, None, None, None, None),
              ("snapshot_date", "date", True, None, None, None, "yyyy-MM-dd"),
              ("age", "integer", False, 18, None, None, None)]
    got = {(r.field, r.rule): r.violations for r in contract.validate(df, fields).collect()}
    assert got[("snapshot_date", "format")] == 1
    assert got[("age", "type")] == 1
    assert got[("age", "min")] == 1
