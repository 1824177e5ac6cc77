"""Governance configuration as small DataFrames / Python values.

These tables are config, not data: their row count is fixed by the policy files,
so broadcasting them has a size bound by construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed values that must equal the reference's: reason-code policy
# (reason, description, feature, threshold), compared with >=.
REASON_RULES = [
    ("high_utilization", "High revolving credit utilization", "utilization_rate", 0.6),
    ("recent_inquiries", "Multiple recent credit inquiries", "inquiries_6m", 4.0),
    ("high_dti", "High debt-to-income ratio", "dti", 0.45),
    ("recent_delinquency", "Recent delinquency events", "delinq_12m", 1.0),
]

# Fixed values that must equal the reference's: metric gate thresholds.
GATE_AUC_MIN = 0.65
GATE_KS_MIN = 0.20
GATE_PSI_MAX = 0.10  # strict: psi < 0.10

# Fixed values that must equal the reference's: bureau data contract.
# (name, type, required, min, max, allowed, date format)
CONTRACT_PRIMARY_KEY = "customer_id"
US_STATES = [
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "IA", "ID", "IL", "IN", "KS", "KY",
    "LA", "MA", "MD", "ME", "MI", "MN", "MO", "MS", "MT", "NC", "ND", "NE", "NH", "NJ", "NM", "NV", "NY",
    "OH", "OK", "OR", "PA", "RI", "SC", "SD", "TN", "TX", "UT", "VA", "VT", "WA", "WI", "WV", "WY",
]
CONTRACT_FIELDS = [
    ("customer_id", "string", True, None, None, None, None),
    ("snapshot_date", "date", True, None, None, None, "yyyy-MM-dd"),
    ("income", "float", False, 0, None, None, None),
    ("utilization_rate", "float", False, 0, 1, None, None),
    ("num_trades", "integer", False, 0, None, None, None),
    ("delinq_12m", "integer", False, 0, None, None, None),
    ("inquiries_6m", "integer", False, 0, None, None, None),
    ("dti", "float", False, 0, None, None, None),
    ("cltv", "float", False, 0, None, None, None),
    ("employment_status", "category", False, None, None,
     ["employed", "self_employed", "unemployed", "student", "retired"], None),
    ("state", "category", False, None, None, US_STATES, None),
    ("age", "integer", False, 18, None, None, None),
    ("tenure_months", "integer", False, 0, None, None, None),
    ("risk_segment", "category", False, None, None, ["low", "med", "high"], None),
    ("defaulted", "integer", False, None, None, [0, 1], None),
]

# Fixed values that must equal the reference's: bureau model configuration.
CATEGORICAL_FEATURES = ["state", "employment_status", "risk_segment"]
NUMERIC_FEATURES = ["income", "utilization_rate", "num_trades", "delinq_12m", "inquiries_6m", "dti", "cltv"]
PASSTHROUGH_FEATURES = ["age", "tenure_months"]
TRAIN_WINDOW = ("2022-01-01", "2024-06-30")
VALID_WINDOW = ("2024-07-01", "2024-12-31")


def reason_rules(spark: SparkSession) -> DataFrame:
    """SRC-8: policy rules as rows (reason, description, feature, threshold)."""
    return spark.createDataFrame(
        REASON_RULES, "reason string, description string, feature string, threshold double"
    )
