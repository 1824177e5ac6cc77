"""Plan guards for scale: inspected on the executed physical plan of every registered query
(model-training queries excluded: their plans are spark.ml's).

* no cross join (CartesianProduct / BroadcastNestedLoopJoin);
* every SinglePartition exchange (one task) sits on an aggregate (bounded: one row per group
  of a tiny table, per partition, or a final total), never on raw data rows.
"""

import pytest

from riskloom.plans.registry import all_queries

from conftest import SF_SMALL

TRAINING = {"ml2_weighted_logreg", "ml9_variant_comparison", "ml8_model_table", "ev6_ks_sample", "ev8_ks_normal"}
NAMES = sorted(n for n in all_queries() if n not in TRAINING)


def plan_text(df) -> str:
    qe = df._jdf.queryExecution()
    return qe.executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_plan_has_no_cross_join_and_only_bounded_single_partition(spark, name):
    text = plan_text(all_queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, text
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            child = producer(lines, i + 1)
            assert "Aggregate" in child, f"{name}: one-task exchange over non-aggregated rows:\n{line}\n{child}"


def operator(line: str) -> str:
    return line.strip().lstrip(":+- ").lstrip("*(0123456789) ").split(" ")[0].split("[")[0]


def producer(lines: list[str], start: int) -> str:
    """First operator below ``start`` that is not a row-wise projection / filter / sort."""
    for line in lines[start:]:
        if operator(line) not in ("Project", "Filter", "Sort", "ColumnarToRow", "InputAdapter"):
            return line
    return ""
