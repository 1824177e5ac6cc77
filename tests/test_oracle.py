"""Every registered query against its DuckDB oracle (sf0.001, whole tables)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import compare as compare_tool  # noqa: E402
from compare import compare, duck  # noqa: E402
from riskloom.plans.registry import all_oracles, all_queries  # noqa: E402

from conftest import SF_SMALL  # noqa: E402

ORACLES = all_oracles()
compare_tool.STRICT = True  # floats must be bit-identical, as a value hash would see them


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    msg, ok = compare(spark, con, SF_SMALL, name, all_queries()[name], ORACLES[name])
    assert ok, msg


def test_every_query_has_a_docstring_and_runs_small(spark):
    qs = all_queries()
    assert len(qs) >= 30
    missing = [n for n in qs if n not in ORACLES]
    # the queries without an oracle are the model / stream ones, listed here on purpose
    assert all(n.startswith(("ml", "ev1", "ev2", "ev6", "ev8", "gov5", "spl3", "spl1_random")) for n in missing), missing
