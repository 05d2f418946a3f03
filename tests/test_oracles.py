"""Every registered query against its SQL oracle, on the smallest tables."""

import pytest

from __spark_entry__ import entry
from crawldelta.checks.registry import ORACLES, QUERIES
from tests.oracle_check import compare, connect

# Rightly without rows on the smallest tables.
MAY_BE_EMPTY: set[str] = set()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, sf_dir, name):
    problem = compare(spark, con, sf_dir, name)
    assert problem is None or problem == "no rows" and name in MAY_BE_EMPTY


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_gives_rows(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(("a", "p9", "p10"))))
def test_no_cross_or_nested_loop_join(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
