"""Every registered query equals its SQL twin, in plain plans."""

import pytest

from checks.compare import compare
from checks.oracles import all_oracles
from checks.queries import all_queries
from conftest import SMALL

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "MapInArrow")
NAMES = sorted(all_queries())


def test_every_query_has_a_twin():
    assert set(all_oracles()) == set(NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_equals_sql(spark, name):
    assert compare(spark, SMALL, name) == ""


@pytest.mark.parametrize(
    "name", ["ltv_stage", "ltv_runner", "reorder_sql", "reorder_runner", "cumulative_share", "upsert_ltv", "audit_stats"]
)
def test_plan_has_no_python_and_no_single_task_window(spark, name):
    plan = all_queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in PYTHON_NODES)
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Window [" in line:
            below = "\n".join(lines[i + 1 : i + 4])
            assert "SinglePartition" not in below
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = all_queries()["daily_sales"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan
    assert "l_comment" not in plan and "l_shipdate" not in plan


@pytest.mark.parametrize(
    "name", ["upsert_ltv", "upsert_ltv_unconditional", "upsert_reorder", "upsert_counts", "customer_ltv_job", "ltv_refused", "merge_buckets", "change_stream"]
)
def test_merges_equal_sql_where_some_rows_are_refused(spark, name):
    assert compare(spark, "/root/testdata/sf0.01", name) == ""
