"""Every registered query against its SQL, and the shape of its plan."""

import pytest

from contract import ORACLES, QUERIES
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"

# A cross join, a nested loop or a row-at-a-time Python step would not scale.
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"]


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    assert compare(df, duck, ORACLES[name]) == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [f for f in FORBIDDEN if f in plan]


def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["outlier_bounds"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_suppkey:bigint,l_shipdate:timestamp_ntz>" in plan
    plan = QUERIES["merge_sync"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderstatus), Not(EqualTo(o_orderstatus,F))" in plan


def test_expected_cob_filter_runs_before_the_paths_are_built(spark):
    df = QUERIES["expected_datasets"](spark, SF).where("cob_id = 20010105")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    head = plan[: plan.index("Generate")]
    assert "Filter (cob_id" in head.split("\n")[-2] or "cob_id" in head.split("Filter")[-1][:40]
    assert df.count() > 0
