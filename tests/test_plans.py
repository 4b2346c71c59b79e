"""Plan checks on the registered queries: no Python evaluation, pruned and
pushed-down scans, bounded top-n and per-group limits, no cross joins."""

import pytest

from tallyframe.plans import registry
from tallyframe.operators import joins
from tallyframe.sources import parquet
from tests.conftest import SF_SMALL

BATCH = [n for n in registry.REGISTRY if not n.endswith("roundtrip") and not n.startswith("stream_")]


def plan_of(df, executed=False):
    qe = df._jdf.queryExecution()
    return qe.executedPlan().toString() if executed else qe.sparkPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_cartesian(spark, name):
    plan = plan_of(registry.REGISTRY[name](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"


def test_scan_is_pruned_and_filtered(spark):
    assert "ReadSchema: struct<user_id:bigint>" in plan_of(registry.join_coverage(spark, SF_SMALL))
    dim = parquet.read_table(spark, SF_SMALL, "customer", ["c_custkey"])
    fact = parquet.read_table(spark, SF_SMALL, "orders", ["o_custkey", "o_orderstatus"]).where("o_orderstatus = 'F'")
    plan = plan_of(joins.join_coverage(dim, fact, "c_custkey", "o_custkey"))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plan
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string>" in plan


def test_base_aggregates_orders_before_join(spark):
    plan = plan_of(registry.dim_fact_join(spark, SF_SMALL))
    # partial aggregate on the orders scan, i.e. below the join
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string,o_totalprice:double,o_orderpriority:string>" in plan
    assert "partial_sum" in plan or "partial_count" in plan


def test_top_n_is_take_ordered(spark):
    for name in ("population_top10", "turnout_top10", "concentration_top10"):
        assert "TakeOrderedAndProject" in plan_of(registry.REGISTRY[name](spark, SF_SMALL)), name


def test_first_per_group_uses_group_limit(spark):
    plan = plan_of(registry.largest_unit_per_group(spark, SF_SMALL))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_rollup_is_one_aggregate(spark):
    plan = plan_of(registry.turnout_rollup(spark, SF_SMALL))
    assert plan.count("Expand") == 1


def test_unpivot_is_narrow(spark):
    plan = plan_of(registry.unpivot_parties(spark, SF_SMALL))
    assert "Expand" in plan


def test_hits_or_top_uses_subquery(spark):
    plan = plan_of(registry.unanimous_or_top10(spark, SF_SMALL), executed=True)
    assert "Subquery" in plan or "subquery" in plan
