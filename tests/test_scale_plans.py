"""Static plans as a large cluster would see them.

With AQE off and a broadcast limit that only the fixed-size dimensions
(nation, region) pass, ``customer`` and ``orders`` behave as if they were
huge.  The counts below are the shuffles each query needs: the base costs two
(orders pre-aggregated by customer key, customer by customer key); per-unit
work reuses that partitioning; group answers add one partial-aggregated
shuffle.
"""

import re

import pytest

from tallyframe.plans import registry
from tests.conftest import SF_SMALL

EXPECTED = {
    "dim_fact_join": 2,
    "winner_per_unit": 2,
    "unit_top_parties": 2,
    "party_share_wide": 2,
    "population_top10": 2,
    "concentration_top10": 2,
    "representativeness": 3,
    "population_by_group": 3,
    "largest_unit_per_group": 3,
    "max_row_per_group": 3,
    "winner_per_group": 3,
    "turnout_by_province": 4,       # + range exchange of the final sort (one row per province)
    "turnout_rollup": 3,
}

# Written once and read back, so what is left to plan has no join of the base.
STORED = {
    "share_of_group": 0,            # totals broadcast by their known size
    "unanimous_or_top10": 0,
    "unanimous_or_top10_contested": 0,
}


@pytest.fixture
def large_tables(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "10240", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange (hashpartitioning\([^)]*\)|SinglePartition|rangepartitioning\([^)]*\))", plan), plan


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_shuffle_count_at_scale(large_tables, name):
    ex, plan = exchanges(registry.REGISTRY[name](large_tables, SF_SMALL))
    assert len(ex) == EXPECTED[name], (name, ex)
    assert "BroadcastExchange" in plan          # nation and region stay broadcast
    assert not any("nationkey" in e or "regionkey" in e for e in ex)


@pytest.mark.parametrize("name", sorted(STORED))
def test_stored_steps_are_not_shuffled_again(large_tables, name):
    ex, plan = exchanges(registry.REGISTRY[name](large_tables, SF_SMALL))
    keyed = [e for e in ex if e.startswith("hash")]
    assert len(keyed) == STORED[name], (name, ex)
    assert "orders.parquet" not in plan and "SortMergeJoin" not in plan


def test_group_limit_runs_before_the_shuffle(large_tables):
    _, plan = exchanges(registry.REGISTRY["max_row_per_group"](large_tables, SF_SMALL))
    below = plan.split("Exchange hashpartitioning(community", 1)[1]
    assert "WindowGroupLimit" in below and "Partial" in below
