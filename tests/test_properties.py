"""Properties from the survey's test strategy, on the fixtures and the test bed."""

from pyspark.sql import functions as F

from tallyframe.operators import rank, shape
from tallyframe.plans.testbed import TESTBED, results_wide
from tests.conftest import SF_SMALL
from tests.fixtures import LAYOUT, fact


def test_unpivot_then_sum_equals_wide_sum(spark):
    wide = fact(spark).agg(*[F.sum(p).alias(p) for p in LAYOUT.parties]).collect()[0].asDict()
    long = shape.unpivot_parties(fact(spark), ["codigo"], LAYOUT.parties)
    summed = {r.party: r.s for r in long.groupBy("party").agg(F.sum("votes").alias("s")).collect()}
    assert summed == wide


def test_unpivot_labels_are_column_names(spark):
    long = shape.unpivot_parties(fact(spark), ["codigo"], LAYOUT.parties, keep_nulls=True)
    assert {r.party for r in long.select("party").distinct().collect()} == set(LAYOUT.parties)
    assert long.count() == fact(spark).count() * len(LAYOUT.parties)


def test_top_n_is_a_bounded_subset(spark):
    base = results_wide(spark, SF_SMALL)
    top = rank.top_n(base, TESTBED.population, 7, [TESTBED.unit_id])
    assert top.count() == 7
    assert top.join(base, on=base.columns, how="left_anti").count() == 0
    threshold = top.agg(F.min(TESTBED.population)).collect()[0][0]
    assert base.filter(F.col(TESTBED.population) > threshold).count() <= 7


def test_party_shares_sum_to_100(spark):
    base = results_wide(spark, SF_SMALL)
    shares = shape.party_shares_wide(base, TESTBED)
    total = sum(F.col(f"{p}_pct") for p in TESTBED.parties)
    bad = shares.filter(F.abs(total - F.lit(100.0)) > 1e-9).count()
    assert bad == 0          # on the test bed valid = Σ parties
