import math

from pyspark.sql import functions as F

from tallyframe.operators import rates
from tests.conftest import rows
from tests.fixtures import LAYOUT, joined


def test_turnout_and_abstention(spark):
    df = rates.with_turnout(joined(spark), LAYOUT)
    got = {r.codigo: (r.turnout, r.abstention) for r in df.collect() if r.codigo != 9}
    assert got[1] == (75.0, 25.0)
    assert got[6] == (None, None)   # census 0 (D9)
    for t, a in got.values():
        if t is not None:
            assert math.isclose(t + a, 100.0)


def test_turnout_by_group_is_ratio_of_sums(spark):
    out = rates.turnout_by_group(joined(spark), LAYOUT, ["provincia"])
    got = {r.provincia: (r.total_voters, r.total_census, r.turnout_index) for r in out.collect()}
    assert got["Madrid"] == (2700, 3600, 75.0)
    assert got["Ávila"] == (0, 0, None)
    assert got["Huesca"] == (110, 200, 55.00000000000001)  # two rows of one unit, summed


def test_rollup_levels(spark):
    out = rates.turnout_rollup(joined(spark), LAYOUT, ["comunidad", "provincia"])
    levels = rows(out.groupBy("level").count(), "level", "count")
    n_prov = joined(spark).select("comunidad", "provincia").distinct().count()
    n_com = joined(spark).select("comunidad").distinct().count()
    assert levels == [(0, n_prov), (1, n_com), (2, 1)]
    total = out.filter("level = 2").collect()[0]
    assert total.total_census == sum(r.censo for r in joined(spark).collect())


def test_population_counts_each_unit_once(spark):
    """A2: a unit reported on two rows contributes its population once."""
    out = rates.population_by_group(joined(spark), LAYOUT, "comunidad")
    got = {r.comunidad: (r.group_population, r.n_units) for r in out.collect()}
    assert got["Aragón"] == (600, 2)
    assert got["Madrid"] == (5000, 3)
    assert got["Castilla y León"] == (500, 2)   # null population adds nothing


def test_share_of_group_sums_to_100(spark):
    out = rates.share_of_group(joined(spark), LAYOUT, "comunidad")
    sums = out.groupBy("comunidad").agg(F.sum("population_share").alias("s")).collect()
    for r in sums:
        assert math.isclose(r.s, 100.0, rel_tol=1e-9)
    assert out.count() == joined(spark).select("codigo").distinct().count()
