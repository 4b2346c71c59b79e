from pyspark.sql import functions as F

from tallyframe.operators import rank
from tests.conftest import rows
from tests.fixtures import dim


def test_top_n_tie_break(spark):
    out = rank.top_n(dim(spark), "poblacion", 4, ["codigo"])
    assert [r.codigo for r in out.collect()] == [1, 5, 4, 2]   # 2 and 3 tie at 1000: lower key first


def test_top_n_invariant_under_repartition(spark):
    """The same rows whatever the partitioning or row order."""
    base = rank.top_n(dim(spark), "poblacion", 5, ["codigo"]).collect()
    for n in (1, 3, 7):
        shuffled = dim(spark).repartition(n).orderBy(F.rand(seed=n))
        assert rank.top_n(shuffled, "poblacion", 5, ["codigo"]).collect() == base


def test_bottom_n_nulls_last(spark):
    """O2: a null population does not fill the bottom list."""
    out = rank.bottom_n(dim(spark), "poblacion", 3, ["codigo"])
    assert [r.codigo for r in out.collect()] == [10, 8, 9]


def test_top_n_per_group(spark):
    out = rank.first_per_group(dim(spark), "comunidad", "poblacion", ["codigo"])
    assert rows(out, "comunidad", "codigo") == [
        ("Andalucía", 5), ("Aragón", 8), ("Castilla y León", 6), ("Castilla-La Mancha", 10),
        ("Galicia", 12), ("Madrid", 1)]


def test_top_n_per_group_with_rank(spark):
    out = rank.top_n_per_group(dim(spark), "comunidad", "poblacion", 2, ["codigo"], rank_col="r")
    madrid = [(r.codigo, r.r) for r in out.filter("comunidad = 'Madrid'").orderBy("r").collect()]
    assert madrid == [(1, 1), (2, 2)]


def test_hits_or_top_n_both_branches(spark):
    """One plan answers both branches; no driver-side count."""
    df = dim(spark)
    hits = rank.hits_or_top_n(df, F.col("poblacion") >= 2500, "poblacion", 2, ["codigo"])
    assert sorted(r.codigo for r in hits.collect()) == [1, 5]
    none = rank.hits_or_top_n(df, F.col("poblacion") > 10**6, "poblacion", 2, ["codigo"])
    assert [r.codigo for r in none.collect()] == [1, 5]
    none2 = rank.hits_or_top_n(df, F.col("poblacion") > 10**6, "poblacion", 3, ["codigo"])
    assert sorted(r.codigo for r in none2.collect()) == [1, 4, 5]


def test_hits_or_top_n_plan_has_no_cross_join(spark):
    out = rank.hits_or_top_n(dim(spark), F.col("poblacion") > 10**6, "poblacion", 2, ["codigo"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "TakeOrderedAndProject" in plan
