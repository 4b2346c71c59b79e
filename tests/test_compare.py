import math

from pyspark.sql import functions as F

from tallyframe.model import SPAIN_EMPTY_PROVINCES, SPAIN_FULL_PROVINCES
from tallyframe.operators import clean, compare, rates
from tests.conftest import rows
from tests.fixtures import LAYOUT, dim, joined


def test_winner_per_unit(spark):
    out = compare.winner_per_unit(joined(spark), LAYOUT)
    got = {r.codigo: (r.party, r.votes) for r in out.collect() if r.codigo != 9}
    assert got[5] == ("and", 1000)
    assert got[3] == ("pp", 600)
    assert got[6] == (None, 0)


def test_group_winner_sums_first(spark):
    """The group winner is the party with most summed votes, not the largest single row."""
    win = {r.comunidad: (r.party, r.votes) for r in compare.winner_per_group(joined(spark), LAYOUT, "comunidad").collect()}
    top = {r.comunidad: (r.codigo, r.party, r.votes)
           for r in compare.max_row_per_group(joined(spark), LAYOUT, "comunidad").collect()}
    assert win["Galicia"] == ("psoe", 700)
    assert top["Galicia"] == (12, "pp", 500)
    assert win["Madrid"] == ("pp", 1300)
    assert top["Madrid"] == (1, "pp", 600)     # tie 600 with unit 3: lower key
    assert win["Castilla y León"] == (None, 0)


def test_representativeness(spark):
    """The answer carries the match flag and the population share."""
    rep = compare.representativeness(joined(spark), LAYOUT, "comunidad")
    got = {r.comunidad: r for r in rep.collect()}
    assert got["Madrid"].coincides is True and math.isclose(got["Madrid"].population_share, 60.0)
    assert got["Galicia"].coincides is False and got["Galicia"].unit_party == "pp"
    assert got["Galicia"].group_party == "psoe" and math.isclose(got["Galicia"].population_share, 50.0)
    assert got["Andalucía"].unit_party == "and" and got["Andalucía"].coincides is True
    assert got["Castilla y León"].coincides is None
    assert got["Aragón"].codigo == 8 and math.isclose(got["Aragón"].population_share, 50.0)


def test_representativeness_by_band(spark):
    rep = compare.representativeness(joined(spark), LAYOUT, "comunidad")
    out = rows(compare.representativeness_by_band(rep, 55.0), "share_band", "n_groups", "n_coinciding")
    # high: Madrid 60 (yes), Andalucía 55.6 (yes), CyL 100 (unknown); low: Galicia 50 (no), Aragón 50 (yes)
    assert out == [("high", 3, 2), ("low", 2, 1)]
    med = rows(compare.representativeness_by_band(rep), "share_band", "n_groups")
    assert sum(n for _, n in med) == 5 and len(med) == 2


def test_tag_by_lists_folds_both_sides(spark):
    """Accented cohort names match folded data and vice versa."""
    by_prov = rates.turnout_by_group(clean.fold_columns(joined(spark), ["provincia"]), LAYOUT, ["provincia"])
    out = compare.tag_by_lists(by_prov, "provincia", {"vacia": SPAIN_EMPTY_PROVINCES, "llena": SPAIN_FULL_PROVINCES})
    assert rows(out, "provincia", "cohort") == [
        ("Avila", "vacia"), ("Madrid", "llena"), ("Malaga", "llena"), ("Sevilla", "llena"),
        ("Soria", "vacia"), ("Teruel", "vacia")]


def test_size_cohorts_and_summary(spark):
    coh = compare.size_cohorts(joined(spark), LAYOUT, 2, 1000)
    got = rows(coh, "cohort", "codigo")
    assert got == [("large", 1), ("large", 5), ("small", 6), ("small", 12)]
    summ = {r.cohort: r for r in compare.cohort_summary(coh).collect()}
    assert summ["large"].n_units == 2 and summ["small"].n_units == 1   # census 0 has no turnout
    assert math.isclose(summ["large"].avg_turnout, 67.5)


def test_cohort_top_parties_uses_all_parties(spark):
    """The top parties come from every party column, not a fixed five."""
    coh = compare.size_cohorts(joined(spark), LAYOUT, 2, 1000)
    out = compare.cohort_top_parties(coh, LAYOUT, 2)
    large = [(r.party, r.votes) for r in out.filter("cohort = 'large'").orderBy("party_rank").collect()]
    assert large == [("and", 1000), ("pp", 600)]


def test_unit_top_parties(spark):
    out = compare.unit_top_parties(joined(spark).filter("codigo = 8"), LAYOUT, 3)
    assert [(r.party, r.votes, r.party_rank) for r in out.orderBy("party_rank").collect()] == [
        ("pp", 40, 1), ("podemosiuequo", 40, 2), ("cs", 20, 3)]


def test_cohort_party_wins_and_turnout_by_winner(spark):
    coh = compare.size_cohorts(joined(spark), LAYOUT, 2, 1000)
    assert rows(compare.cohort_party_wins(coh, LAYOUT), "cohort", "party", "n_units") == [
        ("large", "and", 1), ("large", "pp", 1), ("small", "pp", 1)]   # unit 6 has no winner
    tw = {r.party: r.n_units for r in compare.turnout_by_winner(joined(spark), LAYOUT).collect()}
    assert tw["and"] == 1 and tw["psoe"] == 4


def test_turnout_share_corr(spark):
    out = {r.comunidad: r for r in compare.turnout_share_corr(joined(spark), LAYOUT, "comunidad").collect()}
    assert out["Galicia"].n_units == 3
    assert out["Galicia"].corr_turnout_share is not None


def test_operators_are_pure(spark):
    """Calling an operator twice gives the same answer; inputs are not rebound."""
    a = compare.representativeness(joined(spark), LAYOUT, "comunidad").orderBy("comunidad").collect()
    b = compare.representativeness(joined(spark), LAYOUT, "comunidad").orderBy("comunidad").collect()
    assert a == b
    assert dim(spark).columns == ["codigo", "municipio", "provincia", "comunidad", "poblacion"]


def test_unit_spread_rows_group_by_unit(spark):
    w = compare.winner_per_unit(joined(spark).groupBy("codigo", "municipio", "provincia", "comunidad").agg(
        *[F.sum(p).alias(p) for p in LAYOUT.parties]), LAYOUT)
    assert {r.codigo: r.party for r in w.collect()}[9] == "pp"


def test_representativeness_by_several_bands(spark):
    rep = compare.representativeness(joined(spark), LAYOUT, "comunidad")
    out = rows(compare.representativeness_by_band(rep, [50.0, 58.0]), "share_band", "n_groups", "n_coinciding")
    # shares: Galicia 50, Aragón 50, Andalucía 55.6, Madrid 60, CyL 100
    assert out == [("[50, 58)", 3, 2), ("[58, inf)", 2, 1)]
