"""The report questions, each as a function of the joined results table.

``REPORTS`` maps a name to ``(fn(base, params) -> DataFrame, bounded)``; ``bounded``
marks outputs whose size does not grow with the data (top-n lists, one row
per group), which may be written as a single file.  :func:`run_reports`
answers all of them from one materialised copy of the base, so the joins
and the fact aggregation run once per bundle, not once per question.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.numeric import pct
from tallyframe.model import Layout
from tallyframe.operators import compare, rank, rates, shape
from tallyframe.plans import testbed
from tallyframe.sources import delimited, tables


@dataclass(frozen=True)
class ReportParams:
    """Everything a report needs besides the data."""
    layout: Layout
    top_n: int = 10
    cohort_size: int = 20
    small_below: float = 10_000
    top_parties: int = 5
    band_cut: float | Sequence[float] | None = None   # None: median share across groups
    province_cohorts: Mapping[str, Sequence[str]] = field(default_factory=dict)

    @property
    def place(self) -> list[str]:
        L = self.layout
        return [L.unit_id, L.unit, L.community, L.province]

    @property
    def cohort_cols(self) -> list[str]:
        L = self.layout
        return [L.unit_id, L.unit, L.province, L.community, L.population, "turnout", *L.parties]


TESTBED_PARAMS = ReportParams(
    layout=testbed.TESTBED, top_n=testbed.TOP_N, cohort_size=testbed.COHORT_SIZE,
    small_below=testbed.SMALL_BELOW, top_parties=testbed.TOP_PARTIES, band_cut=testbed.BAND_CUT,
    province_cohorts=testbed.PROVINCE_COHORTS)

ReportFn = Callable[..., DataFrame]
REPORTS: dict[str, tuple[ReportFn, bool]] = {}


def report(bounded: bool):
    def register(fn: ReportFn) -> ReportFn:
        REPORTS[fn.__name__] = (fn, bounded)
        return fn
    return register


# ----------------------------------------------------------------- rankings
@report(bounded=True)
def population_top10(base, p: ReportParams = TESTBED_PARAMS):
    return rank.top_n(base.select(*p.place, p.layout.population), p.layout.population, p.top_n, [p.layout.unit_id])


@report(bounded=True)
def population_bottom10(base, p: ReportParams = TESTBED_PARAMS):
    return rank.bottom_n(base.select(*p.place, p.layout.population), p.layout.population, p.top_n, [p.layout.unit_id])


def _turnout_units(base, p: ReportParams = TESTBED_PARAMS):
    return rates.with_turnout(base.filter(F.col(p.layout.census) > 0), p.layout).select(*p.place, "turnout", "abstention")


@report(bounded=True)
def turnout_top10(base, p: ReportParams = TESTBED_PARAMS):
    return rank.top_n(_turnout_units(base, p), "turnout", p.top_n, [p.layout.unit_id])


@report(bounded=False)
def turnout_top10_ties(base, p: ReportParams = TESTBED_PARAMS):
    """All units tied with the tenth are listed."""
    # Read twice: once for the ten largest rates, once for the units that have them.
    units = tables.materialize(_turnout_units(base, p), "turnout_units")
    return rank.top_n_with_ties(units, "turnout", p.top_n)


@report(bounded=True)
def abstention_top10(base, p: ReportParams = TESTBED_PARAMS):
    return rank.top_n(_turnout_units(base, p), "abstention", p.top_n, [p.layout.unit_id])


# ----------------------------------------------------------------- rates by group
@report(bounded=True)
def turnout_by_province(base, p: ReportParams = TESTBED_PARAMS):
    return rates.turnout_by_group(base, p.layout, [p.layout.province]) \
        .orderBy(F.col("turnout_index").desc_nulls_last(), p.layout.province)


@report(bounded=True)
def turnout_rollup(base, p: ReportParams = TESTBED_PARAMS):
    return rates.turnout_rollup(base, p.layout, [p.layout.community, p.layout.province])


@report(bounded=True)
def cohort_by_list(base, p: ReportParams = TESTBED_PARAMS):
    return compare.tag_by_lists(rates.turnout_by_group(base, p.layout, [p.layout.province]), p.layout.province, p.province_cohorts)


# ----------------------------------------------------------------- shape, concentration
@report(bounded=False)
def party_share_wide(base, p: ReportParams = TESTBED_PARAMS):
    return shape.party_shares_wide(base, p.layout)


@report(bounded=False)
def unpivot_parties(base, p: ReportParams = TESTBED_PARAMS):
    return shape.unpivot_parties(base, [p.layout.unit_id, p.layout.unit, p.layout.province, p.layout.community], p.layout.parties)


def _concentration(base, p: ReportParams = TESTBED_PARAMS):
    df = shape.with_winner(base.filter(F.col(p.layout.valid) > 0), p.layout)
    return df.select(*p.place, F.col("winner").alias("party"), "winner_votes", p.layout.valid,
                     pct("winner_votes", p.layout.valid).alias("max_share"))


def _concentration_out(df, p: ReportParams):
    return df.select(*p.place, "party", "max_share")


def _unanimous_hit(p: ReportParams):
    return F.col("winner_votes") == F.col(p.layout.valid)


@report(bounded=True)
def concentration_top10(base, p: ReportParams = TESTBED_PARAMS):
    return _concentration_out(rank.top_n(_concentration(base, p), "max_share", p.top_n, [p.layout.unit_id]), p)


@report(bounded=False)
def unanimous_units(base, p: ReportParams = TESTBED_PARAMS):
    return _concentration_out(_concentration(base, p).filter(_unanimous_hit(p)), p)


@report(bounded=False)
def unanimous_or_top10(base, p: ReportParams = TESTBED_PARAMS):
    conc = tables.materialize(_concentration(base, p), "concentration")    # read by both branches and the probe
    return _concentration_out(rank.hits_or_top_n(conc, _unanimous_hit(p), "max_share", p.top_n, [p.layout.unit_id]), p)


@report(bounded=False)
def unanimous_or_top10_contested(base, p: ReportParams = TESTBED_PARAMS):
    # The same question over units without a unanimous result: the fallback branch.
    # The filter makes this a test of that branch; it is no question of its own.
    conc = tables.materialize(_concentration(base, p).filter(F.col("winner_votes") < F.col(p.layout.valid)),
                              "concentration_contested")
    return _concentration_out(rank.hits_or_top_n(conc, _unanimous_hit(p), "max_share", p.top_n, [p.layout.unit_id]), p)


# ----------------------------------------------------------------- winners, groups
@report(bounded=True)
def largest_unit_per_group(base, p: ReportParams = TESTBED_PARAMS):
    return compare.largest_unit_per_group(base, p.layout, p.layout.community) \
        .select(p.layout.community, p.layout.unit_id, p.layout.unit, p.layout.province, p.layout.population)


@report(bounded=False)
def winner_per_unit(base, p: ReportParams = TESTBED_PARAMS):
    return compare.winner_per_unit(base, p.layout)


@report(bounded=True)
def winner_per_group(base, p: ReportParams = TESTBED_PARAMS):
    return compare.winner_per_group(base, p.layout, p.layout.community)


@report(bounded=True)
def max_row_per_group(base, p: ReportParams = TESTBED_PARAMS):
    return compare.max_row_per_group(base, p.layout, p.layout.community)


@report(bounded=True)
def population_by_group(base, p: ReportParams = TESTBED_PARAMS):
    return rates.population_by_group(base, p.layout, p.layout.community) \
        .withColumn("group_population", F.col("group_population").cast("decimal(38,2)"))


@report(bounded=False)
def share_of_group(base, p: ReportParams = TESTBED_PARAMS):
    out = rates.share_of_group(base, p.layout, p.layout.community, store=tables.materialize)
    return out.select(p.layout.community, p.layout.unit_id, p.layout.unit, p.layout.population,
                      F.col("group_population").cast("decimal(38,2)").alias("group_population"),
                      "population_share")


@report(bounded=True)
def representativeness(base, p: ReportParams = TESTBED_PARAMS):
    return compare.representativeness(base, p.layout, p.layout.community)


@report(bounded=True)
def representativeness_by_band(base, p: ReportParams = TESTBED_PARAMS):
    rep = compare.representativeness(base, p.layout, p.layout.community)
    if p.band_cut is None:
        # The median cut reads the per-group answer twice: take it from a
        # checkpoint (one row per group) instead of recomputing the base.
        rep = tables.checkpoint(rep)
    return compare.representativeness_by_band(rep, p.band_cut)


# ----------------------------------------------------------------- cohorts by size


def _cohorts(base, p: ReportParams = TESTBED_PARAMS):
    return compare.size_cohorts(base, p.layout, p.cohort_size, p.small_below)


@report(bounded=True)
def large_units_top20(base, p: ReportParams = TESTBED_PARAMS):
    return _cohorts(base, p).filter(F.col("cohort") == "large").select(*p.cohort_cols)


@report(bounded=True)
def small_units_top20(base, p: ReportParams = TESTBED_PARAMS):
    return _cohorts(base, p).filter(F.col("cohort") == "small").select(*p.cohort_cols)


@report(bounded=True)
def large_vs_small_union(base, p: ReportParams = TESTBED_PARAMS):
    return _cohorts(base, p).select("cohort", *p.cohort_cols)


@report(bounded=True)
def cohort_summary(base, p: ReportParams = TESTBED_PARAMS):
    return compare.cohort_summary(_cohorts(base, p))


@report(bounded=True)
def cohort_top_parties(base, p: ReportParams = TESTBED_PARAMS):
    return compare.cohort_top_parties(_cohorts(base, p), p.layout, p.top_parties)


@report(bounded=False)
def unit_top_parties(base, p: ReportParams = TESTBED_PARAMS):
    return compare.unit_top_parties(base, p.layout, p.top_parties)


@report(bounded=True)
def cohort_party_wins(base, p: ReportParams = TESTBED_PARAMS):
    return compare.cohort_party_wins(_cohorts(base, p), p.layout)


@report(bounded=True)
def turnout_by_winner(base, p: ReportParams = TESTBED_PARAMS):
    return compare.turnout_by_winner(base, p.layout)


@report(bounded=True)
def turnout_share_corr(base, p: ReportParams = TESTBED_PARAMS):
    return compare.turnout_share_corr(base, p.layout, p.layout.community)


@report(bounded=True)
def turnout_explained(base, p: ReportParams = TESTBED_PARAMS):
    """How much of the units' turnout the winner, the province and the community explain."""
    L = p.layout
    units = rates.with_turnout(shape.with_winner(base, L), L)
    return compare.variance_explained(units, "turnout", {"winner": "winner", "province": L.province, "community": L.community})


# ----------------------------------------------------------------- the bundle
def run_reports(base: DataFrame, out_dir: str, names: list[str] | None = None, *,
                params: ReportParams = TESTBED_PARAMS, materialize_base: bool = True,
                sep: str = ",") -> dict[str, str]:
    """Write every report (or ``names``) as delimited text below ``out_dir``.

    The base is materialised once in the shared checkpoint folder first, so
    each report starts from those files.  Bounded reports are written as one
    file; the others keep one file per partition.  Returns name -> folder.
    """
    if materialize_base:
        base = tables.materialize(base, "results_base")
    written = {}
    for name in names or list(REPORTS):
        fn, bounded = REPORTS[name]
        path = f"{out_dir.rstrip('/')}/{name}"
        delimited.write_report(fn(base, params), path, sep=sep, single_file=bounded)
        written[name] = path
    return written
