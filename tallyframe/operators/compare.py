"""Comparisons: cohorts of places, winners per unit and group, representativeness.

Group-level answers are built from aggregates (Σ per group and party, then
the winner of the sums), so the shuffled data is groups x parties rather than
units x parties, and the largest single row of a group is never mistaken for
the group's result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.numeric import pct
from tallyframe.functions.rowwise import row_top_k
from tallyframe.functions.text import fold_accents, fold_text
from tallyframe.model import Layout
from tallyframe.operators.rank import first_per_group, top_n, top_n_per_group
from tallyframe.operators.rates import with_turnout
from tallyframe.operators.shape import unpivot_parties, with_winner


def _q(name: str):
    return F.col(f"`{name}`")


# --------------------------------------------------------------------------- cohorts
def tag_by_lists(df: DataFrame, column: str, cohorts: Mapping[str, Sequence[str]], *,
                 tag_col: str = "cohort", fold: bool = True) -> DataFrame:
    """Keep rows whose ``column`` is in one of the named lists, tagged with the list name.

    Both sides are accent-folded before comparing (``"Ávila"`` matches
    ``"Avila"``); the first list wins when a value is in several.  The lists
    are literals in the plan (``In`` predicates); on a grouping key Catalyst
    evaluates the filter below the aggregate and the joins.  Without folding
    (``fold=False``) the predicate is a plain ``IN`` on the column, which
    also reaches the parquet scan.
    """
    if not cohorts:
        raise ValueError("no cohort lists given")
    value = fold_accents(_q(column)) if fold else _q(column)
    tag = None
    for name, members in cohorts.items():
        vals = [fold_text(m) if fold else m for m in members]
        cond = value.isin(vals)
        tag = F.when(cond, F.lit(name)) if tag is None else tag.when(cond, F.lit(name))
    return df.withColumn(tag_col, tag).filter(F.col(tag_col).isNotNull())


def tag_by_table(df: DataFrame, column: str, members: DataFrame, member_col: str, cohort_col: str, *,
                 tag_col: str = "cohort", fold: bool = True) -> DataFrame:
    """Keep rows whose ``column`` is listed in the table ``members``, tagged with the listed cohort.

    Both sides are trimmed and accent-folded before comparing; a name listed in several
    cohorts belongs to the smallest by name, so no row is doubled, and
    rows of ``members`` without a name or a cohort list nothing.  The table may
    have any size: Spark broadcasts it below its threshold and otherwise
    shuffles both sides by the name, with a Bloom filter of the listed names on
    the larger side's scan (``spark.sql.optimizer.runtime.bloomFilter.enabled``).
    """
    name = (lambda c: F.trim(fold_accents(c))) if fold else F.trim
    listed = (members.select(name(_q(member_col)).alias("_listed"), _q(cohort_col).alias(tag_col))
              .where(F.col("_listed").isNotNull() & _q(tag_col).isNotNull())
              .groupBy("_listed").agg(F.min(_q(tag_col)).alias(tag_col)))
    return df.withColumn("_name", name(_q(column))).join(listed, F.col("_name") == F.col("_listed")).drop("_name", "_listed")


def size_cohorts(df: DataFrame, layout: Layout, n: int, small_below, *,
                 tag_col: str = "cohort", large: str = "large", small: str = "small") -> DataFrame:
    """The n most populous units, and the n most populous under ``small_below``,
    as one frame tagged ``large`` / ``small``, each unit with its turnout.

    Each side is a bounded top-n (``TakeOrderedAndProject``); the union has at
    most 2n rows.  Expects one row per unit (see ``unit_totals``).
    """
    tb = [layout.unit_id]
    big = top_n(df, layout.population, n, tb).withColumn(tag_col, F.lit(large))
    little = (top_n(df.filter(_q(layout.population) < F.lit(small_below)), layout.population, n, tb)
              .withColumn(tag_col, F.lit(small)))
    return with_turnout(big.unionByName(little), layout, abstention_col=None)


def cohort_summary(cohorts: DataFrame, *, value_col: str = "turnout", tag_col: str = "cohort",
                   digits: int = 6) -> DataFrame:
    """Count, mean, min, max and sample standard deviation of ``value_col`` per cohort."""
    v = _q(value_col)
    return cohorts.groupBy(_q(tag_col)).agg(
        F.count(v).alias("n_units"),
        F.round(F.avg(v), digits).alias("avg_turnout"),
        F.min(v).alias("min_turnout"),
        F.max(v).alias("max_turnout"),
        F.round(F.stddev_samp(v), digits).alias("stddev_turnout"),
    )


def cohort_top_parties(cohorts: DataFrame, layout: Layout, n: int = 5, *,
                       tag_col: str = "cohort") -> DataFrame:
    """The n parties with most votes summed over each cohort's units."""
    long = unpivot_parties(cohorts, [tag_col], layout.parties, order_col="party_order")
    sums = long.groupBy(tag_col, "party", "party_order").agg(F.sum("votes").cast("bigint").alias("votes"))
    return (top_n_per_group(sums, tag_col, "votes", n, tiebreak=["party_order"], rank_col="party_rank")
            .drop("party_order"))


def unit_top_parties(df: DataFrame, layout: Layout, n: int = 5, ids: Sequence[str] | None = None) -> DataFrame:
    """The n parties with most votes in every unit, ranked (first party wins ties).

    Ranked inside each row (a sorted array of the unit's party counts, then
    ``posexplode``), so the input's partitioning is kept and nothing is
    shuffled.  Assumes one row per unit; aggregate with ``unit_totals`` first
    when a unit spans several rows.
    """
    ids = list(ids or [layout.unit_id, layout.unit])
    ranked = df.select(*[_q(c) for c in ids],
                       F.posexplode(row_top_k(layout.parties, n)).alias("_pos", "_p"))
    return ranked.select(*[_q(c) for c in ids], F.col("_p.party").alias("party"),
                         F.col("_p.votes").alias("votes"), (F.col("_pos") + 1).cast("int").alias("party_rank"))


def cohort_party_wins(cohorts: DataFrame, layout: Layout, *, tag_col: str = "cohort") -> DataFrame:
    """How many units of each cohort every party won (units with no winner left out)."""
    won = with_winner(cohorts, layout).filter(F.col("winner").isNotNull())
    return won.groupBy(_q(tag_col), F.col("winner").alias("party")).agg(F.count(F.lit(1)).alias("n_units"))


def turnout_by_winner(df: DataFrame, layout: Layout, groups: Sequence[str] = (), *, digits: int = 6) -> DataFrame:
    """Units, mean turnout and mean winning share per winning party (and optional groups)."""
    units = with_winner(with_turnout(df, layout, abstention_col=None), layout)
    units = units.filter(F.col("winner").isNotNull() & F.col("turnout").isNotNull())
    share = pct(F.col("winner_votes"), _q(layout.valid))
    return units.groupBy(F.col("winner").alias("party"), *[_q(g) for g in groups]).agg(
        F.count(F.lit(1)).alias("n_units"),
        F.round(F.avg("turnout"), digits).alias("avg_turnout"),
        F.round(F.avg(share), digits).alias("avg_winner_share"),
    )


def turnout_share_corr(df: DataFrame, layout: Layout, group: str, *, digits: int = 6) -> DataFrame:
    """Pearson correlation of turnout with the winner's share of valid votes, per group."""
    units = with_winner(with_turnout(df, layout, abstention_col=None), layout)
    share = pct(F.col("winner_votes"), _q(layout.valid))
    units = units.filter((_q(layout.census) > 0) & (_q(layout.valid) > 0))
    # corr() divides by the product of the deviations and raises under ANSI when
    # one side is constant; the same ratio with try_divide gives null instead.
    x, y = F.col("turnout"), share
    r = F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))
    return units.groupBy(_q(group)).agg(
        F.count(F.lit(1)).alias("n_units"),
        F.round(r, digits).alias("corr_turnout_share"),
    )


# --------------------------------------------------------------------------- winners
def largest_unit_per_group(df: DataFrame, layout: Layout, group: str) -> DataFrame:
    """The most populous unit of every group (ties: lowest unit id)."""
    return first_per_group(df, group, layout.population, tiebreak=[layout.unit_id])


def winner_per_unit(df: DataFrame, layout: Layout, ids: Sequence[str] | None = None) -> DataFrame:
    """Every unit with its winning party and the party's votes (row-wise, no shuffle)."""
    ids = list(ids or [layout.unit_id, layout.unit, layout.province, layout.community])
    return with_winner(df, layout, winner_col="party", votes_col="votes").select(*ids, "party", "votes")


def group_party_totals(df: DataFrame, layout: Layout, group: str) -> DataFrame:
    """Σ votes of every party per group, kept wide (one row per group)."""
    return df.groupBy(_q(group)).agg(*[F.sum(_q(p)).cast("bigint").alias(p) for p in layout.parties])


def winner_per_group(df: DataFrame, layout: Layout, group: str) -> DataFrame:
    """The party with most votes summed over the group's units (first party wins ties)."""
    sums = group_party_totals(df, layout, group)
    return with_winner(sums, layout, winner_col="party", votes_col="votes").select(group, "party", "votes")


def max_row_per_group(df: DataFrame, layout: Layout, group: str) -> DataFrame:
    """The single largest unit x party count of every group (ties: lowest unit id,
    then party order).  This is *not* the group's winner; see ``winner_per_group``."""
    rows = with_winner(df, layout, winner_col="party", votes_col="votes")
    best = first_per_group(rows, group, "votes", tiebreak=[layout.unit_id])
    return best.select(group, layout.unit_id, layout.unit, "party", "votes")


def unit_totals(df: DataFrame, layout: Layout, group: str, extra: Sequence[str] = ()) -> DataFrame:
    """One row per (group, unit): population once (``max`` of the repeated
    attribute), party votes summed over the unit's rows."""
    keys = [group, layout.unit_id, *extra]
    return df.groupBy(*[_q(k) for k in keys]).agg(
        F.max(_q(layout.population)).alias(layout.population),
        *[F.sum(_q(p)).cast("bigint").alias(p) for p in layout.parties])


def largest_first_key(layout: Layout):
    """Sort key whose minimum is the largest unit: known population first, then
    larger population, then lower unit id (a total order, so no ties)."""
    pop = _q(layout.population)
    return F.struct(pop.isNull().alias("_missing"), (-pop).alias("_neg_population"),
                    _q(layout.unit_id).alias("_id"))


def representativeness(df: DataFrame, layout: Layout, group: str) -> DataFrame:
    """Does the largest unit of each group vote like the group?

    One row per group: the largest unit, its winner and votes, the group's
    winner (of summed votes) and votes, ``coincides``, and the unit's share of
    the group's population.

    Plan: one aggregate to unit level (votes of a unit spread over several rows
    are summed first), then one aggregate per group that computes the group's
    party sums, its population, and picks the largest unit with ``min_by`` on
    a total-order key.  Both aggregates combine map-side, so a group holding a
    third of all units sends one partial row per task; the input is read once.
    (The pick keeps a struct in its buffer, so the group step is a sort-based
    aggregate: one map-side sort of the unit rows on a handful of keys.)
    """
    units = with_winner(unit_totals(df, layout, group, extra=[layout.unit]), layout)
    unit_row = F.struct(_q(layout.unit_id).alias("unit_id"), _q(layout.unit).alias("unit"),
                        _q(layout.population).alias("population"),
                        F.col("winner").alias("party"), F.col("winner_votes").alias("votes"))
    groups = units.groupBy(_q(group)).agg(
        F.sum(_q(layout.population)).alias("group_population"),
        *[F.sum(_q(p)).cast("bigint").alias(p) for p in layout.parties],
        F.min_by(unit_row, largest_first_key(layout)).alias("_big"),
    )
    groups = with_winner(groups, layout, winner_col="group_party", votes_col="group_votes")
    return groups.select(
        _q(group),
        F.col("_big.unit_id").alias(layout.unit_id),
        F.col("_big.unit").alias(layout.unit),
        F.col("_big.party").alias("unit_party"),
        F.col("_big.votes").alias("unit_votes"),
        "group_party", "group_votes",
        (F.col("_big.party") == F.col("group_party")).alias("coincides"),
        pct(F.col("_big.population").cast("double"), F.col("group_population").cast("double"))
        .alias("population_share"),
    )


def representativeness_by_band(rep: DataFrame, cut: float | Sequence[float] | None = None, *,
                               share_col: str = "population_share") -> DataFrame:
    """Match rate of ``coincides`` by how much of its group the largest unit holds.

    One ``cut`` (in %) gives the bands ``high`` (share >= cut) and ``low``.
    Without ``cut`` the median share across groups is used, so both bands are
    filled at any data size (the share of the largest unit shrinks as units
    multiply); it is a scalar subquery over the one-row-per-group frame.
    Several cuts give one band per interval, labelled ``[a, b)``.
    """
    share = F.col(share_col)
    if cut is None or isinstance(cut, (int, float)):
        threshold = F.lit(cut) if cut is not None else rep.select(F.median(share_col)).scalar()
        band = F.when(share >= threshold, F.lit("high")).otherwise(F.lit("low"))
    else:
        edges = sorted(float(c) for c in cut)
        labels = [f"[{lo:g}, {hi:g})" for lo, hi in zip([float("-inf"), *edges], [*edges, float("inf")])]
        band = F.lit(labels[-1])
        for edge, label in reversed(list(zip(edges, labels))):
            band = F.when(share < F.lit(edge), F.lit(label)).otherwise(band)
    return rep.groupBy(band.alias("share_band")).agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.count_if(F.col("coincides")).alias("n_coinciding"),
        pct(F.count_if(F.col("coincides")), F.count(F.lit(1))).alias("match_rate"),
    )


# --------------------------------------------------------------------------- what explains a value
# Differences of two sums of squares below this part of them are rounding.
ROUNDING = 1e-12


def variance_explained(df: DataFrame, value: str, factors: Mapping[str, str], digits: int = 6) -> DataFrame:
    """Per factor: how much of the variance of ``value`` lies between its levels (eta squared, 0 to 1).

    ``factors`` maps a name to a column.  Every row counts once per factor;
    count, mean and squared deviations per level are merged in the map-side
    combine, so a shuffled row is a task's level, and the factors follow from
    the levels.  A null level is a level of its own; rows without a value are
    left out; a value without variance has no share (null).
    """
    entries = [F.struct(F.lit(name).alias("factor"), _q(c).cast("string").alias("level")) for name, c in factors.items()]
    rows = df.filter(_q(value).isNotNull()).select(F.explode(F.array(*entries)).alias("_at"), _q(value).cast("double").alias("_v"))
    levels = rows.groupBy("_at.factor", "_at.level").agg(
        F.count(F.lit(1)).alias("n"), F.avg("_v").alias("mean"), (F.var_pop("_v") * F.count(F.lit(1))).alias("within"))
    # Between the levels: the means' squared distances from the mean of all rows, each as often as its level has rows.
    sums = levels.groupBy("factor").agg(
        F.sum("n").alias("n_units"), F.count(F.lit(1)).alias("n_levels"), F.sum("within").alias("_within"),
        F.sum(F.col("n") * F.col("mean")).alias("_s1"), F.sum(F.col("n") * F.col("mean") * F.col("mean")).alias("_s2"))
    between = F.col("_s2") - F.col("_s1") * F.col("_s1") / F.col("n_units")
    between = F.when(between > ROUNDING * F.col("_s2"), between).otherwise(F.lit(0.0))
    return sums.select("factor", "n_units", "n_levels", F.round(F.try_divide(between, between + F.col("_within")), digits).alias("explained"))
