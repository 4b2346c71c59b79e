"""Rates and group totals: turnout, abstention, ratios of sums, shares of a group.

Group totals are aggregates (partial aggregation in every task, then one row
per group), never whole-partition windows: a window partitioned by a handful
of communities puts each community in one task, and the largest community may
hold a third of all rows.  The one-row-per-group totals are joined back; AQE
sees their measured size and broadcasts them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.numeric import complement_pct, pct
from tallyframe.model import Layout


def _q(name: str):
    return F.col(f"`{name}`")


def with_turnout(df: DataFrame, layout: Layout, *, turnout_col: str = "turnout",
                 abstention_col: str | None = "abstention") -> DataFrame:
    """Add ``voters / census * 100`` and its complement; null when the census is 0."""
    cols = {turnout_col: pct(_q(layout.voters), _q(layout.census))}
    if abstention_col:
        cols[abstention_col] = complement_pct(cols[turnout_col])
    return df.withColumns(cols)


def turnout_by_group(df: DataFrame, layout: Layout, groups: Sequence[str], *,
                     index_col: str = "turnout_index") -> DataFrame:
    """Ratio of sums per group (not the mean of unit ratios): Σvoters / Σcensus * 100."""
    return (df.groupBy(*[_q(g) for g in groups])
              .agg(F.sum(_q(layout.voters)).cast("bigint").alias("total_voters"),
                   F.sum(_q(layout.census)).cast("bigint").alias("total_census"))
              .withColumn(index_col, pct("total_voters", "total_census")))


def turnout_rollup(df: DataFrame, layout: Layout, levels: Sequence[str], *,
                   index_col: str = "turnout_index", level_col: str = "level") -> DataFrame:
    """The same ratio of sums at every prefix of a hierarchy (``ROLLUP``).

    ``level`` counts the rolled-up columns: 0 = finest, ``len(levels)`` = grand
    total.  One ``Expand`` feeds one aggregate: a single shuffle for all levels.
    """
    bits = [F.grouping(_q(g)).cast("int") for g in levels]
    level = bits[0]
    for b in bits[1:]:
        level = level + b
    return (df.rollup(*[_q(g) for g in levels])
              .agg(F.sum(_q(layout.voters)).cast("bigint").alias("total_voters"),
                   F.sum(_q(layout.census)).cast("bigint").alias("total_census"),
                   level.alias(level_col))
              .withColumn(index_col, pct("total_voters", "total_census")))


def distinct_units(df: DataFrame, layout: Layout, group: str, extra: Sequence[str] = ()) -> DataFrame:
    """One row per (group, unit): a unit reported on several rows counts once.

    Population is a unit attribute, repeated on every row of the unit; ``max``
    picks it without summing the repeats.
    """
    keys = [group, layout.unit_id, *extra]
    return df.groupBy(*[_q(k) for k in keys]).agg(F.max(_q(layout.population)).alias(layout.population))


def population_by_group(df: DataFrame, layout: Layout, group: str, *,
                        total_col: str = "group_population") -> DataFrame:
    """Total population per group over distinct units, with the unit count."""
    units = distinct_units(df, layout, group)
    return units.groupBy(_q(group)).agg(F.sum(_q(layout.population)).alias(total_col),
                                        F.count(F.lit(1)).alias("n_units"))


def share_of_group(df: DataFrame, layout: Layout, group: str, *,
                   total_col: str = "group_population", share_col: str = "population_share",
                   store: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """Each unit's population as a percentage of its group's total.

    ``store(frame, name)`` writes a frame and reads it back.  With it the input
    is computed once, and the planner knows the size of the totals (one row per
    group) before it plans the join, so small totals are broadcast and the
    units are not shuffled by group.
    """
    units = distinct_units(df, layout, group, extra=[layout.unit])
    if store:
        units = store(units, "units")
    totals = units.groupBy(_q(group)).agg(F.sum(_q(layout.population)).alias(total_col))
    if store:
        totals = store(totals, "group_totals")
    return (units.join(totals, on=group, how="inner")
                 .withColumn(share_col, pct(_q(layout.population).cast("double"),
                                            F.col(total_col).cast("double"))))
