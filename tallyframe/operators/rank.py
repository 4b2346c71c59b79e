"""Ordering operators: top/bottom n, top n per group, "all hits else top n".

Every order ends with a unique key, so a result never depends on partitioning
or task timing (ties are common: 100 % turnout, equal vote counts).
Global top-n plans as ``TakeOrderedAndProject`` (each task keeps n rows, one
task merges n x tasks rows); per-group top-n as ``row_number`` with a
filter, which Spark turns into a partial ``WindowGroupLimit`` before the
shuffle, so each task sends at most n rows per group however skewed the
groups are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _keys(by) -> list:
    return [by] if isinstance(by, (str, Column)) else list(by)


def _desc(c) -> Column:
    return (_q(c) if isinstance(c, str) else c).desc_nulls_last()


def _asc(c) -> Column:
    return (_q(c) if isinstance(c, str) else c).asc_nulls_last()


def ordering(by, tiebreak: Sequence[str] = (), ascending: bool = False) -> list[Column]:
    """Sort keys: ``by`` descending (or ascending), nulls last, then ``tiebreak`` ascending."""
    main = [_asc(c) if ascending else _desc(c) for c in _keys(by)]
    return main + [_asc(c) for c in tiebreak]


def top_n(df: DataFrame, by, n: int, tiebreak: Sequence[str] = (), ascending: bool = False) -> DataFrame:
    """The n rows with the largest ``by`` (smallest with ``ascending``); nulls last."""
    return df.orderBy(*ordering(by, tiebreak, ascending)).limit(n)


def bottom_n(df: DataFrame, by, n: int, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The n smallest; a null ``by`` sorts last, so missing values never fill the list."""
    return top_n(df, by, n, tiebreak, ascending=True)


def top_n_with_ties(df: DataFrame, by: str, n: int, ascending: bool = False, rank_col: str = "rank") -> DataFrame:
    """Every row whose ``by`` is among the n largest, ties at the cut included, with its SQL ``rank()``.

    The n largest values come from a bounded top-n over the one column; their
    ranks are counted among these at most n values, and the rows are found by an
    equality join with them, in place.  So no task sorts or ranks the rows, however many
    tie at the cut.  Rows without a value have no rank and are left out.  ``by``
    is read twice: store an expensive input first.
    """
    valued = df.filter(_q(by).isNotNull())
    top = top_n(valued.select(_q(by).alias("_value")), "_value", n, ascending=ascending)
    order = _asc("_value") if ascending else _desc("_value")
    before = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)       # over at most n values
    ranks = (top.groupBy("_value").agg(F.count(F.lit(1)).alias("_n"))
             .select("_value", (F.coalesce(F.sum("_n").over(before), F.lit(0)) + 1).cast("long").alias(rank_col)))
    return valued.join(F.broadcast(ranks), _q(by) == F.col("_value")).drop("_value")     # n rows at most


def top_n_per_group(df: DataFrame, group: Sequence[str] | str, by, n: int,
                    tiebreak: Sequence[str] = (), ascending: bool = False,
                    rank_col: str | None = None) -> DataFrame:
    """The first n rows of every group under the order, optionally with their rank (1 = first).

    Spark bounds the rows each task sends per group by n (partial
    ``WindowGroupLimit``) only while n is at most
    ``spark.sql.optimizer.windowGroupLimitThreshold`` (1,000 by default);
    raise that setting for larger n on skewed groups.
    """
    w = Window.partitionBy(*[_q(g) for g in _keys(group)]).orderBy(*ordering(by, tiebreak, ascending))
    col = rank_col or "_rn"
    out = df.withColumn(col, F.row_number().over(w)).filter(F.col(col) <= n)
    return out if rank_col else out.drop(col)


def first_per_group(df: DataFrame, group, by, tiebreak: Sequence[str] = (), ascending: bool = False) -> DataFrame:
    """The single first row of every group (``row_number() = 1``)."""
    return top_n_per_group(df, group, by, 1, tiebreak, ascending)


def hits_or_top_n(df: DataFrame, hit: Column, by, n: int, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Every row matching ``hit``; when there is none, the top n by ``by`` instead.

    One plan, no driver-side branch: the fallback is guarded by ``NOT EXISTS``
    on the hits, which Spark runs as a scalar subquery that stops at the first
    hit (``CollectLimit 1``).  No global window, no cross join.
    """
    hits = df.filter(hit)
    fallback = top_n(df, by, n, tiebreak).filter(~hits.exists())
    return hits.unionByName(fallback)
