"""Reshaping the wide party columns: long form, shares, per-row winner."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.numeric import pct
from tallyframe.functions.rowwise import row_argmax, row_max
from tallyframe.model import Layout


def _q(name: str):
    return F.col(f"`{name}`")


def unpivot_parties(df: DataFrame, ids: Sequence[str], parties: Sequence[str], *,
                    name_col: str = "party", value_col: str = "votes",
                    keep_nulls: bool = False, order_col: str | None = None) -> DataFrame:
    """Wide party columns to rows ``(ids..., party, votes)``.

    A narrow ``Expand``: no shuffle.  Spark does not carry the input
    partitioning through it, so rank per unit inside the row
    (``functions.row_top_k``) rather than with a window after the unpivot.
    The party label is the column name (one label source).  Null counts are dropped unless
    ``keep_nulls``.  ``order_col`` adds the declared position (0-based) of
    the party, the tie-break for "first party wins".
    """
    long = df.unpivot(list(ids), list(parties), name_col, value_col)
    if not keep_nulls:
        long = long.filter(F.col(value_col).isNotNull())
    if order_col:
        position = F.array_position(F.array(*[F.lit(p) for p in parties]), F.col(name_col))
        long = long.withColumn(order_col, (position - 1).cast("int"))
    return long


def party_shares_wide(df: DataFrame, layout: Layout, ids: Sequence[str] | None = None,
                      suffix: str = "_pct") -> DataFrame:
    """Each party's share of the valid votes (``votes / valid * 100``), one select.

    Units with no valid votes are left out (a share of nothing is undefined).
    """
    ids = list(ids or [layout.unit_id, layout.unit])
    return (df.filter(_q(layout.valid) > 0)
              .select(*[_q(c) for c in ids], _q(layout.valid),
                      *[pct(_q(p), _q(layout.valid)).alias(f"{p}{suffix}") for p in layout.parties]))


def with_winner(df: DataFrame, layout: Layout, *, winner_col: str = "winner",
                votes_col: str = "winner_votes") -> DataFrame:
    """Add the unit's winning party and its votes, row-wise (no shuffle).

    The first party in declared order wins a tie; a unit whose best party has
    0 votes, or no counts at all, has no winner (null).
    """
    return df.withColumns({
        winner_col: row_argmax(layout.parties, require_positive=True),
        votes_col: row_max(layout.parties),
    })
