"""Row-wise expressions over a list of count columns (one per party).

They read one row at a time and need no shuffle: the winner of a unit held in
wide form is a projection, not a window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def row_max(cols: Sequence[str]) -> Column:
    """Largest value across the columns; nulls are skipped, all-null gives null."""
    if len(cols) == 1:
        return _q(cols[0])
    return F.greatest(*[_q(c) for c in cols])


def row_argmax(cols: Sequence[str], labels: Sequence[str] | None = None,
               require_positive: bool = False) -> Column:
    """Label of the first column holding the row maximum (declared order breaks ties).

    All-null rows give null.  With ``require_positive`` a maximum of 0 also
    gives null: a party without votes does not win.
    """
    labels = list(labels or cols)
    m = row_max(cols)
    pick = F.coalesce(*[F.when(_q(c) == m, F.lit(lab)) for c, lab in zip(cols, labels)])
    if require_positive:
        pick = F.when(m > 0, pick)
    return pick


def row_top_k(cols: Sequence[str], k: int, labels: Sequence[str] | None = None) -> Column:
    """The k largest non-null columns of the row as ``array<struct<party, votes>>``,
    largest first, declared order breaking ties.

    A per-row sort of a bounded array: ranking the parties of every unit this
    way needs no unpivot and no window, hence no shuffle.
    """
    labels = list(labels or cols)
    items = F.array(*[F.struct((-_q(c)).alias("neg_votes"), F.lit(i).alias("position"),
                               F.lit(lab).alias("party"), _q(c).alias("votes"))
                      for i, (c, lab) in enumerate(zip(cols, labels))])
    present = F.filter(items, lambda x: x["votes"].isNotNull())
    ranked = F.slice(F.array_sort(present), 1, k)
    return F.transform(ranked, lambda x: F.struct(x["party"].alias("party"), x["votes"].alias("votes")))
