"""Joins of facts to a place dimension, and their coverage check.

Broadcast policy: a side is broadcast only after its size is known to be
below a limit.  For a file scan Spark checks that itself at plan time
(``spark.sql.autoBroadcastJoinThreshold`` against the file sizes) and AQE
checks again on the measured shuffle output; above the limit the join stays a
sort-merge join, with AQE splitting skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "inner") -> DataFrame:
    """Equi-join a fact to a dimension, keeping one copy of the key.

    ``on`` is a column name or list of names (``USING`` semantics: the key
    appears once).  Whether the dimension is broadcast is left to Spark, which
    knows its size: from the files at plan time, or measured by AQE.
    """
    return fact.join(dim, on=on, how=how)


def require_unique(dim: DataFrame, key: str, shown: int = 5) -> DataFrame:
    """``dim`` itself; raises ``ValueError`` if a key is on several of its rows.

    A repeated key would multiply every fact row that joins it.  One job over
    the dimension, aggregated before its shuffle; only ``shown`` of the
    repeated keys reach the driver, for the message.  Null keys never join.
    """
    repeated = (dim.where(F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`").alias("_k"))
                   .agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").limit(shown).collect())
    if repeated:
        raise ValueError(f"{key} is not unique in the dimension: {sorted(str(r['_k']) for r in repeated)}")
    return dim


def join_coverage(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                  left_name: str = "left", right_name: str = "right") -> DataFrame:
    """Keys an inner join would drop, per side: ``(side, n_rows, n_keys)``.

    Each side is reduced to ``(key, rows)`` with a partial aggregate, so only
    distinct keys are shuffled (a key holding a third of the data is one row
    per task after the map-side combine).  One full outer join of the two key
    sets, already hash-partitioned by key, classifies every key, and a global
    aggregate (partial per task) counts both sides, which always appear.  A
    null key never joins and counts as unmatched on its own side.
    """
    lk = left.groupBy(F.col(left_key).alias("_k")).agg(F.count(F.lit(1)).alias("_nl"))
    rk = right.groupBy(F.col(right_key).alias("_k")).agg(F.count(F.lit(1)).alias("_nr"))
    both = lk.join(rk, on=lk["_k"] == rk["_k"], how="full_outer")
    left_only, right_only = F.col("_nr").isNull(), F.col("_nl").isNull()
    totals = both.agg(
        F.coalesce(F.sum(F.when(left_only, F.col("_nl"))), F.lit(0)).cast("bigint").alias("l_rows"),
        F.count_if(left_only).alias("l_keys"),
        F.coalesce(F.sum(F.when(right_only, F.col("_nr"))), F.lit(0)).cast("bigint").alias("r_rows"),
        F.count_if(right_only).alias("r_keys"),
    )
    sides = [F.struct(F.lit(f"{left_name}_only").alias("side"), F.col("l_rows").alias("n_rows"),
                      F.col("l_keys").alias("n_keys")),
             F.struct(F.lit(f"{right_name}_only").alias("side"), F.col("r_rows").alias("n_rows"),
                      F.col("r_keys").alias("n_keys"))]
    return totals.select(F.inline(F.array(*sides)))
