"""Cleaning operators: trim, header names, accent folding, tolerant typing.

All of them are single projections (one ``select``), never a loop of
``withColumn`` calls, so the analysed plan stays one node deep.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallyframe.functions.numeric import is_rejected, tolerant_cast
from tallyframe.functions.text import clean_header, fold_accents


def _q(name: str):
    return F.col(f"`{name}`")


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def trim_strings(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Trim the string columns (all of them by default); other types are kept as they are."""
    targets = set(columns) if columns is not None else set(string_columns(df))
    return df.select(*[F.trim(_q(c)).alias(c) if c in targets else _q(c) for c in df.columns])


def clean_headers(df: DataFrame) -> DataFrame:
    """Rename every column by the header rule; refuse names that vanish or collide."""
    new = [clean_header(c) for c in df.columns]
    empty = [old for old, n in zip(df.columns, new) if not n]
    if empty:
        raise ValueError(f"headers with no usable characters: {empty}")
    dup = sorted(n for n, k in Counter(new).items() if k > 1)
    if dup:
        clash = {n: [o for o, m in zip(df.columns, new) if m == n] for n in dup}
        raise ValueError(f"headers collide after cleaning: {clash}")
    return df.toDF(*new)


def fold_columns(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Fold accents in the string columns (all by default)."""
    targets = set(columns) if columns is not None else set(string_columns(df))
    return df.select(*[fold_accents(_q(c)).alias(c) if c in targets else _q(c) for c in df.columns])


def typed_cast(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Re-type columns with ``try_cast`` after trimming; dirty values become null.

    Adds ``_rejected``: the names of the columns whose non-blank input did
    not parse on this row (empty array when the row is clean).  Use
    :func:`reject_report` for per-column counts.
    """
    typed = {c: tolerant_cast(_q(c), t) for c, t in types.items()}
    flags = [F.when(is_rejected(_q(c), typed[c]), F.lit(c)) for c in types]
    out = [typed[c].alias(c) if c in typed else _q(c) for c in df.columns]
    return df.select(*out, F.filter(F.array(*flags), lambda x: x.isNotNull()).alias("_rejected"))


def reject_report(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """One row per column: rows, blank inputs, parsed values and rejected values.

    Each cell is cast once in a projection that keeps two flags per column;
    one global aggregate (partial per task) counts them, and the single result
    row is turned into ``(column_name, n_rows, n_blank, n_ok, n_rejected)``.
    """
    flags = []
    for i, (c, t) in enumerate(types.items()):
        raw = F.trim(_q(c).cast("string"))
        blank = raw.isNull() | (raw == F.lit(""))
        typed = tolerant_cast(_q(c), t)
        flags += [blank.alias(f"_b{i}"), typed.isNotNull().alias(f"_o{i}")]
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for i in range(len(types)):
        aggs += [F.count_if(F.col(f"_b{i}")).alias(f"_b{i}"), F.count_if(F.col(f"_o{i}")).alias(f"_o{i}")]
    wide = df.select(*flags).agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), F.col("n_rows"),
                     F.col(f"_b{i}").alias("n_blank"), F.col(f"_o{i}").alias("n_ok"),
                     (F.col("n_rows") - F.col(f"_b{i}") - F.col(f"_o{i}")).alias("n_rejected"))
            for i, c in enumerate(types)]
    return wide.select(F.inline(F.array(*rows)))
