"""Numeric expressions: guarded ratios and tolerant casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def pct(num, den) -> Column:
    """``num / den * 100`` as double; null when ``den`` is 0 or null (never raises)."""
    return F.try_divide(_c(num), _c(den)) * F.lit(100.0)


def complement_pct(rate) -> Column:
    """``100 - rate`` (abstention from turnout)."""
    return F.lit(100.0) - _c(rate)


# A failed text-to-number cast costs an exception inside the task, which on a
# column of dirty text dominates the run.  These patterns accept every string
# the cast could accept (surrounding control characters and spaces included)
# and reject only strings it must refuse, so guarding keeps the result exact.
_PAD = r"[\x00-\x20]*"
_NUM = r"([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
_NUM_ANY_DIGITS = r"(\p{Nd}+\.?\p{Nd}*|\.\p{Nd}+)([eE][+-]?\p{Nd}+)?"   # decimals accept any Unicode digit
_GUARDS = {
    "integral": rf"^{_PAD}[+-]?[0-9]+{_PAD}$",
    "decimal": rf"^{_PAD}[+-]?{_NUM_ANY_DIGITS}{_PAD}$",
    "fractional": rf"^{_PAD}[+-]?({_NUM}[fFdD]?|0[xX].*|(?i:nan|inf|infinity)){_PAD}$",
}


def _guard_for(dtype: str) -> str | None:
    t = dtype.strip().lower()
    if t in ("tinyint", "byte", "smallint", "short", "int", "integer", "bigint", "long"):
        return _GUARDS["integral"]
    if t.startswith("decimal") or t.startswith("numeric") or t.startswith("dec("):
        return _GUARDS["decimal"]
    if t in ("float", "real", "double"):
        return _GUARDS["fractional"]
    return None


def tolerant_cast(x, dtype: str) -> Column:
    """Trim and ``try_cast``: dirty text becomes null instead of failing the job.

    Numeric targets are guarded by a pattern check first, so text that cannot
    be a number is nulled without the cast's exception path.
    """
    raw = F.trim(_c(x))
    cast = raw.try_cast(dtype)
    guard = _guard_for(dtype)
    return cast if guard is None else F.when(raw.rlike(guard), cast)


def is_rejected(raw, typed) -> Column:
    """True when a non-blank input did not survive the cast."""
    raw_c = F.trim(_c(raw).cast("string"))
    return raw_c.isNotNull() & (raw_c != F.lit("")) & _c(typed).isNull()
