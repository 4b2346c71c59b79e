"""String expressions: header cleaning and accent folding.

Accent folding is NFKD without its combining marks, as JVM expressions: one
``translate`` for every character that becomes one other or vanishes, and a
lookup for those that become several.  The tables are *generated* from the
Unicode database of Python's ``unicodedata``, over all code points.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hangul syllables are left out of the tables: they split by arithmetic.
_HANGUL = range(0xAC00, 0xAC00 + 11172)
_LEAD, _VOWEL, _TAIL = 0x1100, 0x1161, 0x11A7          # before the first trailing letter
_VOWELS, _TAILS = 21, 28
# Between the pairs of the lookup table, and inside one.
_PAIRS, _PAIR = "\x01", "\x02"

# Fixed value: characters a header keeps (everything else is deleted).
_HEADER_DROP = re.compile(r"[^a-zA-Z0-9_]")


def _nfkd_base(ch: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))


@lru_cache(maxsize=1)
def _fold_maps() -> tuple[str, str, str, tuple[tuple[str, str], ...]]:
    """(characters that become one, what they become, characters that vanish, those that become several)."""
    src, dst, gone, multi = [], [], [], []
    for cp in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= cp < 0xE000 or cp in _HANGUL:
            continue
        ch = chr(cp)
        base = _nfkd_base(ch)
        if base == ch:
            continue
        if len(base) == 1:
            src.append(ch)
            dst.append(base)
        elif base:                 # e.g. a fraction or a digraph letter
            multi.append((ch, base))
        else:                      # a combining mark
            gone.append(ch)
    return "".join(src), "".join(dst), "".join(gone), tuple(multi)


def fold_table() -> tuple[str, str]:
    """(source, target) strings for ``translate``: one base character per folded character."""
    return _fold_maps()[:2]


def _jamo(first: int, number: Column) -> Column:
    """The letter ``number`` places after ``first``."""
    letters = "".join(chr(first + i) for i in range(_TAILS))
    return F.substring(F.lit(letters), (number + 1).cast("int"), F.lit(1))


def _expanded(c: Column) -> Column:
    """The text with every character that folds to several replaced."""
    multi = _fold_maps()[3]
    table = F.str_to_map(F.lit(_PAIRS.join(ch + _PAIR + base for ch, base in multi)), F.lit(_PAIRS), F.lit(_PAIR))
    # A character class this long is tried part by part; translate looks characters up.
    several = "".join(ch for ch, _ in multi) + "".join(map(chr, _HANGUL))

    def one(x: Column) -> Column:
        place = F.ascii(x) - F.lit(_HANGUL[0])
        tail = place % _TAILS
        syllable = F.concat(_jamo(_LEAD, F.floor(place / (_VOWELS * _TAILS))),
                            _jamo(_VOWEL, F.floor(place / _TAILS) % _VOWELS),
                            F.when(tail > 0, _jamo(_TAIL, tail)).otherwise(""))
        return (F.when(F.translate(x, several, "") == x, x)
                 .when(place.between(0, len(_HANGUL) - 1), syllable)
                 .otherwise(F.coalesce(F.try_element_at(table, x), x)))

    return F.when(F.translate(c, several, "") != c, F.array_join(F.transform(F.split(c, ""), one), "")).otherwise(c)


def fold_accents(col: Column | str) -> Column:
    """Remove diacritics (NFKD, combining marks dropped) from a string column; null stays null.

    A text with a character that folds to several (a ligature, a fraction, a
    Hangul syllable) is first taken apart into characters; one ``translate``
    then folds the rest.  Pure ASCII is passed through.
    """
    src, dst, gone, _ = _fold_maps()
    c = F.col(col) if isinstance(col, str) else col
    # Pure ASCII has as many bytes as characters, and nothing to fold.
    return F.when(F.octet_length(c) == F.char_length(c), c).otherwise(F.translate(_expanded(c), src + gone, dst))


def fold_text(value: str | None) -> str | None:
    """The same folding for a driver-side literal (cohort lists, config)."""
    return None if value is None else _nfkd_base(value)


def clean_header(name: str) -> str:
    """Header rule of the results files: delete non-word characters, lower-case."""
    return _HEADER_DROP.sub("", name).lower()
