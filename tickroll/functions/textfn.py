"""Text helpers that mirror Python's str.strip / float() on Spark columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace removed by strip(): Unicode white space plus the ASCII
# separators 0x1C-0x1F (Spark's one-argument trim only removes spaces).
_WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
             + "".join(chr(c) for c in range(0x2000, 0x200B))
             + "\u2028\u2029\u202f\u205f\u3000")

# Text float() accepts: decimal / scientific numbers and the special
# values nan, inf, infinity (any case, optional sign).
_NUMBER = (r"^[+-]?(([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?"
           r"|(?i:nan|inf|infinity))$")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Remove leading and trailing white space (a character set, no regex)."""
    return F.trim(_col(c), F.lit(_WS_CHARS))


def safe_float_text(c) -> Column:
    """Tolerant text -> double: NULL for anything float() would reject.

    ' 2 ', '1e3', 'nan', 'inf' pass; 'abc', '', '1.5d' give NULL. '1_000'
    also gives NULL (float() accepts digit separators; deliberate
    deviation).
    """
    t = strip_ws(_col(c).cast("string"))
    return F.when(t.rlike(_NUMBER), t.try_cast("double"))


def split_list(c, sep: str = ",") -> Column:
    """'a, b ,, c' -> ['a','b','c']: split, strip every item, drop empties."""
    parts = F.split(_col(c), sep_regex(sep))
    return F.filter(F.transform(parts, strip_ws), lambda x: x != F.lit(""))


def sep_regex(sep: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)
