"""String and cast helpers.

* ``strip_ws``   (X1) strip what Python's ``str.strip()`` strips: tabs, line
  ends, the no-break space and the other Unicode blanks (plain ``trim`` only
  removes blanks).
* ``replace_chain`` (X2) ordered, case-sensitive replacements; plain text is
  replaced as text, patterns by the regex engine.
* ``strict_int`` (P6, F2) the whole text as an int, else NULL.
* ``leading_int`` (D8) integer from the leading digits of a label, so
  ``'105  or older'`` gives 105 instead of a cast error.
* ``safe_int``   (P6) text to int without raising under ANSI mode; goes via
  double so ``'3.0'`` becomes 3.
* ``decode_map`` (P5) label lookup keyed on the code, never on row position.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that ``str.strip()`` removes.
WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
            "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
# Text that casts cleanly. A failing try_cast costs far more per row than
# the pattern test, so casts are guarded by these.
INT_TEXT = r"^\s*[+-]?\d+\s*$"
NUM_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: str | Column) -> Column:
    """Like Python's ``str.strip()``; a plain character trim, no regex."""
    return F.trim(_col(c), F.lit(WS_CHARS))


def replace_chain(c: str | Column, steps: Iterable[tuple[str, str] | str]) -> Column:
    """Apply replacements in order. A step given as the string ``'strip'``
    strips whitespace at that point of the chain."""
    out = _col(c)
    for step in steps:
        if step == "strip":
            out = strip_ws(out)
        else:
            pattern, repl = step
            plain = pattern and not set(pattern) & set(r"\^$.|?*+()[]{}")
            out = (F.replace(out, F.lit(pattern), F.lit(repl)) if plain
                   else F.regexp_replace(out, pattern, repl))
    return out


def strict_int(c: str | Column) -> Column:
    """Text to int only when the whole text is an integer that fits, else NULL."""
    return F.when(_col(c).rlike(INT_TEXT), _col(c).try_cast("int"))


def leading_int(c: str | Column) -> Column:
    return strict_int(F.regexp_extract(_col(c), r"^\s*(\d+)", 1))


def safe_int(c: str | Column) -> Column:
    return F.when(_col(c).rlike(NUM_TEXT), _col(c).try_cast("double")).try_cast("int")


def decode_map(c: str | Column, mapping: Mapping[str, str]) -> Column:
    """``mapping[code]`` as a map literal; unknown codes give NULL."""
    lits = []
    for k, v in mapping.items():
        lits += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*lits), _col(c))
