"""Text-to-number rules as Column expressions (split, strip, unquote, float).

The reference parses with Python's ``str.split``, ``str.strip`` and
``float``.  Spark's ``cast`` accepts a slightly different language (it takes
``1d``/``1f`` suffixes, rejects ``1_000`` and ``+nan``), so ``py_float`` guards
the cast with a regular expression of Python's float grammar and maps the NaN
spellings itself.  Everything stays a JVM-side expression.
"""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python float() grammar (PEP 515 underscores between digits,
# optional exponent, inf/infinity/nan case-insensitive, optional sign).
_DIGITS = r"[0-9](?:_?[0-9])*"
PY_FLOAT_PATTERN = (
    r"^[+-]?(?:(?:" + _DIGITS + r"(?:\.(?:" + _DIGITS + r")?)?|\." + _DIGITS + r")"
    r"(?:[eE][+-]?" + _DIGITS + r")?|(?i:inf|infinity|nan))$"
)
NAN_SPELLINGS = ("nan", "+nan", "-nan")


def _space() -> str:
    """Every character that Python's ``str.strip`` removes."""
    return "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def _decimals() -> tuple[str, str]:
    """Every decimal digit beyond ASCII, and the ASCII digits they stand for."""
    found = [ch for ch in map(chr, range(128, sys.maxunicode + 1)) if unicodedata.decimal(ch, None) is not None]
    return "".join(found), "".join(str(unicodedata.decimal(ch)) for ch in found)


SPACE = _space()
DECIMALS, DECIMAL_VALUES = _decimals()


def strip(c: Column) -> Column:
    """Python ``str.strip()``: a trim by its fixed list of blanks."""
    return F.btrim(c, F.lit(SPACE))


def clean_field(c: Column) -> Column:
    """``x.strip().replace('"', '')`` — strip first, then drop every quote."""
    return F.replace(strip(c), F.lit('"'), F.lit(""))


def py_float(c: Column) -> Column:
    """Python ``float(c)`` as a Column; NULL where Python would raise.

    Blanks are trimmed and digits beyond ASCII become ASCII ones; one anchored
    grammar check then guards the cast.  Of a text of ASCII characters alone,
    ``float`` trims only the blanks of C, not U+001C to U+001F.
    """
    ascii_only = F.octet_length(c) == F.char_length(c)
    s = F.when(ascii_only, F.btrim(c, F.lit(" \t\n\r\x0b\x0c"))).otherwise(F.translate(strip(c), DECIMALS, DECIMAL_VALUES))
    return (
        F.when(s.isNull() | ~s.rlike(PY_FLOAT_PATTERN), F.lit(None).cast("double"))
        .when(F.lower(s).isin(*NAN_SPELLINGS), F.lit(float("nan")))
        .otherwise(F.replace(s, F.lit("_"), F.lit("")).try_cast("double"))
    )


def is_missing_token(cleaned: Column) -> Column:
    """The reference's explicit missing test: empty or ``nan`` (any case)."""
    return (cleaned == "") | (F.lower(cleaned) == "nan")


def fields(line: Column, sep: str = ",") -> Column:
    """``line.split(sep)`` keeping trailing empty fields (Java limit -1)."""
    return F.split(line, sep if sep != "|" else r"\|", -1)
