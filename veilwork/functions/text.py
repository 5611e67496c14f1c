"""Whitespace and digit handling with Unicode meaning, as JVM regular expressions."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as whitespace in text values.
SPACE_CHARS = (
    "\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# One table lookup for the first 256 characters, and the rest only inside its range.
_LOW = "".join(f"\\x{ord(c):02x}" for c in SPACE_CHARS if ord(c) < 256)
_HIGH = "".join(f"\\u{ord(c):04x}" for c in SPACE_CHARS if ord(c) >= 256)
SPACES = f"[{_LOW}[\\u1680-\\u3000&&[{_HIGH}]]]+"


def _unicode_digits() -> tuple[str, str, str]:
    """(all decimal digits beyond ASCII, their ASCII values, the other digit characters)."""
    decimals, others = [], []
    for code in range(128, sys.maxunicode + 1):
        ch = chr(code)
        if unicodedata.category(ch) == "Nd":
            decimals.append(ch)
        elif ch.isdigit():
            others.append(ch)
    values = "".join(str(unicodedata.decimal(ch)) for ch in decimals)
    return "".join(decimals), values, "".join(others)


_DECIMALS, _DECIMAL_VALUES, _OTHER_DIGITS = _unicode_digits()

# A decimal digit of any script; and any character with a digit value (superscripts too).
DECIMAL = r"\p{Nd}"
ANY_DIGIT = rf"[\p{{Nd}}{_OTHER_DIGITS}]"
NOT_ASCII = r"[^\x00-\x7f]"


def matches(c: Column, pattern: str) -> Column:
    """Whole-string match; NULL stays NULL."""
    return c.rlike(rf"\A(?:{pattern})\z")


def strip(c: Column) -> Column:
    """Remove whitespace of any kind at both ends."""
    return F.btrim(c, F.lit(SPACE_CHARS))


def collapse(c: Column) -> Column:
    """Every whitespace run becomes one plain space."""
    return F.regexp_replace(c, SPACES, " ")


def tidy(c: Column) -> Column:
    """Trimmed text with single spaces; empty text becomes NULL."""
    # After collapsing, the only whitespace left at the ends is U+0020.
    return F.nullif(F.trim(collapse(c)), F.lit(""))


def ascii_digits(c: Column) -> Column:
    """Decimal digits of other scripts become 0-9."""
    return F.translate(c, _DECIMALS, _DECIMAL_VALUES)


def replace_literal(c: Column, old: str, new: str) -> Column:
    """Plain-text replacement."""
    return F.replace(c, F.lit(old), F.lit(new))
