"""String and time-text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Identifier pattern and its mask.
SSN_PATTERN = r"\d{3}-\d{2}-\d{4}"
SSN_MASK = "XXX-XX-XXXX"

# The characters a Unicode strip removes.
WHITE_SPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_text(c: Column | str) -> Column:
    """Lower-case and strip white space of any kind (null stays null)."""
    return F.lower(F.btrim(_col(c), F.lit(WHITE_SPACE)))


def mask_ssn(c: Column | str) -> Column:
    """Replace every SSN-shaped run (unanchored, all occurrences)."""
    return F.regexp_replace(_col(c), SSN_PATTERN, SSN_MASK)


def iso_text(ts: Column | str) -> Column:
    """ISO-8601 text of a timestamp; the fraction is omitted when it is zero."""
    ts = _col(ts)
    return F.when(
        F.date_format(ts, "SSSSSS") == "000000", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    ).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def clock_text(ts: Column | str) -> Column:
    """Second-of-day text ``HH:mm:ss`` (different days share a key)."""
    return F.date_format(_col(ts), "HH:mm:ss")


def ts_text(ts: Column | str) -> Column:
    """Full timestamp text with microseconds (stable engine-neutral output)."""
    return F.date_format(_col(ts), "yyyy-MM-dd HH:mm:ss.SSSSSS")
