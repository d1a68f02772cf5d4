"""Numeric coercion, link functions and display formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A number as a lenient text parser accepts it: optional blanks and sign,
# digits with an optional fraction, optional exponent.  The guard is needed
# because a plain cast also accepts type suffixes such as '12d' or '1f'.
NUMERIC_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def coerce_bigint(c: Column | str) -> Column:
    """Unparsable -> 0, otherwise truncate toward zero to int64.

    Works on string and numeric input; never raises under ANSI mode.  Plain
    integers are read as such, so 18-digit codes stay exact; only other
    numbers go through double.  Out-of-range magnitudes become 0.
    """
    c = _col(c)
    as_text = c.cast("string")
    bare = F.regexp_replace(as_text, r"^\s+|\s+$", "")
    whole = F.when(bare.rlike(r"^[+-]?\d+$"), bare.try_cast("bigint"))
    parsed = F.when(as_text.rlike(NUMERIC_TEXT), bare.try_cast("double"))
    return F.coalesce(whole, parsed.try_cast("bigint"), F.lit(0).cast("bigint"))


def fill_cast_bigint(c: Column | str) -> Column:
    """Serving-side alignment: null / NaN -> 0, then truncating cast to int64."""
    c = _col(c)
    filled = F.when(c.isNull() | F.isnan(c.cast("double")), F.lit(0)).otherwise(c)
    return F.coalesce(filled.try_cast("bigint"), F.lit(0).cast("bigint"))


def sigmoid(x: Column | str) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_col(x)))


def logit(p: Column | str) -> Column:
    p = _col(p)
    return F.log(p / (F.lit(1.0) - p))


def thousands(n: Column | str) -> Column:
    """``1234567`` -> ``1,234,567``."""
    return F.format_number(_col(n).cast("bigint"), 0)


def percent_text(ratio_pct: Column | str, decimals: int) -> Column:
    """Percent value (already x100) as text with a ``%`` sign."""
    return F.format_string(f"%.{decimals}f%%", _col(ratio_pct).cast("double"))
