"""Number parsing, rates and formatting as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text accepted as a plain decimal or scientific number (what a lenient
# float parse accepts, minus nan/inf spellings that Spark would also take).
FLOAT_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_double(c: Column | str) -> Column:
    """Text or number to double; anything malformed becomes null."""
    s = _c(c).cast("string")
    return F.when(s.rlike(FLOAT_TEXT), s.try_cast("double"))


def _locale_text(c: Column | str) -> Column:
    # Locale form 1.234,5: every '.' is a thousands mark, ',' the decimal mark.
    return F.replace(F.replace(_c(c).cast("string"), F.lit("."), F.lit("")), F.lit(","), F.lit("."))


def locale_double(c: Column | str) -> Column:
    """N1 (GDP variant): parse ``1.234,5`` -> 1234.5; empty or malformed -> null
    (the caller drops such rows)."""
    t = _locale_text(c)
    return F.when(t.rlike(FLOAT_TEXT), t.try_cast("double"))


def locale_count(c: Column | str) -> Column:
    """N1 (population variant): empty after cleaning -> 0, else the parsed number
    truncated toward zero to a long; malformed -> null (the row is kept)."""
    t = _locale_text(c)
    return (F.when(t == "", F.lit(0).cast("long"))
            .when(t.rlike(FLOAT_TEXT), t.try_cast("double").try_cast("long")))


def round2(c: Column | str) -> Column:
    """Round half to even at two decimals the way numpy does: rint(x*100)/100.

    ``F.round`` rounds half up on the decimal value and differs (0.125 -> 0.13).
    """
    return F.rint(_c(c) * F.lit(100)) / F.lit(100)


def rate(num: Column | str, den: Column | str, scale: float) -> Column:
    """round2(num / den * scale); a zero or null denominator gives null."""
    q = F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
    return round2(q * F.lit(float(scale)))


def sum_or_zero(c: Column | str) -> Column:
    """Sum that is 0 for an all-null group, as a pandas sum is."""
    return F.coalesce(F.sum(c), F.lit(0))


def thousands(c: Column | str, decimals: int = 0) -> Column:
    """``1,234,567`` style text with a fixed number of decimals."""
    return F.format_number(_c(c).cast("double"), decimals)


def value_text(c: Column | str) -> Column:
    """No decimals for whole numbers, else two."""
    v = _c(c).cast("double")
    return F.when(v == F.floor(v), F.format_number(v, 0)).otherwise(F.format_number(v, 2))
