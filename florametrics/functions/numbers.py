"""Lenient parsing and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from florametrics.functions.nulls import col_of

__all__ = ["lenient_number", "lenient_date", "ratio", "signif", "unit_hash", "digest", "unit_digest", "DIGEST_BITS"]


def lenient_number(c, dtype: str = "double") -> Column:
    """Number, or NULL for text that is none."""
    return F.trim(col_of(c)).try_cast(dtype)


def lenient_date(c, formats=("yyyy-M-d", "yyyy/M/d")) -> Column:
    """Date in the first format that fits, or NULL; what follows the date, such as a time, is left out."""
    day = F.nullif(F.regexp_extract(col_of(c), r"^\s*(\d{4}[-/]\d{1,2}[-/]\d{1,2})(?!\d)", 1), F.lit(""))
    return F.coalesce(*[F.try_to_date(day, f) for f in formats])


def ratio(a, b, scale: float = 1.0) -> Column:
    """``a / b * scale``; NULL for a zero denominator."""
    return F.try_divide(col_of(a).cast("double"), col_of(b).cast("double")) * F.lit(float(scale))


def signif(c, digits: int = 4) -> Column:
    """Round to significant digits."""
    return F.format_string(f"%.{digits}g", col_of(c).cast("double")).cast("double")


def unit_hash(*cols, seed: int = 0) -> Column:
    """Uniform number in (0, 1) fixed by the values and the seed, not by row position."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *[col_of(c) for c in cols]), 11)
    return (bits.cast("double") + 0.5) / F.lit(float(2**53))


#: Thirteen hexadecimal digits: every value is exact as a double.
DIGEST_BITS = 52


def digest(*cols, seed: int = 0) -> Column:
    """Whole number below ``2 ** DIGEST_BITS`` from the md5 of the seed and the values' text, the same in any engine.

    The text is the seed, then for each value ``|=`` and the value, or ``|-`` for a missing one.
    """
    parts = [F.coalesce(F.concat(F.lit("|="), col_of(c).cast("string")), F.lit("|-")) for c in cols]
    return F.conv(F.substring(F.md5(F.concat(F.lit(str(seed)), *parts)), 1, DIGEST_BITS // 4), 16, 10).cast("long")


def unit_digest(*cols, seed: int = 0) -> Column:
    """``digest`` as a number in (0, 1)."""
    return (digest(*cols, seed=seed).cast("double") + 0.5) / F.lit(float(2 ** DIGEST_BITS))
