"""Cleaning of text cells and strict conversion to numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schemas import NA_TOKENS

# The characters a Unicode-aware strip removes.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Remove Unicode white space at both ends (``trim`` removes blanks only)."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def na_to_null(c: Column) -> Column:
    """NULL for a cell whose untrimmed text means "missing"."""
    return F.when(~c.isin(NA_TOKENS), c)


def or_fail(c: Column, message: Column | str) -> Column:
    """`c`, or a failed job when it is NULL."""
    text = F.lit(message) if isinstance(message, str) else message
    return F.coalesce(c, F.raise_error(text))


def _unreadable(c: Column, label: str) -> Column:
    return F.concat(F.lit(f"{label}: cannot read '"), c, F.lit("'"))


def to_int(c: Column, label: str) -> Column:
    """32-bit integer; bad text and missing cells fail, whatever the ANSI setting."""
    text = F.coalesce(c, F.lit(""))
    return or_fail(text.try_cast("int"), _unreadable(text, label))


def to_double(c: Column, label: str) -> Column:
    """Double; bad text fails, a missing cell or a written NaN is NULL."""
    # The JVM also reads Java literals such as `1.5d` or `0x1p3`; they are bad text here.
    java_literal = F.lower(c).rlike("x|[df]$") & ~F.lower(c).rlike("^[+-]?inf$")
    number = F.when(~java_literal, c.try_cast("double"))
    return F.when(c.isNotNull(), F.nullif(or_fail(number, _unreadable(c, label)), F.lit(float("nan"))))


def round_half_even(c: Column, places: int = 3) -> Column:
    """Scale, round half to even, scale back: the rounding of IEEE array libraries."""
    scale = float(10**places)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def exact_decimal(c: Column, label: str, places: int = 3) -> Column:
    """A value as a decimal of `places` decimals, so that sums do not depend on order; one with more decimals fails."""
    exact = c.try_cast(f"decimal({25 + places},{places})")
    kept = F.when(exact.cast("double") == c.cast("double"), exact)
    return F.when(c.isNotNull(), or_fail(kept, _unreadable(c.cast("string"), label)))
